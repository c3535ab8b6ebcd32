"""One run at a time changes the tables of a warehouse.

``{root}/_lease/<token>`` are small files with growing tokens; who made the
greatest holds the lease. A file is made exclusively, so of two runs that want
the same token one gets it. The holder writes a new beat into its file every
few seconds, and ``released`` when it is done. A waiting run takes over once
the lease is released, or when it has not seen a new beat for ``timeout``
seconds of its own clock, so clocks need not agree. A holder that was taken for
dead finds a greater token before its next change and fails (``check``).
"""

from __future__ import annotations

import json
import threading
import time
from contextvars import ContextVar

from pyspark.sql import SparkSession

from faresight.session import create_text, delete_path, list_matches, read_text, write_text

#: Seconds without a new beat after which a holder is taken for dead, and between two beats.
TIMEOUT, BEAT = 60.0, 5.0

RELEASED = "released"
_HELD: ContextVar[Lease | None] = ContextVar("lease", default=None)


class LeaseHeld(RuntimeError):
    """Another run is changing the tables."""


class LeaseLost(RuntimeError):
    """Another run has taken over; this one must change nothing any more."""


class Lease:
    """``with Lease(...)``: from here on this run may change the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, owner: str, wait: float = 0.0, timeout: float = TIMEOUT,
                 beat: float = BEAT):
        self.spark, self.folder, self.owner = spark, f"{root.rstrip('/')}/_lease", owner
        self.wait, self.timeout, self.beat = wait, timeout, beat
        self.token = 0
        self._stop, self._thread, self._reset = threading.Event(), None, None

    def _path(self, token: int) -> str:
        return f"{self.folder}/{token:012d}"

    def greatest(self) -> int:
        return max((int(p.rsplit("/", 1)[1]) for p in list_matches(self.spark, f"{self.folder}/[0-9]*")), default=0)

    def _text(self, state: str) -> str:
        return json.dumps({"owner": self.owner, "beat": state})

    def _free(self, token: int, seen: dict[int, tuple[str | None, float]]) -> bool:
        """Whether the holder of a token is done or, by what was ``seen`` of it, dead."""
        text = read_text(self.spark, self._path(token))
        if text and json.loads(text)["beat"] == RELEASED:
            return True
        now = time.monotonic()
        if token not in seen or seen[token][0] != text:
            seen[token] = (text, now)
        return now - seen[token][1] >= self.timeout

    def acquire(self) -> Lease:
        until, seen = time.monotonic() + self.wait, {}
        while True:
            last = self.greatest()
            if last == 0 or self._free(last, seen):
                if create_text(self.spark, self._path(last + 1), self._text("0")):
                    self.token = last + 1
                    break
                continue
            if time.monotonic() >= until:
                raise LeaseHeld(f"{read_text(self.spark, self._path(last))} is changing the tables below {self.folder}")
            time.sleep(min(1.0, self.timeout / 4, max(0.01, until - time.monotonic())))
        for token in range(max(1, self.token - 8), self.token):   # only the greatest counts
            delete_path(self.spark, self._path(token))
        self._thread = threading.Thread(target=self._beats, daemon=True)
        self._thread.start()
        return self

    def _beats(self) -> None:
        n = 0
        while not self._stop.wait(self.beat):
            n += 1
            try:
                if self.greatest() == self.token:
                    write_text(self.spark, self._path(self.token), self._text(str(n)))
            except Exception:   # a beat that fails is a beat missed: the next one may do
                continue

    def check(self) -> None:
        """Raise unless this run still holds the lease."""
        if self.greatest() != self.token:
            raise LeaseLost(f"run {self.owner!r} was taken for dead and another run has the tables")

    def release(self) -> None:
        self._stop.set()
        if self._thread is not None:
            self._thread.join()
        if self.token and self.greatest() == self.token:
            write_text(self.spark, self._path(self.token), self._text(RELEASED))

    def __enter__(self) -> Lease:
        self.acquire()
        self._reset = _HELD.set(self)
        return self

    def __exit__(self, *error) -> None:
        _HELD.reset(self._reset)
        self.release()


def check() -> None:
    """Called before tables change: raises if the run around it has lost its lease. Outside of a run, nothing."""
    held = _HELD.get()
    if held is not None:
        held.check()
