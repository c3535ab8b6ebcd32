"""Publishing by one pointer, and runs that want the tables at the same time."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from faresight.operators import quality
from faresight.plans import job, lease
from faresight.session import path_exists, read_text, write_text
from faresight.sources import generator


def _day(spark, day, rows=12):
    return generator.generate_trips(spark, date(2025, 1, day), days=1, rows_per_day=rows, seed=day)


def _seen(spark, tables):
    """Trips in silver, and in the fact, of one look at the tables."""
    fact = job.read_fact(spark, tables.fact_dir).agg(F.sum("trip_count")).first()[0]
    zones = {r.zone_id for r in job.read_zones(spark, tables.zones_dir).collect()}
    assert zones == {r.zone_id for r in job.read_refs(spark, tables.zones_dir).collect()}
    return job.read_silver(spark, tables.silver_dir).count(), fact


def _run(spark, root, run_id, day, **settings):
    return job.run_job(spark, root, run_id=run_id, source="frame", trips=_day(spark, day), **settings)


def test_a_stop_at_any_step_leaves_the_published_version(spark, workdir, monkeypatch):
    paths = job.resolve_paths(workdir)
    _run(spark, workdir, "one", 1, publish_only_if_passed=True)
    first = job.published(spark, paths)
    assert first.silver_dir.endswith("/_candidate/one/silver_trips") and _seen(spark, first) == (12, 12)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    for place, name in ((job, "_write_fact"), (job, "_write_zones"), (job, "_new_state"), (quality, "evaluate"), (job, "replace_text")):
        monkeypatch.setattr(place, name, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            _run(spark, workdir, "two", 2, publish_only_if_passed=True)
        monkeypatch.undo()
        assert job.published(spark, paths) == first and _seen(spark, job.published(spark, paths)) == (12, 12)
    _run(spark, workdir, "two", 2, publish_only_if_passed=True)
    second = job.published(spark, paths)
    assert _seen(spark, second) == (24, 24) and second != first
    # who looked before the change still reads one version, until the next is published
    assert _seen(spark, first) == (12, 12)
    # the default run changes the published version; a published run id that comes again gets a folder of its own
    assert _run(spark, workdir, "three", 3)["transforms"]["mode"] == "incremental"
    assert _seen(spark, job.published(spark, paths)) == (36, 36) == _seen(spark, paths)
    _run(spark, workdir, "two", 2, publish_only_if_passed=True)
    again = job.published(spark, paths)
    assert again.silver_dir != second.silver_dir and _seen(spark, again) == (36, 36)
    assert not path_exists(spark, first.silver_dir) and path_exists(spark, second.silver_dir)


def test_the_lease_has_one_holder(spark, workdir):
    with lease.Lease(spark, workdir, "a") as a:
        assert a.token == 1
        with pytest.raises(lease.LeaseHeld, match="a"):
            lease.Lease(spark, workdir, "b").acquire()
        lease.check()
    with lease.Lease(spark, workdir, "b") as b:
        assert b.token == 2 and a.greatest() == 2
        with pytest.raises(lease.LeaseLost):
            a.check()
    lease.check()   # outside of a run there is nothing to check


def test_a_holder_that_beats_is_left_alone_and_a_silent_one_is_not(spark, workdir):
    live = lease.Lease(spark, workdir, "live", beat=0.1).acquire()
    with pytest.raises(lease.LeaseHeld):
        lease.Lease(spark, workdir, "b", wait=2.0, timeout=1.0).acquire()
    live._stop.set()   # no beat from now on, as if its driver stood still
    live._thread.join()
    with lease.Lease(spark, workdir, "c", wait=10.0, timeout=0.5) as c:
        assert c.token == live.token + 1
        with pytest.raises(lease.LeaseLost):
            live.check()
        live.release()   # says nothing any more: the lease is another's
        assert '"c"' in read_text(spark, c._path(c.token)) and "released" not in read_text(spark, c._path(c.token))


def test_of_many_that_want_a_free_lease_one_gets_it(spark, workdir):
    held, refused = [], []

    def want(n):
        try:
            held.append(lease.Lease(spark, workdir, str(n)).acquire())
        except lease.LeaseHeld:
            refused.append(n)

    threads = [threading.Thread(target=want, args=(n,)) for n in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(held) == 1 and len(refused) == 5
    held[0].release()


def test_two_runs_at_once(spark, workdir):
    """The second waits for the tables of the first and folds its batch in; neither takes the other for stopped."""
    summaries = {}

    def run(name, day):
        summaries[name] = _run(spark, workdir, name, day)

    _run(spark, workdir, "base", 1)
    threads = [threading.Thread(target=run, args=(f"r{day}", day)) for day in (2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [summaries[f"r{d}"]["transforms"]["mode"] for d in (2, 3)] == ["incremental", "incremental"]
    assert _seen(spark, job.resolve_paths(workdir)) == (36, 36)


def test_a_run_beside_a_live_one_leaves_its_marker_and_tables(spark, workdir):
    paths = job.resolve_paths(workdir)
    _run(spark, workdir, "base", 1)
    marker = job.pending_marker(paths, "live")
    with lease.Lease(spark, workdir, "live"):
        write_text(spark, marker, "live")
        failed = _run(spark, workdir, "late", 2, raise_on_failure=False, lease_wait=0.0)
        assert failed["status"] == "failed" and "changing the tables" in failed["error_message"]
        assert path_exists(spark, marker) and _seen(spark, paths) == (12, 12)
    # its batch waits in bronze; the live run never came to an end, so everything is built anew
    last = _run(spark, workdir, "next", 3)
    assert last["transforms"]["mode"] == "full" and _seen(spark, paths) == (36, 36)
    assert not path_exists(spark, marker)


def test_a_stale_run_changes_nothing(spark, workdir, monkeypatch):
    """A run that stood still while another took over fails at its next change."""
    paths = job.resolve_paths(workdir)
    _run(spark, workdir, "base", 1)
    rerank, taken = job.silver.rerank, []

    def overtaken(*args):
        if not taken:
            taken.append(None)
            lease.create_text(spark, f"{workdir}/_lease/{2 + 1:012d}", '{"owner": "other", "beat": "released"}')
        return rerank(*args)

    monkeypatch.setattr(job.silver, "rerank", overtaken)
    failed = _run(spark, workdir, "stale", 2, raise_on_failure=False)
    assert failed["status"] == "failed" and "taken for dead" in failed["error_message"]
    assert _seen(spark, paths) == (12, 12)
    assert _run(spark, workdir, "next", 3)["transforms"]["silver_rows"] == 36
