"""WARC archives and a two-level capture index.

Archives are ``.warc.gz`` files of one gzip member a record. The index has one
line per capture (reversed-host URL key, page, file, offset, length), sorted by
key and page and packed into compressed blocks; the block directory holds each
block's first key and place. Index parts are key ranges, each with its own
directory, and only the first keys of the parts reach the driver. A look-up
goes to its part, binary-searches the directory, reads that one block by its
range, binary-searches the block's lines, and reads the record by its range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.blobs import Reader, Writer
from faresight.llm.common import map_arrow, record, saved, table, text_of
from faresight.session import fresh_path

#: Contract of the registered query: payloads of this size that repeat are stored once.
REVISIT_BYTES = 1000

#: Lines of an index block.
BLOCK_LINES = 2000
#: Bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20
#: Place of a page without page_id among the captures of its key: before all others.
NO_PAGE = -(1 << 63)
#: The tables have no capture time; records carry this one.
CAPTURED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_CAPTURE = pa.schema([("url_key", pa.string()), ("page", pa.int64()), ("path", pa.string()), ("offset", pa.int64()),
                      ("length", pa.int64())])
_CAPTURE_SQL = "url_key string, page long, path string, offset long, length long"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels in reverse, port, then path and query; null gives the empty key."""
    pattern = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)"
    url = F.coalesce(url, F.lit(""))
    host, port, rest = (F.regexp_extract(url, pattern, g) for g in (1, 2, 3))
    port = F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port))
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), port, F.lit(")"), rest)
    for mark, written in (("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        key = F.replace(key, F.lit(mark), F.lit(written))
    return F.when(url == "", "").otherwise(key)


# --- records ------------------------------------------------------------------------------

def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}:{digest}')}>"


def _header_text(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def pack(page: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record as a gzip member; a revisit if ``original`` is the page that holds the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if original is not None else http + payload
    fields = [("WARC-Type", "revisit" if original is not None else "response"),
              ("WARC-Record-ID", _record_id(page, digest)), ("WARC-Date", CAPTURED),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_text(url)))
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if original is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(original, digest)),
                   ("X-Refers-To-Page-ID", str(original))]
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def unpack(member: bytes) -> tuple[dict[str, str], bytes, int]:
    """(header fields, payload, payload's length as the HTTP header gives it) of one record."""
    raw = zlib.decompress(member, 31)
    cut = raw.index(b"\r\n\r\n")
    version, *lines = raw[:cut].decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = raw[cut + 4:cut + 4 + int(fields["Content-Length"])]
    body = block.index(b"\r\n\r\n") + 4
    length = next(int(x.split(b":")[1]) for x in block[:body].split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, block[body:], length


def with_originals(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, url, url_key, payload, digest, original):
    original is the largest page_id with the same payload of at least ``least`` bytes,
    null for the row that has it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_of("html").alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    same = (rows.where(F.octet_length("payload") >= least).groupBy("digest")
            .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last"))
    later = F.col("last").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("last")))
    return (rows.join(same, "digest", "left")
            .select("page_id", "url", url_key(F.col("url")).alias("url_key"), F.encode("payload", "UTF-8").alias("payload"),
                    "digest", F.when(later, F.col("last")).alias("original")))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``with_originals`` rows as archives; one capture row per record, written to the shared folder."""
    def kernel(batches):
        out, label = None, f"pages-{TaskContext.get().partitionId():06d}"
        for batch in batches:
            places = []
            for page, url, key, payload, digest, original in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None or out.at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    out = Writer(folder, label, "warc.gz")
                member = pack(page, url, payload, digest, original)
                places.append((key, NO_PAGE if page is None else page, out.location, out.write(member), len(member)))
            if places:
                yield record(_CAPTURE, *map(list, zip(*places)))
        if out is not None:
            out.close()

    return saved(map_arrow(rows, kernel, _CAPTURE_SQL), "captures")


# --- index ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Index:
    """parts: the first (key, page) of each index part, ascending, and its directory file."""

    spark: SparkSession
    parts: list[tuple[str, int, str]]


def _read_directory(location: str) -> tuple[list[tuple[str, int]], list[tuple[str, int, int]]]:
    """First (key, page) and (file, offset, length) of each block of a part."""
    source = Reader(location)
    lines = zlib.decompress(source.read(0, source.size)).decode().split("\n")
    source.close()
    rows = [line.split("\t") for line in lines]
    return [(k, int(p)) for p, _, _, _, k in rows], [(f, int(o), int(n)) for _, f, o, n, _ in rows]


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> Index:
    """Sort ``captures`` into compressed blocks and directories."""
    schema = pa.schema([("url_key", pa.string()), ("page", pa.int64()), ("directory", pa.string())])

    def line(key, page, path, offset, length) -> str:
        return f"{page}\t{path}\t{offset}\t{length}\t{key}"

    def kernel(batches):
        out, waiting, blocks = None, [], []

        def flush(rows):
            data = zlib.compress("\n".join(line(*r) for r in rows).encode(), 6)
            blocks.append(line(rows[0][0], rows[0][1], out.location, out.write(data), len(data)))

        first = None
        for batch in batches:
            waiting += zip(*(batch.column(i).to_pylist() for i in range(5)))
            if waiting and out is None:
                first, out = waiting[0], Writer(folder, "captures", "blocks")
            while len(waiting) >= block_lines:
                flush(waiting[:block_lines])
                waiting = waiting[block_lines:]
        if waiting:
            flush(waiting)
        if out is not None:
            out.close()
            directory = Writer(folder, "directory", "blocks")
            directory.write(zlib.compress("\n".join(blocks).encode(), 6))
            directory.close()
            yield record(schema, [first[0]], [first[1]], [directory.location])

    rows = captures.repartitionByRange("url_key", "page").sortWithinPartitions("url_key", "page", "path", "offset")
    parts = saved(map_arrow(rows, kernel, "url_key string, page long, directory string"), "index-parts")
    # one row per part, that is per task of the sort
    found = sorted(((r.url_key, r.page, r.directory) for r in parts.collect()), key=lambda r: (r[0].encode(), r[1]))
    return Index(captures.sparkSession, found)


def look_up(index: Index, queries: DataFrame) -> DataFrame:
    """The captures of ``queries(url_key, page)``, which are different."""
    if not index.parts:
        return queries.select("url_key", "page", F.lit("").alias("path"), F.lit(0).cast("long").alias("offset"),
                              F.lit(0).cast("long").alias("length")).where("false")
    starts = [(k.encode(), p) for k, p, _ in index.parts]
    directories = [d for _, _, d in index.parts]
    sent = pa.schema([("part", pa.int32()), ("url_key", pa.string()), ("page", pa.int64())])

    def route(batches):
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            parts = [max(0, bisect.bisect_right(starts, (k.encode(), p)) - 1) for k, p in keys]
            yield record(sent, np.array(parts, np.int32), batch.column(0), batch.column(1))

    def search(batches):
        part, at, lines = None, None, []
        for batch in batches:
            found = []
            for own, key, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if own != part:
                    part, at = own, None
                    firsts, blocks = _read_directory(directories[part])
                    order = [(k.encode(), p) for k, p in firsts]
                wanted = (key.encode(), page)
                # captures of one key and page may run over several blocks
                block = max(0, bisect.bisect_left(order, wanted) - 1)
                while block < len(blocks) and (block == 0 or order[block] <= wanted):
                    if block != at:
                        at, (path, offset, length) = block, blocks[block]
                        source = Reader(path)
                        rows = [x.split("\t") for x in zlib.decompress(source.read(offset, length)).decode().split("\n")]
                        source.close()
                        lines = [((k.encode(), int(p)), f, int(o), int(n)) for p, f, o, n, k in rows]
                    i = bisect.bisect_left(lines, wanted, key=lambda x: x[0])
                    while i < len(lines) and lines[i][0] == wanted:
                        found.append((key, page, *lines[i][1:]))
                        i += 1
                    if i < len(lines):
                        break
                    block += 1
            if found:
                yield record(_CAPTURE, *map(list, zip(*found)))

    routed = map_arrow(queries.select("url_key", "page"), route, "part int, url_key string, page long")
    # a part's queries are spread over several tasks, each in key order
    run = F.pmod(F.xxhash64("url_key", "page"), F.lit(4))
    routed = routed.repartition("part", run).sortWithinPartitions("part", "url_key", "page")
    return map_arrow(routed, search, _CAPTURE_SQL)


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_records(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records at
    ``captures``, each payload checked against its header's digest.

    A revisit's payload is that of the response it refers to.
    """
    def kernel(batches):
        path, source = None, None
        for batch in batches:
            paths, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            starts = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]]
            rows = []
            for a, b in zip(starts, [*starts[1:], len(paths)]):
                if paths[a] != path:
                    if source is not None:
                        source.close()
                    path = paths[a]
                    source = Reader(path)
                for member in source.ranges(list(zip(offsets[a:b], lengths[a:b]))):
                    fields, payload, length = unpack(member)
                    kind = fields["WARC-Type"]
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload differs from its digest")
                    page, original = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    rows.append((None if page is None else int(page), len(payload) if kind == "response" else None,
                                 digest, kind, None if original is None else int(original)))
            if rows:
                yield record(_READ, *map(list, zip(*rows)))
        if source is not None:
            source.close()

    ordered = (captures.select("path", "offset", "length").repartitionByRange("path", "offset")
               .sortWithinPartitions("path", "offset"))
    read = saved(map_arrow(ordered, kernel, "page_id long, payload_bytes long, payload_digest string, "
                                            "record_type string, refers_to long"), "records")
    responses = (read.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
                 .agg(F.max("payload_bytes").alias("full")))
    revisits = (read.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"])
                .select("page_id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
    return read.where("record_type = 'response'").unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives, index them, and read every page back
    through the index.

    One row per row of ``pages``: page_id, payload_bytes, payload_digest
    (SHA-1), record_type, refers_to. Null html is the empty payload; a null URL
    has the empty key and no target field. Of equal payloads of at least
    ``REVISIT_BYTES`` bytes the row with the largest page_id is the response
    and rows with smaller or no page_id revisit it; rows that share the largest
    page_id are responses all, and so are all rows if none has a page_id. Other
    columns are not read. An empty table gives an empty result.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    captures = write_archives(with_originals(pages), folder)
    index = build_index(captures, folder)
    queries = pages.select(url_key(F.col("url").cast("string")).alias("url_key"),
                           F.coalesce(F.col("page_id").cast("long"), F.lit(NO_PAGE)).alias("page")).distinct()
    return read_records(look_up(index, queries))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``: see ``archived``."""
    return archived(table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), largest AS (
  SELECT payload_digest, max(page_id) AS original FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM payloads LEFT JOIN largest USING (payload_digest)
"""
