import gzip
import hashlib

from pyspark.sql import functions as F

from faresight.llm import warc
from faresight.llm.blobs import opened
from tests.llm import odd

BIG = "<p>" + "payload " * 200 + "</p>"
PAGES = [
    (1, "http://Www.Example.com:80/a?b=c#d", BIG), (2, "https://example.org:8443/x y", BIG), (3, None, BIG + "!"),
    (4, "http://example.com/empty", ""), (5, "http://example.com/null", None), (6, "not a url\twith\r\nbreaks", "é" * 600),
    (7, "http://example.com/small", "same small"), (8, "http://example.com/small", "same small"),
    (9, "http://example.com/multi", "one" * 500), (9, "http://example.com/multi", "one" * 500),
    (None, "http://example.com/", BIG), (None, None, "no id and alone " * 100), (10, "http://example.com/\r\n\r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\n"),
    (11, "http://example.com/long", "x" * 3_000_000),
]
SCHEMA = "page_id long, url string, html string"


def pages(spark):
    out = spark.createDataFrame(PAGES, SCHEMA)
    return out.select("*", *[F.lit("extra").alias(n) for n in odd.CLASHING])


def brute():
    out = []
    for p, _, h in PAGES:
        raw = (h or "").encode()
        same = [q for q, _, g in PAGES if (g or "") == (h or "") and q is not None]
        last = max(same, default=None) if len(raw) >= 1000 else None
        again = last is not None and (p is None or p < last)
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def test_odd_pages_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    got = sorted((tuple(r) for r in warc.archived(pages(spark)).collect()), key=str)
    assert got == brute()


def test_archives_are_gzip_members_of_records(spark, workdir):
    captures = warc.write_archives(warc.with_originals(pages(spark)), workdir).collect()
    for path in {r.path for r in captures}:
        system, place = opened(path)
        raw = system.open_input_file(place).read()
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        at = 0
        for r in sorted((r for r in captures if r.path == path), key=lambda r: r.offset):
            assert r.offset == at
            fields, payload, length = warc.unpack(raw[at:at + r.length])
            assert fields["WARC-Type"] in ("response", "revisit") and (payload == b"" or len(payload) == length)
            at += r.length
        assert at == len(raw)


def test_look_ups_over_many_small_blocks(spark, workdir):
    rows = [(f"com,example,h{i % 7})/{i % 40}", i % 5, f"file{i % 3}", i, 10) for i in range(400)]
    captures = spark.createDataFrame(rows, "url_key string, page long, path string, offset long, length long").repartition(3)
    index = warc.build_index(captures, workdir, block_lines=6)
    asked = sorted({(k, p) for k, p, *_ in rows} | {("a", 1), ("zzz", 2), ("com,example,h3)/3", 99)})
    got = warc.look_up(index, spark.createDataFrame(asked, "url_key string, page long")).collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)


def test_url_keys(spark):
    urls = [r[1] for r in PAGES[:6]] + ["https://user:pw@A.B.example.com:8080"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = [r.k for r in frame.select("i", warc.url_key(F.col("url")).alias("k")).orderBy("i").collect()]
    assert got == ["com,example,www)/a?b=c", "org,example:8443)/x y", "", "com,example)/empty", "com,example)/null",
                   "not a url%09with%0D%0Abreaks)", "com,example,b,a:8080)"]


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
