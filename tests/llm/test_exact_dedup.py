import hashlib
import re

import pytest

from faresight.llm import exact_dedup
from faresight.session import fresh_path
from tests.llm import odd


def brute(rows):
    digest = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in rows]
    out, done = [], set()
    for (d, _), h in zip(rows, digest):
        same = [x for (x, _), g in zip(rows, digest) if g == h]
        keep = min((x for x in same if x is not None), default=None)
        kept = d == keep and (h, d) not in done
        done |= {(h, d)} if kept else set()
        out.append((d, keep, len(same), kept, h))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows_against_brute_force(spark):
    index = exact_dedup.DigestIndex(spark, fresh_path(spark, "index"), buckets=3)
    rows = [r[:2] for r in odd.ROWS]
    assert found(exact_dedup.deduplicate(odd.documents(spark), index, batches=3)) == brute(rows)


def test_index_outlives_its_session_object(spark):
    location = fresh_path(spark, "index")
    first = spark.createDataFrame([(5, "a  b"), (6, "c")], "doc_id long, text string")
    exact_dedup.deduplicate(first, exact_dedup.DigestIndex(spark, location, buckets=2)).collect()
    later = spark.createDataFrame([(1, "a b"), (7, "d")], "doc_id long, text string")
    again = exact_dedup.DigestIndex(spark, location, buckets=2)
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(later, again).collect()}
    assert got == {1: (5, False), 7: (7, True)}
    assert sorted(r.keep_id for r in again.rows().collect()) == [5, 6, 7]


def test_anti_join_reads_the_index_in_place(spark):
    index = exact_dedup.DigestIndex(spark, fresh_path(spark, "index"), buckets=4)
    index.add(spark.createDataFrame([(1, "x")], "doc_id long, digest string"), 0, "r")
    heads = spark.createDataFrame([(2, "y")], "doc_id long, digest string").groupBy("digest").count()
    plan = (heads.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
            ._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plan and plan.count("Exchange") <= 2  # of the batch only
    assert "Bucketed: true" in plan


class Stopped(Exception):
    pass


@pytest.mark.parametrize("run", [None, "nightly-7"])
def test_a_run_stopped_after_any_append_and_made_again(spark, monkeypatch, run):
    rows = [r[:2] for r in odd.ROWS]
    add = exact_dedup.DigestIndex.add
    for stop in range(3):
        location = fresh_path(spark, "index")

        def stopping(self, rows_, batch, run_):
            add(self, rows_, batch, run_)
            if batch == stop:
                raise Stopped

        monkeypatch.setattr(exact_dedup.DigestIndex, "add", stopping)
        with pytest.raises(Stopped):
            exact_dedup.deduplicate(odd.documents(spark), exact_dedup.DigestIndex(spark, location, buckets=2), 3, run)
        monkeypatch.setattr(exact_dedup.DigestIndex, "add", add)
        with exact_dedup.DigestIndex(spark, location, buckets=2) as again:
            assert found(exact_dedup.deduplicate(odd.documents(spark), again, 3, run)) == brute(rows)
            # another run with one of the texts keeps nothing of it
            other = spark.createDataFrame([(0, "single"), (70, "not yet seen")], "doc_id long, text string")
            got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(other, again, 1).collect()}
            assert got == {0: (12, False), 70: (70, True)}
        assert not spark.catalog.tableExists(again.name)


def test_empty_table(spark):
    index = exact_dedup.DigestIndex(spark, fresh_path(spark, "index"))
    assert exact_dedup.deduplicate(odd.nothing(spark), index).count() == 0
