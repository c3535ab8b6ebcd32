"""The audit table's base and the rows appended beside it (S10, W2)."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faresight.operators import audit
from faresight.session import list_matches, read_text, write_text

START = datetime(2024, 1, 1)


def row(i: int, turn: int = 0) -> dict:
    return {"run_id": f"run-{i:05d}", "status": f"turn {turn}", "started_at": START + timedelta(days=turn, seconds=i),
            "bronze_rows": i}


def newest(spark, folder: str) -> dict[str, str]:
    found = audit.latest_runs(audit.read_runs(spark, folder)).collect()
    assert len({r.run_id for r in found}) == len(found)
    return {r.run_id: r.status for r in found}


def bases(spark, folder: str) -> list[str]:
    return list_matches(spark, f"{folder}/_base/0*-*")


def test_merges_keep_the_newest_row_and_delete_one_merge_later(spark, workdir):
    want = {}
    for turn in range(4):
        for i in range(turn, 3 + turn):
            audit.append_run(spark, workdir, row(i, turn))
            want[f"run-{i:05d}"] = f"turn {turn}"
        assert newest(spark, workdir) == want
        assert not audit.merge_runs(spark, workdir, least=4)
        assert audit.merge_runs(spark, workdir, least=3)
        assert newest(spark, workdir) == want
        assert audit.read_runs(spark, workdir).count() == len(want)
        assert len(list_matches(spark, f"{workdir}/run-*")) <= 3 + 3 * (turn > 0)
        assert len(bases(spark, workdir)) <= 2
    assert not audit.merge_runs(spark, workdir, least=1)


def test_files_in_the_table_folder_itself(spark, workdir):
    """Another writer's files, and a table whose own folder is called like that of an append."""
    table = f"{workdir}/run-table"
    for turn in range(3):
        rows = [{**dict.fromkeys(audit.RUN_AUDIT_COLUMNS), **row(i, turn)} for i in range(turn, turn + 2)]
        spark.createDataFrame(rows, audit.RUN_AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(table)
        audit.append_run(spark, table, row(50 + turn, turn))
        assert audit.merge_runs(spark, table, least=2)
    assert newest(spark, table) == {"run-00000": "turn 0", "run-00001": "turn 1", "run-00002": "turn 2",
                                    "run-00003": "turn 2", "run-00050": "turn 0", "run-00051": "turn 1",
                                    "run-00052": "turn 2"}


def test_a_reader_from_before_a_merge_can_end(spark, workdir):
    for i in range(3):
        audit.append_run(spark, workdir, row(i))
    before = audit.read_runs(spark, workdir)
    assert audit.merge_runs(spark, workdir, least=1)
    assert before.count() == 3
    between = audit.read_runs(spark, workdir)
    audit.append_run(spark, workdir, row(3))
    assert audit.merge_runs(spark, workdir, least=1)
    assert between.count() == 3 and audit.read_runs(spark, workdir).count() == 4


@pytest.mark.parametrize("stop", ["create_text", "delete_path"])
def test_a_stop_loses_and_repeats_no_row(spark, workdir, monkeypatch, stop):
    for turn in range(2):
        for i in range(2):
            audit.append_run(spark, workdir, row(i + turn, turn))
        if turn == 0:
            assert audit.merge_runs(spark, workdir, least=1)
    want = newest(spark, workdir)

    def dies(*args):
        raise OSError("stopped here")
    with monkeypatch.context() as patched:
        patched.setattr(audit, stop, dies)
        with pytest.raises(OSError, match="stopped here"):
            audit.merge_runs(spark, workdir, least=1)
    assert newest(spark, workdir) == want
    audit.append_run(spark, workdir, row(9))
    assert audit.merge_runs(spark, workdir, least=1)
    assert newest(spark, workdir) == want | {"run-00009": "turn 0"}
    assert audit.read_runs(spark, workdir).count() == len(want) + 1


def test_a_version_that_says_nothing_yet_is_passed_over(spark, workdir):
    audit.append_run(spark, workdir, row(0))
    assert audit.merge_runs(spark, workdir, least=1)
    write_text(spark, f"{workdir}/_base/{2:012d}.json", "")   # its maker stopped before it wrote
    audit.append_run(spark, workdir, row(1))
    assert set(newest(spark, workdir)) == {"run-00000", "run-00001"}
    assert audit.merge_runs(spark, workdir, least=1)
    assert audit.read_runs(spark, workdir).count() == 2 and len(bases(spark, workdir)) == 2


def test_of_two_merges_one_wins(spark, workdir, monkeypatch):
    for i in range(2):
        audit.append_run(spark, workdir, row(i))
    made = audit.create_text

    def late(*args):
        monkeypatch.setattr(audit, "create_text", made)
        assert audit.merge_runs(spark, workdir, least=1)   # another merge comes first
        return made(*args)
    monkeypatch.setattr(audit, "create_text", late)
    assert not audit.merge_runs(spark, workdir, least=1)
    assert len(bases(spark, workdir)) == 1
    assert audit.read_runs(spark, workdir).count() == 2


def test_runs_that_end_together_all_leave_their_row(spark, workdir):
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: audit.append_run(spark, workdir, row(i)), range(16)))
    assert len(newest(spark, workdir)) == 16


def test_look_up_skips_row_groups(spark, workdir, monkeypatch):
    monkeypatch.setattr(audit, "BASE_GROUP_BYTES", 64 << 10)
    many = spark.range(10_000).select(
        F.format_string("run-%05d", F.hash("id") % 50_000 + 50_000).alias("run_id"), F.sha2(F.col("id").cast("string"), 512)
        .alias("error_message"), F.lit(START).cast("timestamp_ntz").alias("started_at"))
    target = spark.createDataFrame([], audit.RUN_AUDIT_SCHEMA).unionByName(many, allowMissingColumns=True)
    target.repartition(70).write.parquet(workdir)
    assert audit.merge_runs(spark, workdir)
    base, = bases(spark, workdir)
    files = list_matches(spark, f"{base}/*.parquet")
    assert len(files) == 1
    meta = pq.ParquetFile("/" + files[0].split(":", 1)[-1].lstrip("/")).metadata
    spans = [(s.min, s.max) for s in (meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups))]
    assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))   # one group at most holds an id
    wanted = many.agg(F.max("run_id")).first()[0]
    found = audit.run_of(audit.read_runs(spark, workdir), wanted)
    plan = found._jdf.queryExecution().toString()
    assert plan.count(f"EqualTo(run_id,{wanted})") >= 2   # both scans
    assert found.count() == 1


def test_current_names_what_was_merged(spark, workdir):
    audit.append_run(spark, workdir, row(0))
    assert audit.merge_runs(spark, workdir, least=1)
    version, = list_matches(spark, f"{workdir}/_base/0*.json")
    text = json.loads(read_text(spark, version))
    assert len(text["files"]) == 1 and text["older"] == []
