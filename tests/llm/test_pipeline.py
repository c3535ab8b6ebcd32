import duckdb

import __spark_entry__
import corpus_pipeline
from faresight.llm import queries, quality_pu
from faresight.llm.common import saved, table
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as holds
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute as groups
from tests.llm.test_token_ids import whole

SF = SF_SMALL


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near duplicates", "decontamination", "mixing", "token ids"]
    seen, before = [], docs
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, before, SF), "stage")
        if name != "token ids":
            assert after.columns == docs.columns
        seen.append(([tuple(r) for r in before.collect()], after.collect()))
        before = after

    came, left = seen[0]
    model = quality_pu.learn(docs, table(spark, SF, "labels"), quality_pu.held_out_fold(docs["doc_id"]))
    good = {r.doc_id for r in quality_pu.scored(docs, model).collect() if r.predicted}
    assert {r.doc_id for r in left} == good
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    marked = [labels[r[0]] == (r[0] in good) for r in came if r[0] in labels]
    assert sum(marked) / len(marked) > 0.9

    came, left = seen[1]
    assert {r.doc_id for r in left} == {c for _, _, c in groups([r[:2] for r in came])}

    came, left = seen[2]
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    short = [r[:2] for r in came if len(r[1]) < 3000]
    dirty = {d for d, _ in holds(short, items)}
    assert {r.doc_id for r in left} & {d for d, _ in short} == {d for d, _ in short} - dirty

    came, left = seen[3]
    sizes, taken = {}, {}
    for r in came:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].encode().split())
    for r in left:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 0.51
    origin = {r[0]: r[1] for r in came}
    assert all(origin[r.doc_id].startswith(r.text) for r in left)

    came, left = seen[4]
    want = sorted((r[0], len(x)) for r, x in zip(came, whole([r[1] for r in came])))
    assert sorted((r.doc_id, r.n_tokens) for r in left) == want


def test_registered_queries_against_sql(spark):
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in found if q.startswith("op")}
    assert "pipeline" in found and set(queries.SQL) <= set(sql)
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for name, text in queries.SQL.items():
        frame = found[name](spark, SF)
        columns = sorted(frame.columns)
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({text})").fetchall()
        got = [tuple(r) for r in frame.select(*columns).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
