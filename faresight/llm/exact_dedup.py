"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one
row per digest, compared with the index by a sort-merge anti-join that reads
the buckets in place (the index side is not shuffled), and what is new is
appended to the same buckets. Batches may come over years; the table outlives
the session that wrote it, since its location is all that is needed to open it.

Every row names the run that brought it. A run that stopped part way and comes
again, under its own id, takes the rows it had appended as its own, so it tells
what a run without a stop would have told.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import SPACE, saved, table, text_of
from faresight.session import fresh_path

#: Buckets of an index: fixed when it is made. A batch shuffles only its own digests to them.
BUCKETS = 32


def text_digest(text: Column) -> Column:
    """SHA-256 in hex of the UTF-8 text with each run of white space as one space."""
    return F.sha2(F.encode(F.regexp_replace(text, SPACE, " "), "UTF-8"), 256)


class DigestIndex:
    """A digest index at a location in storage that all executors share.

    Rows: digest, keep_id (smallest doc_id of the batch that brought the
    digest; null if that batch had none), batch (number within its run), run
    (id of the run; null in an index from before runs had ids). ``close``, or
    the end of a ``with`` block, removes the session's catalogue entry; the
    index stays.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int = BUCKETS):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        # the catalogue entry carries the bucket layout; files that are already there are taken over
        spark.sql(f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, batch INT, run STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def add(self, rows: DataFrame, batch: int, run: str) -> None:
        """Append the digests of ``rows(doc_id, digest)`` that the index lacks."""
        heads = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        new = heads.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new = saved(new.withColumns({"batch": F.lit(batch), "run": F.lit(run)}), "new-digests")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))


def run_of(counted: DataFrame) -> str:
    """An id that equal sets of (digest, doc_id, copies) share: their number and the sums of two hashes of them."""
    one, two = (F.xxhash64(F.lit(salt), "digest", "doc_id", "copies").cast("decimal(38,0)") for salt in (1, 2))
    row = counted.agg(F.count("*"), F.sum(one), F.sum(two)).first()
    return "-".join(str(v or 0) for v in row)


def deduplicate(docs: DataFrame, index: DigestIndex, batches: int = 2, run: str | None = None) -> DataFrame:
    """Feed ``docs`` to the index in ``batches`` runs of ascending doc_id and tell what stays.

    One row per row of ``docs``: doc_id, keep_id (doc_id of the row that
    stays), group_size (rows with this text in ``docs``), kept, text_sha256.
    Null text counts as empty. Rows without doc_id come in the last batch and
    stay only if no row of their group has a doc_id; keep_id is then null. Of
    rows with equal doc_id and equal text exactly one is kept. Texts that
    another run brought to the index before are kept nowhere. Other columns are
    not read. An empty table gives an empty result.

    ``run`` names the run; without it the rows themselves do. A run that was
    stopped anywhere, or had ended, and is made again with the same rows and
    batches in mind gives the result of the first time: batches ascend by
    doc_id, so whatever batch brought a digest holds its smallest doc_id.
    """
    counted = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(text_of()).alias("digest"))
                    .groupBy("digest", "doc_id").agg(F.count("*").alias("copies")), "digests")
    shares = [k / batches for k in range(1, batches)]
    cuts = counted.agg(F.percentile_approx("doc_id", shares)).first()[0] or [] if shares else []
    run = run or run_of(counted)
    number = sum(((F.col("doc_id") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    number = F.coalesce(number, F.lit(len(cuts)))
    for k in range(len(cuts) + 1):
        index.add(counted.where(number == k).select("doc_id", "digest"), k, run)

    sizes = counted.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    resolved = saved(sizes.join(index.rows(), "digest"), "resolved")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return (counted.join(resolved, "digest").select("*", copy.alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
                     & F.col("run").eqNullSafe(run)).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against an index that starts empty."""
    with DigestIndex(spark, fresh_path(spark, "digest-index")) as index:
        return deduplicate(table(spark, sf_dir, "documents"), index)


OP5_SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""
