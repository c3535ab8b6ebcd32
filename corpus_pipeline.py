"""The training-data pipeline: stages that each call one operator of ``faresight.llm``.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresight.llm.common import saved, table
from faresight.llm.decontaminate import clean
from faresight.llm.mixing import MAX_REPEATS, WEIGHTS, mixed_documents
from faresight.llm.quality_pu import keep_good
from faresight.llm.simhash import RADIUS, SHINGLE_WORDS, keep_one
from faresight.llm.token_ids import encoded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier predicts to be good stay."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest doc_id."""
    return keep_one(docs, width=SHINGLE_WORDS, radius=RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and pass that the mix to target weights draws."""
    return mixed_documents(docs, WEIGHTS, MAX_REPEATS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the id shards hold of each document: doc_id, start, n_tokens, ids_crc32."""
    return encoded(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token ids", token_ids),
]

#: The classifier is trained, fingerprints are majority votes over hashes and ids come
#: from a tokenizer: none of it is SQL. The stages are tested in tests/llm instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
