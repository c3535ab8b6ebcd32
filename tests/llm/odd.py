"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} stands{i % 13} here" for i in range(30_000))
LINE = "This line of more than one hundred bytes is shared by several documents, and it says so here once, twice and again. "
#: (doc_id, text, lang, source, n_chars)
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "b", 43),
    (2, "the  quick\tbrown fox jumps over\nthe lazy dog", "en", "a", 44),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "en", "c", 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, LINE + "First.", "en", "b", 1),
    (8, "Before. " + LINE + LINE + "After.", "de", "d", 1),
    (8, "Another text of the same doc_id. " + LINE, "de", "d", 1),
    (9, "repeated row " + LINE, "fr", None, 1),
    (9, "repeated row " + LINE, "fr", None, 1),
    (None, "no id " + LINE, "fr", "a", 1),
    (None, "no id either", "fr", "a", 1),
    (None, None, None, None, None),
    (10, "ab " * 200, "xx", "e", 600),
    (11, "É" * 150 + " ünïcode", "fr", "é", 1),
    (12, "single", "en", "b", 6),
    (13, "The quick brown fox jumps over the lazy dog", "en", "b", 43),
    (100, "| pipes | and spaces <|endoftext|> don't 12.5 ​ x", "en", "b", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ["fp", "root", "component_id", "digest", "key", "copy", "size", "sid", "shard", "occurrence", "kept", "g", "at",
            "held_out", "score", "h", "bucket", "block", "taken", "start", "payload", "original", "url_key", "found", "new",
            "row", "row_key", "number", "words", "cut", "__key", "__copy", "__words", "__cut", "__row_key", "__row_number"]


def documents(spark):
    """``ROWS`` with clashing extra columns."""
    from pyspark.sql import functions as F
    out = spark.createDataFrame(ROWS, SCHEMA)
    return out.select("*", *[F.lit(f"extra {n}").alias(n) for n in CLASHING])


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
