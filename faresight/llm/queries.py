"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresight.llm import (alignment, decontaminate, exact_dedup, mixing, pii, quality_pu, simhash, substring_dedup, suffix_tree,
                           token_ids, toxicity, warc, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.op1_warc,
    "op2_mixing": mixing.op2_mixing,
    "op3_suffix_tree": suffix_tree.op3_suffix_tree,
    "op4_pii": pii.op4_pii,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_token_ids": token_ids.op6_token_ids,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_quality": quality_pu.op8_quality,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_simhash": simhash.op10_simhash,
    "op11_alignment": alignment.op11_alignment,
    "op12_whitening": whitening.op12_whitening,
    "op13_toxicity": toxicity.op13_toxicity,
}

SQL: dict[str, str] = {
    "op1_warc": warc.OP1_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
}
