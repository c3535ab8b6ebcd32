"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Everything is DataFrame and SQL functions.

* A source's documents are laid end to end in a hashed order on a line of
  words; a block is the run of whole documents that start in the same
  ``BLOCK_WORDS`` words. Sources so become lists of blocks.
* A source's quota is its target in words: some full passes over all its
  blocks and a rest, which is filled with blocks in a hashed permutation. The
  last block drawn is cut, so a source's taken words are its target, rounded.
* The numbers of drawn blocks by source are the root of a tree over the output
  shards. Each node gives its left child a multivariate-hypergeometric share
  of its quotas (as if its blocks were shuffled and cut), the right child the
  rest, until each leaf, a shard, has its exact quota of every source.
* A shard draws its quota of a source as a run of that source's permutation;
  the runs of different shards are disjoint. Inside a shard the drawn
  documents are put in a hashed order.

Running sums over a line are taken in two steps, sums of hashed buckets and
sums inside a bucket, so a source with a third of all rows is not one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.common import SPACE, WORD, row_key, saved, table, text_of, whole_row

#: Contract of the registered query: weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

BLOCK_WORDS = 1000
#: Words of an output shard; the number of shards follows from the total.
SHARD_WORDS = 10_000_000
#: Fewest rows of a bucket in which running sums are taken. Beyond its square, buckets have
#: as many rows as there are buckets, so that neither step grows faster than the root of the rows.
BUCKET_ROWS = 1000
SEED = 7


@dataclass(frozen=True)
class Mix:
    """documents: one row per input row (key, copy, doc_id, source, size, source_size, target, taken).
    draws: one row per document and pass that the mix takes
    (key, copy, pass, words, size, shard, position); words < size: the first words only."""

    documents: DataFrame
    draws: DataFrame


def _targets(sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """sid, weight and target for (source, source_size): shares by weight, none above
    ``repeats`` times its size, the excess shared again among the others.

    With sources ordered by size to weight, the k-th level is what the words
    left by the capped sources before give per weight; the largest level that
    its own source can hold is the one at which all words are placed.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    after = fullest.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * repeats
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    return (sources.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", pick)
            .withColumn("level", left / F.sum("weight").over(after))
            .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= cap, F.col("level"))).over(everything))
            .withColumn("target", F.least(cap.cast("double"), F.col("level") * F.col("weight")))
            .withColumn("quota", F.least(cap, F.round("target").cast("long")))
            .withColumn("passes", F.when(F.col("source_size") > 0,
                                         F.floor(F.col("quota") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
            .drop("level"))


def _running(rows: DataFrame, values: dict[str, Column], ties: list[str]) -> DataFrame:
    """``rows`` with, for each value, its sum over the rows of the same ``sid`` that come
    before in the order of ``at`` (a hashed long) and ``ties``."""
    count = rows.count()
    buckets = max(1, -(-count // max(BUCKET_ROWS, math.isqrt(count))))  # of each sid
    share = F.col("at").cast("double") / F.lit(2.0 ** 64) + 0.5
    bucketed = rows.withColumn("bucket", F.least(F.floor(share * buckets), F.lit(buckets - 1)))
    sums = bucketed.groupBy("sid", "bucket").agg(*[F.sum(v).alias(f"{n}_sum") for n, v in values.items()])
    over = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("sid", "bucket", *[F.coalesce(F.sum(f"{n}_sum").over(over), F.lit(0)).alias(f"{n}_base")
                                          for n in values])
    inside = Window.partitionBy("sid", "bucket").orderBy("at", *ties).rowsBetween(Window.unboundedPreceding, -1)
    out = bucketed.join(base, ["sid", "bucket"])
    for n, v in values.items():
        out = out.withColumn(n, F.col(f"{n}_base") + F.coalesce(F.sum(v).over(inside), F.lit(0))).drop(f"{n}_base")
    return out.drop("bucket")


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(population: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL for a hypergeometric count: of ``population``, ``marked`` are marked and ``drawn``
    are drawn (bigints); ``uniform`` in [0, 1) picks the count by inversion.

    Probabilities follow from the ratio of neighbours, from 12 standard
    deviations and 12 below the mean to as far above; what lies beyond is less
    than a double can tell from nothing.
    """
    def ratio(k: str) -> str:
        return (f"(cast(d.m - ({k} - 1) as double) * (d.n - ({k} - 1)) "
                f"/ (cast({k} as double) * (d.pop - d.m - d.n + {k})))")

    start = "'p', 1D, 'c', 1D"
    total = (f"aggregate(w.steps, named_struct({start}), "
             f"(t, j) -> named_struct('p', t.p * {ratio('j')}, 'c', t.c + t.p * {ratio('j')}), t -> t.c)")
    pick = (f"aggregate(w.steps, named_struct('k', w.low, {start}), (s, k) -> if(s.c >= goal, s, "
            f"named_struct('k', k, 'p', s.p * {ratio('k')}, 'c', s.c + s.p * {ratio('k')})), s -> s.k)")
    steps = ("named_struct('low', b.low, 'steps', "
             "if(b.high > b.low, sequence(b.low + 1, b.high), cast(array() as array<bigint>)))")
    bounds = ("named_struct('low', greatest(0L, d.n - (d.pop - d.m), cast(floor(v.mean - 12 * v.dev - 12) as bigint)), "
              "'high', least(d.m, d.n, cast(ceil(v.mean + 12 * v.dev + 12) as bigint)))")
    spread = ("named_struct('mean', d.n * (d.m / d.pop), 'dev', sqrt(greatest(0D, "
              "d.n * (d.m / d.pop) * (1 - d.m / d.pop) * ((d.pop - d.n) / greatest(1L, d.pop - 1)))))")
    return _let("d", f"named_struct('pop', {population}, 'm', {marked}, 'n', {drawn})",
                _let("v", spread, _let("b", bounds, _let("w", steps, _let("goal", f"({uniform}) * {total}", pick)))))


def _split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, sid, first, blocks): each shard's exact run of every source's drawn blocks.

    ``quotas``: (sid, drawn). A node is the shards from low to below high with a
    number of blocks of each source; level by level it is dealt to two children.
    """
    nodes = quotas.where("drawn > 0").select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "sid",
                                             F.col("drawn").cast("long").alias("blocks"))
    # In a node, sources draw one after the other: the room left in the left child,
    # from the blocks that are left of this and the later sources.
    uniform = f"pmod(xxhash64({seed}, low, high, q.sid), 9007199254740992L) / 9007199254740992D"
    x = hypergeometric("a.pop", "q.blocks", "a.room", uniform)
    after = ("named_struct('room', a.room - x, 'pop', a.pop - q.blocks, 'out', concat(a.out, "
             "array(named_struct('sid', q.sid, 'blocks', q.blocks, 'taken', x))))")
    dealt = f"""aggregate(own, named_struct(
        'room', cast(round(total * ((mid - low) / (high - low))) as bigint), 'pop', total,
        'out', cast(array() as array<struct<sid:int,blocks:bigint,taken:bigint>>)),
        (a, q) -> {_let('x', x, after)}, a -> a.out)"""
    children = """if(high - low = 1, array(named_struct('low', low, 'high', high, 'sid', q.sid, 'blocks', q.blocks)),
        array(named_struct('low', low, 'high', mid, 'sid', q.sid, 'blocks', q.taken),
              named_struct('low', mid, 'high', high, 'sid', q.sid, 'blocks', q.blocks - q.taken)))"""
    width = shards
    while width > 1:
        width = (width + 1) // 2
        nodes = (nodes.groupBy("low", "high")
                 .agg(F.sum("blocks").alias("total"), F.sort_array(F.collect_list(F.struct("sid", "blocks"))).alias("own"))
                 .withColumn("mid", F.expr("cast((low + high + 1) div 2 as int)"))
                 .select("low", "high", "mid", F.explode(F.expr(dealt)).alias("q"))
                 .select(F.explode(F.expr(children)).alias("c")).select("c.*").where("blocks > 0"))
    runs = Window.partitionBy("sid").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    return nodes.select(F.col("low").alias("shard"), "sid", "blocks",
                        F.coalesce(F.sum("blocks").over(runs), F.lit(0)).alias("first"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> Mix:
    """The mix of ``docs(doc_id, text, source)`` to target weights.

    Size is the number of words of a text (null: 0). Sources in code point
    order, null last, weigh ``weights``, repeating. A document of size 0 is
    never drawn. Repeated rows and rows without doc_id are documents of their
    own, repeated ones told apart by ``copy``. Results do not depend on how
    the rows are partitioned, so reruns agree. Other columns are not read. An
    empty table gives an empty mix.
    """
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))
    alike = Window.partitionBy("key").orderBy(F.col("source").asc_nulls_last())
    rows = saved(rows.withColumn("copy", F.row_number().over(alike)), "sizes")
    sources = saved(_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "targets")

    same = F.col("r.source").eqNullSafe(F.col("s.source"))
    named = (rows.alias("r").join(sources.select("source", "sid").alias("s"), same)
             .select("r.key", "r.copy", "r.size", "s.sid").where("size > 0")
             .withColumn("at", F.xxhash64(F.lit(seed), "key", "copy")))
    line = _running(named, {"start": F.col("size")}, ["key", "copy"])
    line = saved(line.withColumn("block", F.floor(F.col("start") / block_words)).drop("at"), "lines")

    blocks = line.groupBy("sid", "block").agg(F.sum("size").alias("block_size"), F.min("start").alias("block_start"))
    blocks = _running(blocks.withColumn("at", F.xxhash64(F.lit(seed + 1), "sid", "block")),
                      {"drawn_before": F.col("block_size"), "rank": F.lit(1)}, ["block"])
    plan = sources.select("sid", "passes", "rest")
    blocks = saved(blocks.join(plan, "sid").drop("at"), "blocks")
    count = F.sum(F.col("passes") + (F.col("drawn_before") < F.col("rest")).cast("long"))
    quotas = saved(blocks.groupBy("sid").agg(count.alias("drawn"), F.count("*").alias("source_blocks")), "quotas")

    words = sources.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    leaves = saved(_split(quotas.select("sid", "drawn"), shards, seed + 2), "leaves")

    # Each pass takes every block; the last one those in which the rest begins.
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))
    drawn = (blocks.join(quotas, "sid").select("*", number.alias("pass"))
             .where("pass < passes OR drawn_before < rest")
             .withColumn("i", F.col("pass") * F.col("source_blocks") + F.col("rank"))
             .withColumn("room", F.when(F.col("pass") < F.col("passes"), F.col("block_size"))
                         .otherwise(F.col("rest") - F.col("drawn_before"))))
    # A block's shard is the leaf whose run holds its number: leaves are laid out in
    # cells of the mean run length, blocks look up the cell of their number.
    cell = F.greatest(F.lit(1).cast("long"), F.floor(F.col("drawn") / shards))
    laid = (leaves.join(quotas.select("sid", "drawn"), "sid")
            .select("sid", "shard", "first", (F.col("first") + F.col("blocks")).alias("end"),
                    F.explode(F.sequence(F.floor(F.col("first") / cell),
                                         F.floor((F.col("first") + F.col("blocks") - 1) / cell))).alias("cell")))
    drawn = (drawn.withColumn("cell", F.floor(F.col("i") / cell)).join(laid, ["sid", "cell"])
             .where("i >= first AND i < end"))
    taken = F.least(F.col("size"), F.col("room") - (F.col("start") - F.col("block_start")))
    draws = (line.join(drawn.select("sid", "block", "pass", "shard", "room", "block_start"), ["sid", "block"])
             .select("key", "copy", "pass", "size", taken.alias("words"), "shard").where("words > 0"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 3), "key", "copy", "pass"), "key", "copy", "pass")
    draws = saved(draws.withColumn("position", F.row_number().over(local)), "draws")

    per_row = draws.groupBy("key", "copy").agg(F.sum("words").alias("taken"))
    documents = (rows.alias("r").join(sources.alias("s"), same)
                 .select("r.*", "s.source_size", "s.target").join(per_row, ["key", "copy"], "left")
                 .withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))))
    return Mix(documents, draws)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix as documents: one row per document and pass drawn, in the columns of ``docs``.

    A document cut at the end of a source's quota keeps its first words, and
    ``n_chars``, if there is such a column, counts what is left.
    """
    draws = mix(docs, weights, repeats).draws
    alike = Window.partitionBy("key").orderBy(F.col("row.source").asc_nulls_last())
    keyed = docs.select(whole_row(docs), row_key().alias("key")).withColumn("copy", F.row_number().over(alike))
    taken = draws.select("key", "copy", "words", (F.col("words") < F.col("size")).alias("cut"))
    words = F.regexp_extract_all(text_of("row.text"), F.lit(f"{WORD}(?:{SPACE})?"), F.lit(0))
    some = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("cut"), some).otherwise(F.col("row.text"))
    made = {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("cut"), F.length(text)).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return keyed.join(taken, ["key", "copy"]).select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, size, source_size, target, taken."""
    return mix(table(spark, sf_dir, "documents")).documents.select("doc_id", "size", "source_size", "target", "taken")
