"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 6).

Documents fall into BLOCKS pseudo-random blocks per source.  The mix draws whole blocks: every
block of a source as often as its target holds the source, then a prefix of a permutation of the
blocks that comes nearest to the rest.  A binary tree over the output shards splits the exact
block quotas of all sources: at each node the left half's share is multivariate hypergeometric,
seeded by the node, so every shard computes its own path alone and all agree.  The leaf gives a
shard disjoint slices of the permuted blocks of every source; rows are shuffled inside shards.

Targets: sources by code point, null last, weigh ``weights`` in turn and share all words; a
target stops at LIMIT times its source's size, and the excess is shared again by weight.

Defined results: a null text has size 0 and takes 0 words; a null source is a source of its own;
without words all targets are 0 and nothing is taken; equal rows (same id and text) are drawn
alike, and so are blocks of equal rank (by their number).  Texts of any length count whole; other
columns are kept as they are, whatever their names.  More than ``max_sources`` sources raise: their totals are the only rows the driver reads.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import common

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCKS = 4096
SHARD_WORDS = 2_000_000
MAX_SOURCES = 10_000
BROADCAST_ROWS = 1_000_000
SEED = 20_240


def size_of(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long")


def block_of(seed: int = SEED):
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit(""))), F.lit(BLOCKS)).cast("int")


def targets(sizes: list[int], weights=WEIGHTS, limit: int = LIMIT) -> list[float]:
    """Words each source (in order) should give."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, budget, free = [0.0] * len(sizes), sum(sizes), set(range(len(sizes)))
    while free and budget > 0:
        total = sum(weight[i] for i in free)
        over = [i for i in free if budget * weight[i] > limit * sizes[i] * total]
        if not over:
            for i in free:
                out[i] = budget * weight[i] / total
            break
        for i in over:
            out[i] = float(limit * sizes[i])
            budget -= limit * sizes[i]
            free.remove(i)
    return out


def split(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first draw, number of draws) of every source for one shard, down the splitting tree.

    Shard j holds exactly D * (j + 1) // shards - D * j // shards of the D draws."""
    quotas, first = quotas.copy(), np.zeros_like(quotas)
    total, lo, hi, node = int(quotas.sum()), 0, shards, 1
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left_total = total * mid // shards - total * lo // shards
        draw = np.random.Generator(np.random.PCG64([seed, node]))
        left = draw.multivariate_hypergeometric(quotas, left_total, method="marginals") if quotas.sum() < 10 ** 9 else _large(draw, quotas, left_total)
        if shard < mid:
            quotas, hi, node = left, mid, 2 * node
        else:
            quotas, first, lo, node = quotas - left, first + left, mid, 2 * node + 1
    return first, quotas


def _large(draw: np.random.Generator, quotas: np.ndarray, n: int) -> np.ndarray:
    """The same for counts beyond the sampler's range: proportional parts, the rest by chance."""
    part = [int(q) * n // int(quotas.sum()) for q in quotas]
    for i in draw.permutation(len(part)):
        add = min(n - sum(part), int(quotas[i]) - part[i])
        part[i] += add
    return np.array(part, quotas.dtype)


_LEAF = pa.schema([("__mix_sid", pa.int32()), ("__mix_draw", pa.int64()), ("shard", pa.int64())])


def _leaves(batches, quotas, shards, seed):
    for batch in batches:
        for shard in batch.column("id").to_pylist():
            first, n = split(quotas, shards, shard, seed)
            for sid in np.flatnonzero(n):
                yield common.rows(_LEAF, {"__mix_sid": np.full(n[sid], sid, np.int32), "__mix_draw": np.arange(first[sid], first[sid] + n[sid]),
                                          "shard": np.full(n[sid], shard, np.int64)})


def _maybe_broadcast(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def plan_mix(sized: DataFrame, seed: int = SEED, max_sources: int = MAX_SOURCES) -> tuple[DataFrame, DataFrame, int]:
    """(sources, draws, number of draws) for rows of (source, _block, size).

    sources: source, source_size, target, _sid.  draws: one row per drawn block and draw with
    _sid, _block and shard."""
    spark = sized.sparkSession
    blocks = common.written(sized.groupBy("source", "__mix_block").agg(F.sum("size").alias("words")), "mix-blocks")
    found = blocks.groupBy("source").agg(F.sum("words").alias("words"), F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    aims = targets([r["words"] for r in found])
    rows = []
    for sid, (r, aim) in enumerate(zip(found, aims)):
        passes = min(LIMIT, int(aim / r["words"] + 1e-12)) if r["words"] else 0
        rows.append((r["source"], r["words"], aim, sid, passes, max(0.0, aim - passes * r["words"]) if passes < LIMIT else 0.0, r["n"]))
    sources = spark.createDataFrame(rows, "source string, source_size bigint, target double, __mix_sid int, _passes int, _rest double, _n bigint")
    order = Window.partitionBy("__mix_sid").orderBy(F.xxhash64(F.lit(seed + 1), "__mix_sid", "__mix_block"), "__mix_block")
    ranked = (blocks.join(F.broadcast(sources), blocks["source"].eqNullSafe(sources["source"]))
              .select("__mix_sid", "__mix_block", "words", "_passes", "_rest", "_n",
                      (F.row_number().over(order) - 1).alias("_pos"),
                      (F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words") / 2).alias("_mid"))
              .withColumn("_times", F.col("_passes") + ((F.col("_mid") < F.col("_rest")) & (F.col("words") > 0)).cast("int")))
    drawn = common.written(
        ranked.filter("_times > 0").select("__mix_sid", "__mix_block", "_passes", "_n", "_pos", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("_pass"))
        .withColumn("__mix_draw", F.row_number().over(Window.partitionBy("__mix_sid").orderBy("_pass", "_pos")).cast("long") - 1)
        .select("__mix_sid", "__mix_block", "__mix_draw"), "mix-drawn")
    quotas = np.zeros(len(found), np.int64)
    for r in drawn.groupBy("__mix_sid").agg(F.count("*").alias("q")).collect():
        quotas[r["__mix_sid"]] = r["q"]
    total = int(quotas.sum())
    shards = max(1, min(total, math.ceil(sum(aims) / SHARD_WORDS)))        # a shard holds a block at least
    leaves = spark.range(shards if total else 0).transform(
            common.map_arrow,
        partial(_leaves, quotas=quotas, shards=shards, seed=seed), "__mix_sid int, __mix_draw bigint, shard bigint")
    draws = common.written(drawn.join(leaves, ["__mix_sid", "__mix_draw"]).select("__mix_sid", "__mix_block", "shard", "__mix_draw"), "mix-draws")
    return sources.select("source", "source_size", "target", "__mix_sid"), draws, total


@common.isolated("doc_id", "text", "source")
def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document once for each draw of its block, with the columns of
    ``docs``, dealt to the output shards and shuffled inside each."""
    names = docs.columns
    sources, draws, total = plan_mix(docs.select("source", size_of().alias("size"), block_of(seed).alias("__mix_block")), seed)
    keyed = docs.withColumn("__mix_block", block_of(seed)).join(
        F.broadcast(sources.withColumnRenamed("source", "__mix_source").select("__mix_source", "__mix_sid")), F.col("source").eqNullSafe(F.col("__mix_source")))
    taken = keyed.join(_maybe_broadcast(draws.withColumnRenamed("shard", "__mix_shard"), total), ["__mix_sid", "__mix_block"])
    return (taken.repartition("__mix_shard").sortWithinPartitions("__mix_shard", F.xxhash64(F.lit(seed + 2), "__mix_draw", "doc_id", "text"), "doc_id")
            .select(*names))


def op6_mix(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    sized = common.written(docs.select("doc_id", "source", size_of().alias("size"), block_of().alias("__mix_block")), "mix-sizes")
    sources, draws, total = plan_mix(sized)
    times = draws.groupBy("__mix_sid", "__mix_block").agg(F.count("*").alias("_times"))
    s = sources.withColumnRenamed("source", "__mix_source")
    return (sized.join(F.broadcast(s), F.col("source").eqNullSafe(F.col("__mix_source")))
            .join(_maybe_broadcast(times, total), ["__mix_sid", "__mix_block"], "left")
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("_times", F.lit(0))).alias("taken")))


QUERIES = {"op6_mix": op6_mix}
ORACLES: dict[str, str] = {}
