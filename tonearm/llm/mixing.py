"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are dealt into blocks by hash, and each source owes the mix
a quota of blocks. A tree splits the quotas: at each node the shards are halved, and
the left half's share of every source is one multivariate-hypergeometric draw, so each
shard is an exact sample of the mix. Shards then draw disjoint runs of each source's
permuted blocks, and rows are shuffled inside their shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import as_row, from_row, stash, whole

WORD = r"[^\x20\x09-\x0D]+"
#: Least and most words of a block; at most MOST_BLOCKS blocks, beyond that blocks grow with the data.
SMALL_BLOCK, LARGE_BLOCK, MOST_BLOCKS = 1_024, 131_072, 1_000_000
#: Up to so many sources their table (a few dozen bytes a source) is broadcast.
BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source."""

    source: str | None
    size: int
    target: float
    passes: int
    rest: int
    blocks: int


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def share_out(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Split ``total`` by weight; no share above ``most`` times its size, excess reshared."""
    shares: list[float] = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                shares[i] = left * weights[i] / weight
            break
        for i in over:
            shares[i] = float(most * sizes[i])
            left -= shares[i]
        open_ = [i for i in open_ if i not in set(over)]
    return shares


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Rows: shards, columns: sources. Each node's draw is without replacement, so columns add up."""
    if shards == 1:
        return quotas[None, :]
    half = shards // 2
    left = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * half // shards, method="marginals")
    return np.vstack([split_quotas(left, half, rng), split_quotas(quotas - left, shards - half, rng)])


def plan_shares(sources: list[tuple[str | None, int]], weights: Sequence[float], most: int, shards: int) -> list[Share]:
    """Sources by code point, null last, weigh ``weights`` in turn."""
    ordered = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    total = sum(size for _, size in ordered)
    own = [weights[i % len(weights)] for i in range(len(ordered))]
    targets = share_out([size for _, size in ordered], own, total, most)
    block = max(SMALL_BLOCK, min(LARGE_BLOCK, total // (64 * shards)), -(-total // MOST_BLOCKS))
    out = []
    for (source, size), target in zip(ordered, targets):
        goal = min(round(target), most * size)
        passes, rest = divmod(goal, size) if size else (0, 0)
        out.append(Share(source, size, target, passes, rest, max(1, -(-size // block))))
    return out


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3,
    shards: int = 64, seed: int = 17, keep_columns: bool = False,
) -> DataFrame:
    """Per row of ``docs``: doc_id, size (words), source_size, target, taken, draws.

    A source gives whole passes over all its documents and, for the rest of its
    target, the first of its permuted blocks and documents. Documents are taken whole: the
    one at the end of that run is taken if this comes nearer to the target, or as near,
    than leaving it. ``draws`` lists the shard and the words of every time the row is taken,
    ``taken`` is their sum, ``shuffle_key`` orders rows inside a shard. With
    ``keep_columns`` the struct ``row`` has the columns of ``docs``.

    Null and empty texts have size 0 and are never taken, null sources are a source of
    their own, repeated rows count each, an empty table gives no rows. The table of
    sources, one row each, is the only thing brought to the driver.
    """
    spark = docs.sparkSession
    mark = F.xxhash64(F.lit(seed), "doc_id")
    sized = stash(docs.select("doc_id", F.col("source").alias("mix_source"), word_count(whole()).alias("size")), "mix-sizes")
    totals = sized.groupBy("mix_source").agg(F.sum("size").alias("n")).collect()
    plan = plan_shares([(r["mix_source"], r["n"]) for r in totals], weights, most, shards)

    schema = "src string, source_size long, target double, passes long, rest long, n_blocks long"
    shares = spark.createDataFrame([(s.source, s.size, s.target, s.passes, s.rest, s.blocks) for s in plan], schema)
    if len(plan) <= BROADCAST_SOURCES:
        shares = F.broadcast(shares)

    def placed(rows: DataFrame) -> DataFrame:
        joined = rows.join(shares, F.col("mix_source").eqNullSafe(F.col("src")))
        return joined.withColumn("mix_block", F.pmod(mark, "n_blocks")).drop("src")

    by_source = Window.partitionBy("mix_source").orderBy(F.xxhash64(F.lit(seed), F.lit("part"), "mix_block"), "mix_block")
    blocks = (
        placed(sized)
        .groupBy("mix_source", "mix_block", "passes", "rest")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("part", F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), "words"))
    )
    blocks = stash(blocks.select("mix_source", "mix_block", "passes", "part"), "mix-blocks")
    partial = {r["mix_source"]: r["n"] for r in blocks.where("part > 0").groupBy("mix_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    filled = {r["mix_source"]: r["n"] for r in blocks.groupBy("mix_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = np.array([s.passes * filled.get(s.source, 0) + partial.get(s.source, 0) for s in plan], dtype=np.int64)
    ends = np.cumsum(split_quotas(quotas, shards, np.random.default_rng(seed)), axis=0)
    runs = spark.createDataFrame([(s.source, ends[:, i].tolist()) for i, s in enumerate(plan)], "src string, ends array<long>")
    if len(plan) <= BROADCAST_SOURCES:
        runs = F.broadcast(runs)

    in_turn = Window.partitionBy("mix_source").orderBy("mix_pass", F.xxhash64(F.lit(seed), "mix_pass", "mix_block"), "mix_block")
    drawn = (
        blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "passes")).alias("mix_pass"))
        .where("mix_pass < passes or part > 0")
        .withColumn("turn", F.row_number().over(in_turn) - 1)
        .join(runs, F.col("mix_source").eqNullSafe(F.col("src")))
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("turn"))))
        .groupBy("mix_source", "mix_block")
        .agg(F.first("part").alias("part"), F.array_sort(F.collect_list(F.struct("mix_pass", "shard"))).alias("turns"))
        .select(F.col("mix_source").alias("b_source"), F.col("mix_block").alias("b_block"), "part", "turns")
    )

    rows = sized
    if keep_columns:
        rows = docs.select(as_row(docs), "doc_id", F.col("source").alias("mix_source"), word_count(whole()).alias("size"))
    same_block = F.col("mix_source").eqNullSafe(F.col("b_source")) & (F.col("mix_block") == F.col("b_block"))
    within = (
        Window.partitionBy("mix_source", "mix_block")
        .orderBy(F.xxhash64(F.lit(seed), F.lit("row"), "doc_id"), "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("size").over(within), F.lit(0))
    left = F.coalesce("part", F.lit(0)) - first  # words of the run that remain for this document and those after it
    part = F.when((left > 0) & (2 * left >= F.col("size")), F.col("size")).otherwise(0)
    out = placed(rows).join(drawn, same_block, "left").withColumn("mix_part", part)
    draws = F.filter(
        F.transform(
            F.coalesce("turns", F.array().cast("array<struct<mix_pass:bigint,shard:int>>")),
            lambda t: F.struct(
                t["shard"].alias("shard"),
                F.when(t["mix_pass"] < F.col("passes"), F.col("size")).otherwise(F.col("mix_part")).alias("words"),
            ),
        ),
        lambda d: d["words"] > 0,
    )
    out = out.withColumns({
        "draws": draws,
        "taken": F.aggregate(draws, F.lit(0).cast("long"), lambda total, d: total + d["words"]),
        "shuffle_key": F.xxhash64(F.lit(seed), F.lit("shuffle"), "doc_id"),
    })
    own = ["row"] * keep_columns
    return out.select("doc_id", "size", "source_size", "target", "taken", "draws", "shuffle_key", *own)


def mixed_documents(docs: DataFrame, shards: int = 64, seed: int = 17, **parameters) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row, whole, for every time a document is taken.

    Rows are written by shard and shuffled in it: a shard is one or several partitions that
    follow each other, each a range of the shuffle key and sorted by it, so large shards
    are no single task."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = -(-n // shards)
    taken = mix_sources(docs, shards=shards, seed=seed, keep_columns=True, **parameters)
    each = taken.select("row", "doc_id", F.posexplode("draws").alias("turn", "draw"))
    key = F.xxhash64(F.lit(seed), F.lit("shuffle"), "doc_id", "turn")
    part = F.col("draw.shard") * slices + F.pmod(F.shiftrightunsigned(key, 40), F.lit(1 << 24)) * slices / (1 << 24)
    placed = each.select("row", key.alias("mix_key"), F.floor(part).cast("int").alias("mix_part"))
    placed = placed.repartitionById(shards * slices, F.col("mix_part")).sortWithinPartitions("mix_part", "mix_key")
    return placed.select(*from_row(docs))
