"""Approximate nearest neighbours by inner product: stable projections, kd-trees, a chi-square stop.

A vector gets one more component so that all are equally long: the larger the inner product
with a query, the smaller the distance. A few Gaussian (2-stable) projections then turn a
distance d into one whose square over d² follows a chi-square law. A kd-tree over the
projections gives a query's projected neighbours in order; each is verified on the whole
vectors, until the next one is so far off that something nearer than the k-th best so far
would lie inside with the asked probability.

The tree is cut at its upper levels into cells, fitted on a bounded sample, and a cell's
rows are dealt into pieces of bounded size, each a tree of its own in a task. A query asks its
home cell first; the k-th best of that says which other cells the stop rule still lets in.
Rows with one vector are one class, searched once, as are queries with one vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import stash

#: Neighbours, projections (even), probability of the stop rule, rows of a leaf.
TOP, PROJECTIONS, CERTAINTY, LEAF = 20, 8, 0.95, 32
#: Most rows and values of a piece, most cells, rows that the cells are fitted on.
PIECE_ROWS, PIECE_VALUES, MOST_CELLS, SAMPLE = 8_192, 1 << 22, 4_096, 65_536
SEED = 23


def chi_square_cdf(x: float, m: int) -> float:
    """Of a sum of ``m`` squared normals, for an even ``m``."""
    half, term, total = x / 2, 1.0, 1.0
    for j in range(1, m // 2):
        term *= half / j
        total += term
    return 1 - math.exp(-half) * total


def chi_square_point(p: float, m: int) -> float:
    """Where that reaches ``p``."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, m) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


@dataclass(frozen=True)
class Projection:
    """Gaussian projections of vectors of up to ``width`` components, shorter ones followed by zeros."""

    width: int
    square: float  # largest squared length of all
    count: int = PROJECTIONS
    seed: int = SEED

    def matrix(self) -> np.ndarray:
        return np.random.default_rng(self.seed).normal(size=(self.width + 1, self.count))

    def of_rows(self, x: np.ndarray, g: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - np.einsum("ij,ij->i", x, x), 0.0))
        return x @ g[:-1] + rest[:, None] * g[-1]

    def of_queries(self, q: np.ndarray, g: np.ndarray) -> np.ndarray:
        return q @ g[:-1]


@dataclass(frozen=True)
class Cells:
    """The upper levels of the kd-tree: node i has the children 2i+1 and 2i+2."""

    axis: np.ndarray
    at: np.ndarray
    depth: int

    @staticmethod
    def fit(sample: np.ndarray, depth: int) -> Cells:
        axis, at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        todo = {0: np.arange(len(sample))}
        for node in range(2**depth - 1):
            rows = todo.pop(node, np.empty(0, np.int64))
            if len(rows) < 2:
                continue
            axis[node] = np.argmax(sample[rows].std(axis=0))
            values = sample[rows, axis[node]]
            at[node] = np.median(values)
            todo[2 * node + 1], todo[2 * node + 2] = rows[values < at[node]], rows[values >= at[node]]
        return Cells(axis, at, depth)

    def of(self, y: np.ndarray) -> np.ndarray:
        node = np.zeros(len(y), np.int64)
        for _ in range(self.depth):
            right = y[np.arange(len(y)), self.axis[node]] >= self.at[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)


def box_distances(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(y), len(low)))
    for j in range(y.shape[1]):
        off = np.maximum(np.maximum(low[None, :, j] - y[:, j, None], y[:, j, None] - high[None, :, j]), 0.0)
        out += off * off
    return out


class Tree:
    """A kd-tree over the projections of a piece's rows; the rows of a leaf stand together."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, y: np.ndarray, leaf: int = LEAF):
        parts, todo = [], [np.arange(len(x))]
        while todo:
            rows = todo.pop()
            spread = np.ptp(y[rows], axis=0) if len(rows) else np.zeros(1)
            if len(rows) <= leaf or not spread.max():
                parts.append(rows)
                continue
            axis, half = int(np.argmax(spread)), len(rows) // 2
            order = np.argpartition(y[rows, axis], half)
            todo += [rows[order[half:]], rows[order[:half]]]
        order = np.concatenate(parts)
        self.ends = np.cumsum([len(p) for p in parts])
        self.starts = self.ends - [len(p) for p in parts]
        self.low = np.array([y[p].min(axis=0) for p in parts])
        self.high = np.array([y[p].max(axis=0) for p in parts])
        self.ids, self.copies, self.x = ids[order], copies[order], x[order]

    def nearest(self, q: np.ndarray, leaves: np.ndarray, k: int, square: float, stop: float, bound: float):
        """(rows, scores) of the best rows so that their copies make ``k``, by score and id, none farther
        than ``bound`` (squared). ``leaves`` are squared distances to the leaves' boxes. Leaves are
        verified in their order, each time twice as many, until the stop rule holds."""
        order = np.argsort(leaves, kind="stable")
        near = leaves[order]
        own = float(np.dot(q, q)) + square
        rows, scores = np.empty(0, np.int64), np.empty(0)
        done, step = 0, 1
        while done < len(order) and near[done] <= stop * bound:
            last = min(int(np.searchsorted(near, stop * bound, side="right")), done + step)
            new = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in order[done:last]])
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, np.einsum("ij,j->i", self.x[new], q)])
            best = np.lexsort((self.ids[rows], -scores))[: k]
            rows, scores = rows[best], scores[best]
            enough = int(np.searchsorted(np.cumsum(self.copies[rows]), k))
            if enough < len(rows):
                rows, scores = rows[: enough + 1], scores[: enough + 1]
                bound = min(bound, max(own - 2 * scores[-1], 0.0))
            done, step = last, step * 2
        inside = own - 2 * scores <= bound * (1 + 1e-12) + 1e-12 * own if len(rows) else slice(0)
        return rows[inside], scores[inside]


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    flat = np.asarray(lists.flatten(), np.float64)
    lengths = np.diff(np.asarray(lists.offsets))
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths] or [np.empty(0, np.int64)])] = flat
    return out


def _sliced(batches: Iterator[pa.RecordBatch], width: int, values: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    step = max(1, values // (width + 1))
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())


def _projected(projection: Projection, queries: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = projection.matrix()
        for b in _sliced(batches, projection.width):
            x = _matrix(b["v"], projection.width)
            y = projection.of_queries(x, g) if queries else projection.of_rows(x, g)
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(y)], [*b.schema.names, "y"])

    return run


def _in_cells(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = cells.of(_matrix(b["y"], len(b["y"][0]))) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64())], [*b.schema.names, "cell"])

    return run


def _open_cells(low: np.ndarray, high: np.ndarray, number: np.ndarray, stop: float):
    """The cells besides the home cell that a query's stop rule lets in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches, len(number)):
            y = _matrix(b["y"], low.shape[1])
            bound = np.array([math.inf if x is None else x for x in b["bound"].to_pylist()])
            visit = (box_distances(y, low, high) <= stop * bound[:, None]) & (number[None, :] != np.asarray(b["cell"])[:, None])
            row, cell = np.nonzero(visit)
            yield pa.RecordBatch.from_arrays([b["cid"].take(pa.array(row)), pa.array(number[cell], pa.int64())], ["cid", "visits"])

    return run


FOUND = "query long, cid long, copies int, score double"


def _search(projection: Projection, k: int, stop: float):
    """Rows in order of the piece, its vectors before the queries asked of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = projection.matrix()
        current, held, tree = None, [], None

        def answers(b: pa.RecordBatch) -> pa.RecordBatch:
            q = _matrix(b["v"], projection.width)
            leaves = box_distances(projection.of_queries(q, g), tree.low, tree.high)
            out = []
            for i, (query, bound) in enumerate(zip(b["id"].to_pylist(), b["bound"].to_pylist())):
                rows, scores = tree.nearest(q[i], leaves[i], k, projection.square, stop, math.inf if bound is None else bound)
                out.append((np.full(len(rows), query, np.int64), tree.ids[rows], tree.copies[rows], scores))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "cid", "copies", "score"])

        for b in _sliced(batches, projection.width):
            piece, asks = np.asarray(b["piece"]), b["asks"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((piece[1:] != piece[:-1]) | (asks[1:] != asks[:-1])) + 1
            for at, to in zip([0, *cuts], [*cuts, b.num_rows]):
                part = b.slice(at, to - at)
                if piece[at] != current:
                    current, held, tree = piece[at], [], None
                if not asks[at]:
                    held.append((np.asarray(part["id"]), np.asarray(part["copies"]), _matrix(part["v"], projection.width)))
                    continue
                if not held and tree is None:
                    continue
                if tree is None:
                    ids, copies, x = (np.concatenate(c) for c in zip(*held))
                    tree, held = Tree(ids, copies, x, projection.of_rows(x, g)), []
                for low in range(0, part.num_rows, 256):
                    yield answers(part.slice(low, 256))

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, once each, as doubles."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & good)


def nearest_vectors(
    vectors: DataFrame, every: int = 20, k: int = TOP, certainty: float = CERTAINTY,
    projections: int = PROJECTIONS, piece_rows: int = PIECE_ROWS, sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``every``, the k rows
    of largest inner product that the search finds; each other row is a candidate.

    A true neighbour is found with a probability of at least ``certainty``. Scores are exact,
    ties go to the smaller vec_id. Rows without an id, and vectors that are null, empty or zero
    or hold nulls or values that are not finite, take no part. Repeated rows (same id and
    vector) are one; an id with two vectors is two rows. A shorter vector counts as
    followed by zeros. Fewer than k candidates are all returned. An empty table gives no rows.

    Driver: the longest length, the cells' sample (up to ``sample`` rows of ``projections`` values),
    and per cell, of which there are at most 4,096, its box and its number of rows.
    """
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stop, most = chi_square_point(certainty, projections), k + 1
    rows = stash(usable(vectors).distinct(), "vectors")
    # Of equal vectors only the k + 1 smallest ids can be among a query's k best.
    turn = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = rows.withColumn("turn", turn).where(F.col("turn") <= most).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stash(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    queries = rows.where(F.col("vec_id") % every == 0).join(classes.select("cid", "v"), "v").select(F.col("vec_id").alias("query_id"), "cid")
    queries = stash(queries, "vector-queries")

    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    seen = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("square")).first()
    if not seen["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    projection = Projection(seen["width"], seen["square"], projections)
    held = max(1, min(piece_rows, PIECE_VALUES // seen["width"]))
    placed = classes.select("cid", "v", F.size("ids").alias("copies")).mapInArrow(
        _projected(projection, queries=False), "cid long, v array<double>, copies int, y array<double>"
    )
    placed = stash(placed, "vectors-projected")
    depth = min(int(math.log2(MOST_CELLS)), max(0, math.ceil(math.log2(seen["n"] / held))))
    fitted = placed.select("cid", "y").orderBy(F.xxhash64("cid"), "cid").limit(sample).select("y").collect()
    cells = Cells.fit(np.array([r["y"] for r in fitted]), depth)
    placed = placed.mapInArrow(_in_cells(cells), "cid long, v array<double>, copies int, y array<double>, cell long")
    placed = stash(placed, "vectors-in-cells")
    sides = [f(F.col("y")[j]).alias(f"{f.__name__}{j}") for j in range(projections) for f in (F.min, F.max)]
    boxes = sorted(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sides).collect(), key=lambda r: r["cell"])
    low, high = (np.array([[r[f"{side}{j}"] for j in range(projections)] for r in boxes]) for side in ("min", "max"))
    number = np.array([r["cell"] for r in boxes])
    pieces = {r["cell"]: -(-r["n"] // held) for r in boxes}
    first, so_far = {}, 0
    for cell, of_cell in pieces.items():
        first[cell], so_far = so_far, so_far + of_cell
    of_cells = spark.createDataFrame([(int(c), first[c], pieces[c]) for c in first], "cell long, first int, pieces int")
    of_cells = F.broadcast(of_cells) if len(first) <= MOST_CELLS else of_cells

    piece: Column = (F.col("first") + F.pmod(F.xxhash64("cid"), "pieces")).cast("int").alias("piece")
    stored = placed.join(of_cells, "cell").select(
        piece, F.lit(False).alias("asks"), F.col("cid").alias("id"), "v", "copies", F.lit(None).cast("double").alias("bound")
    )
    asked = classes.select("cid", "v").join(queries.select("cid").distinct(), "cid")
    asked = asked.mapInArrow(_projected(projection, queries=True), "cid long, v array<double>, y array<double>")
    asked = stash(asked.mapInArrow(_in_cells(cells), "cid long, v array<double>, y array<double>, cell long"), "vector-asked")

    def search(visits: DataFrame) -> DataFrame:
        """``visits`` are (cid, visits, bound, v); a cell without rows has nothing to answer."""
        at = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("pieces") - 1))
        posed = visits.join(of_cells, F.col("visits") == of_cells.cell).select(
            at.alias("piece"), F.lit(True).alias("asks"), F.col("cid").alias("id"), "v", F.lit(0).alias("copies"), "bound"
        )
        both = stored.unionByName(posed).repartitionById(n, F.col("piece")).sortWithinPartitions("piece", "asks", "id")
        return both.mapInArrow(_search(projection, most, stop), FOUND)

    at_home = stash(search(asked.select("cid", F.col("cell").alias("visits"), F.lit(None).cast("double").alias("bound"), "v")), "vectors-at-home")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "cid")
    reached = F.sum("copies").over(best_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bound = at_home.withColumn("reached", reached).where(F.col("reached") >= most).groupBy("query").agg(F.max("score").alias("kth"))
    own = F.aggregate("v", F.lit(projection.square), lambda a, x: a + x * x)
    bounded = asked.join(bound, F.col("cid") == F.col("query"), "left").select(
        "cid", "v", "y", "cell", F.greatest(own - 2 * F.col("kth"), F.lit(0.0)).alias("bound")
    )
    bounded = stash(bounded.withColumn("bound", F.when(F.col("bound").isNotNull(), F.col("bound"))), "vectors-bounded")
    onward = bounded.select("cid", "y", "cell", "bound").mapInArrow(_open_cells(low, high, number, stop), "cid long, visits long")
    farther = search(onward.join(bounded.select("cid", "bound", "v"), "cid"))

    found = at_home.unionByName(stash(farther, "vectors-farther"))
    in_turn = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    named = found.join(classes.select("cid", "ids"), "cid").select("query", "cid", "score", "ids", F.col("ids")[0].alias("least"))
    named = named.withColumn("turn", F.row_number().over(in_turn)).where(F.col("turn") <= most)
    single = named.select("query", "cid", "score", F.explode("ids").alias("vec_id"))
    ranked = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        queries.withColumnRenamed("cid", "query").join(single, "query")
        .where((F.col("cid") != F.col("query")) | (F.col("vec_id") != F.col("query_id")))
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
