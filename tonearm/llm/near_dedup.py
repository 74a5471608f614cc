"""Near duplicates by MinHash and a multi-index Hamming join.

A document's shingle set gives a signature of ``SYMBOLS`` minima, 8 bits of each. The
signature is split into chunks. If two signatures differ in at most ``DISTANCE`` symbols,
some chunk differs in at most one (13 chunks, 25 < 2 * 13), so with every symbol of
every chunk left out in turn, the two share a key. Every pair within the distance is found.

A key's documents are joined to its first and to the one before, and links are confirmed on
the full sets. What these leave in different components is compared again inside keys of over
three documents, on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import SPACES, as_row, from_row, slices, stash, whole
from tonearm.llm.graph import components

CHUNKS, CHUNK = 13, 5
SYMBOLS, DISTANCE = CHUNKS * CHUNK, 2 * CHUNKS - 1
#: Rows a side whose full sets are compared at once.
SET_BLOCK = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(2024)
_FACTORS = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles; fewer words than ``width`` are one shingle.

    bytes.lower and bytes.split know ASCII letters and white space only, as the words are defined."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    each = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(width, len(each))
    n = len(each) - width + 1
    total = each[:n].copy()
    for i in range(1, width):
        total = mixed(total) + each[i : i + n]
    return np.unique(mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Eight bits of the minimum of each of ``SYMBOLS`` hash functions, a number for each chunk."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, part.min(axis=0))
    symbols = (mixed(least) >> np.uint64(56)).astype(np.int64).reshape(CHUNKS, CHUNK)
    return (symbols << (8 * np.arange(CHUNK, dtype=np.int64))).sum(axis=1)


def _sign(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames):
            sets = [shingle_hashes(t, width) for t in pdf["text"]]
            digests = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8") for s in sets]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"),
                "n_shingles": [len(s) for s in sets],
                "d1": [d[0] for d in digests],
                "d2": [d[1] for d in digests],
                "chunks": [signature(s) if len(s) else None for s in sets],
            })

    return run


def size_ranges(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The power of two below n, and whether n can match sets of the range before (0.8 of it)."""
    range_ = np.frexp(n.astype(float))[1] - 1
    return range_, (range_ > 0) & (4 * n < 5 * (1 << range_.astype(np.int64)))


def _keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, node): slot, range of sizes and the four symbols left, side by side in 63 bits."""
    for pdf in frames:
        for at in range(0, len(pdf), 5_000):
            part = pdf.iloc[at : at + 5_000]
            if not len(part):
                continue
            packed = np.stack(part["chunks"])
            left_out = np.int64((1 << 40) - 1) ^ (np.int64(0xFF) << (8 * np.arange(CHUNK, dtype=np.int64)))
            slots = np.arange(SYMBOLS, dtype=np.int64).reshape(CHUNKS, CHUNK) << 48
            keys = ((packed[:, :, None] & left_out) | slots).reshape(len(part), -1)
            range_, lower = size_ranges(part["n"].to_numpy())
            node = part["node"].to_numpy()
            range_ = range_.astype(np.int64)
            yield pd.DataFrame({
                "key": np.concatenate([(keys | (range_ << 40)[:, None]).ravel(), (keys | ((range_ - 1) << 40)[:, None])[lower].ravel()]),
                "node": np.concatenate([np.repeat(node, SYMBOLS), np.repeat(node[lower], SYMBOLS)]),
            })


def differing(a: Column, b: Column, chunk: int) -> Column:
    """One bit for each symbol of a chunk that differs: a byte's bits are folded onto its lowest."""
    x = F.get(a, chunk).bitwiseXOR(F.get(b, chunk))
    for shift, mask in ((4, 0x0F0F0F0F0F), (2, 0x0303030303), (1, 0x0101010101)):
        x = x.bitwiseOR(F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(mask)))
    return x.bitwiseAND(F.lit(0x0101010101))


def distance(a: Column, b: Column) -> Column:
    """How many symbols of two signatures differ."""
    counts = [F.bit_count(differing(a, b, i)) for i in range(CHUNKS)]
    return sum(counts[1:], counts[0])


def _grid(rows: DataFrame, by: str, left: Column, right: Column, block: int) -> DataFrame:
    """Rows in cells (by, row, col) of at most ``block`` rows a side; sides are flags of the rows."""
    key, order = Window.partitionBy(by), Window.partitionBy(by).orderBy("node")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    count = lambda side, w: F.sum(side.cast("long")).over(w)
    rows = rows.withColumns({
        "rows": F.ceil(count(left, key) / block), "cols": F.ceil(count(right, key) / block),
        "row_at": F.floor((count(left, so_far) - 1) / block), "col_at": F.floor((count(right, so_far) - 1) / block),
        "left": left, "right": right,
    }).where("rows > 0 and cols > 0")
    rows = stash(rows, "near-cells")
    zero = F.lit(0).cast("long")
    own = [c for c in rows.columns if c not in ("rows", "cols", "row_at", "col_at", "left", "right")]
    small = rows.where("rows = 1 and cols = 1").select(*own, zero.alias("row"), zero.alias("col"), "left", "right")
    cell = lambda r, c, is_left: F.struct(
        r.cast("long").alias("row"), c.cast("long").alias("col"), F.lit(is_left).alias("left"), F.lit(not is_left).alias("right")
    )
    none = F.array().cast("array<struct<row:bigint,col:bigint,left:boolean,right:boolean>>")
    as_left = F.when(F.col("left"), F.transform(F.sequence(zero, F.col("cols") - 1), lambda c: cell(F.col("row_at"), c, True)))
    as_right = F.when(F.col("right"), F.transform(F.sequence(zero, F.col("rows") - 1), lambda r: cell(r, F.col("col_at"), False)))
    places = F.concat(F.coalesce(as_left, none), F.coalesce(as_right, none))
    large = rows.where("rows > 1 or cols > 1").withColumn("cell", F.explode(places)).select(*own, "cell.*")
    return small.unionByName(large)


def _linked(percent: int):
    """Components that the two sides of a cell link, from their full sets; each pair of components once."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        left, right = cell[cell["left"]], cell[cell["right"]]
        sizes, components_of = right["hashes"].map(len).to_numpy(), right["component"].to_numpy()
        owner, every = np.repeat(np.arange(len(right)), sizes), np.concatenate([*right["hashes"], np.empty(0, np.int64)])
        order = np.argsort(every, kind="stable")
        owner, every = owner[order], every[order]
        linked = set()
        for component, own in zip(left["component"], left["hashes"]):
            low, high = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
            shared = np.bincount(owner[spans(low, high)], minlength=len(right))
            hit = (100 * shared >= percent * (len(own) + sizes - shared)) & (components_of != component)
            linked.update((min(component, c), max(component, c)) for c in np.unique(components_of[hit]).tolist())
        return pd.DataFrame(sorted(linked), columns=["a", "b"], dtype="int64")

    return run


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    lengths = ends - starts
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _sets(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames):
            sets = [shingle_hashes(t, width).view(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"node": pdf["doc_id"], "hashes": sets})

    return run


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, hashes) of the documents in ``nodes`` (node); only their texts are hashed again."""
    nodes = stash(nodes.select(F.col("node").alias("doc_id")).distinct(), "near-nodes")
    texts = docs.select("doc_id", whole().alias("text")).join(nodes, "doc_id", "left_semi")
    return stash(texts.mapInPandas(_sets(width), "node long, hashes array<long>"), "near-sets")


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    sets = full_sets(docs, pairs.select(F.col("a").alias("node")).union(pairs.select("b")), width)
    of = lambda side: sets.select(F.col("node").alias(side), F.col("hashes").alias(f"set_{side}"))
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    size = F.size("set_a") + F.size("set_b")
    checked = pairs.join(of("a"), "a").join(of("b"), "b").withColumns({"shared": shared, "both": size})
    return stash(checked.where(100 * F.col("shared") >= percent * (F.col("both") - F.col("shared"))).select("a", "b").distinct(), "near-links")


def links_across(docs: DataFrame, members: DataFrame, found: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs of components that documents of keys (key, members, node, component) still link.

    Of keys of up to three members every pair was compared before. What lies outside a key's
    largest component is compared with that component as a whole and among itself: once for
    each such component, whatever the number of keys they share, on the full sets, in cells
    of bounded size. A cell gives each pair of components once, never its pairs of documents.
    """
    own, whole_key = Window.partitionBy("key", "component"), Window.partitionBy("key")
    members = members.repartition("key").withColumn("held", F.count(F.lit(1)).over(own))
    members = members.withColumn("main", F.max(F.struct("held", "component")).over(whole_key)["component"])
    others = members.where("members > 3 and component <> main")
    outside = stash(others.select(F.col("main").alias("group"), "node", "component").distinct(), "near-others")

    inside = found.join(outside.select(F.col("group").alias("component")).distinct(), "component", "left_semi")
    alone = outside.select("group").distinct().join(inside.select(F.col("component").alias("group")).distinct(), "group", "left_anti")
    inside = inside.select(F.col("component").alias("group"), "node").union(alone.select("group", F.col("group").alias("node")))
    inside = inside.select("group", "node", F.col("group").alias("component"))
    sides = outside.withColumn("outer", F.lit(True)).unionByName(inside.withColumn("outer", F.lit(False)))
    sets = full_sets(docs, sides.select("node"), width)
    cells = _grid(sides, "group", F.col("outer"), F.lit(True), SET_BLOCK).drop("outer").join(sets, "node")
    linked = cells.groupBy("group", "row", "col").applyInPandas(_linked(percent), "a long, b long")
    return stash(linked.distinct(), "near-links")


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Rows are linked if their sets' intersection is at least ``percent`` of the union, and
    rows with equal sets are one class, which is compared once. Empty sets are linked
    with nothing. Rows that share a doc_id are one document: what either is linked with
    belongs to it. Rows without a doc_id are linked with nothing.
    """
    if percent < 80:
        raise ValueError("sizes and signatures are laid out for a similarity of 0.8 or more")
    schema = "doc_id long, n_shingles long, d1 long, d2 long, chunks array<long>"
    signed = stash(docs.select("doc_id", whole().alias("text")).mapInPandas(_sign(width), schema), "near-signed")
    classes = (
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("chunks").alias("chunks"))
    )
    classes = stash(classes, "near-classes")

    keyed = classes.select("node", "n", "chunks").mapInPandas(_keys, "key long, node long")
    by_key = Window.partitionBy("key").orderBy("node")
    placed = keyed.select(
        "key", "node",
        F.first("node").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("first"),
        F.lag("node").over(by_key).alias("before"),
        F.count(F.lit(1)).over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("members"),
    )
    placed = stash(placed.where("members > 1"), "near-keys")
    pairs = placed.select(F.explode(F.array_distinct(F.array("first", "before"))).alias("a"), F.col("node").alias("b")).where("a < b").distinct()
    signs = classes.select("node", "chunks")
    of = lambda side: signs.select(F.col("node").alias(side), F.col("chunks").alias(f"chunks_{side}"))
    close = distance(F.col("chunks_a"), F.col("chunks_b")) <= DISTANCE
    pairs = stash(pairs.join(of("a"), "a").join(of("b"), "b").where(close).select("a", "b").distinct(), "near-pairs")
    links = confirmed(docs, pairs, percent, width)
    found = stash(components(links), "near-components")

    # Keys of over three documents whose documents are not yet in one component.
    members = placed.select("key", "node", "members").join(found, "node", "left")
    members = members.select("key", "members", "node", F.coalesce("component", "node").alias("component"))
    more = links_across(docs, members, found, percent, width)
    if more.limit(1).count():
        found = stash(components(links.union(more)), "near-components")

    rows = signed.join(classes.select("d1", "d2", "node"), ["d1", "d2"], "left")
    rows = rows.join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates: that of the smallest doc_id.

    Of rows that share this doc_id, the one with the smallest text stays. Rows without
    words or without a doc_id all stay."""
    kept = near_duplicates(docs, percent, width).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(as_row(docs), "doc_id", "text", (F.btrim(whole(), F.lit(SPACES)) == "").alias("empty"))
    rows = rows.join(kept, "doc_id", "left_semi")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("empty", "text"))
    rows = rows.withColumn("turn", turn).where("turn = 1 or empty")
    return rows.select(*from_row(docs)).unionByName(docs.where("doc_id is null"))
