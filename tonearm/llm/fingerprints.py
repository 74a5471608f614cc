"""Document fingerprints: bottom-k sketches of word-shingle hashes, as DataFrame expressions.

A sketch is the ascending array of the ``k`` smallest distinct hashes. Sketches of
parts merge into the sketch of the whole; two sketches estimate resemblance and
containment, one estimates how many distinct shingles there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import SPACES, whole

K, WIDTH = 128, 5
#: Documents in a bucket of neighbours, and the most buckets.
BUCKET_DOCS, MOST_BUCKETS = 20_000, 65_536


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """Add the sketch of column ``text``. Shorter texts are one shingle, empty ones none.

    Words are separated by white space, case is ignored."""
    words, hashes = f"{out}_words", f"{out}_hashes"
    trimmed = F.btrim(F.lower(F.col(text)), F.lit(SPACES))
    hashed = F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    # Columns of their own: an expression inside the lambda would be worked out per shingle.
    df = df.withColumn(words, F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(hashed))
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - width + 1)
    many = F.transform(starts, lambda i: F.xxhash64(*(F.element_at(words, i + j) for j in range(width))))
    few = F.when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(hashes, F.when(n >= width, many).otherwise(few))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(words, hashes)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches were made of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated intersection over union; two empty sketches are alike, one is not."""
    union = merge(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63 + 1) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first document's shingles that the second has."""
    of_union = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    share = F.least(F.lit(1.0), of_union / distinct_shingles(a, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(share)


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _splits(docs: DataFrame, buckets: int) -> tuple[list[int], int | None]:
    """Ids at which buckets start (all but the first bucket's), and the first id."""
    marks = ",".join(str(i / buckets) for i in range(1, buckets))
    quantiles = F.expr(f"percentile_approx(doc_id, array({marks}), {20 * buckets})") if buckets > 1 else F.array()
    row = docs.agg(quantiles.alias("q"), F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    first = None if row["nulls"] else row["least"]
    return sorted({q for q in row["q"] or [] if q != row["least"]}), first


def _bucket(splits: list[int]) -> Column:
    """How many splits are not above doc_id: first by every r-th split, then within r."""
    if not splits:
        return F.lit(0)
    r = max(1, int(len(splits) ** 0.5))
    of = lambda xs: "array(" + ",".join(f"{x}L" for x in xs) + ")"
    coarse, fine = splits[r - 1 :: r], [splits[i : i + r] for i in range(0, len(splits), r)]
    passed = F.size(F.filter(F.expr(of(coarse) if coarse else "cast(array() as array<bigint>)"), lambda s: s <= F.col("doc_id")))
    rest = F.coalesce(F.get(F.expr("array(" + ",".join(map(of, fine)) + ")"), passed), F.array().cast("array<bigint>"))
    return F.when(F.col("doc_id").isNull(), 0).otherwise(passed * r + F.size(F.filter(rest, lambda s: s <= F.col("doc_id"))))


def with_next(docs: DataFrame, columns: dict[str, str], n_buckets: int | None = None) -> DataFrame:
    """Add columns of the next row by ascending doc_id (then text); after the last comes the first.

    Ids are cut into buckets at actual ids, so each bucket's last row finds its
    successor in a copy of the next bucket's first row: one shuffle, no global sort.
    Null ids come first.
    """
    if n_buckets is None:
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_buckets = min(max(4 * parts, docs.count() // BUCKET_DOCS), MOST_BUCKETS)
    splits, first = _splits(docs, n_buckets)
    bucket, last = F.col("next_bucket"), len(splits)
    starts = "array(" + ",".join(f"{s}L" for s in splits) + ")" if splits else "cast(array() as array<bigint>)"
    at = lambda b, place: F.struct(b.cast("int").alias("bucket"), F.lit(place).alias("place"))
    opens = F.coalesce(F.col("doc_id") == F.get(F.expr(starts), bucket - 1), F.lit(False))
    none = F.array().cast("array<struct<bucket:int,place:int>>")
    places = F.concat(
        F.array(at(bucket, 0)),
        F.when(opens, F.array(at(bucket - 1, 1))).otherwise(none),
        F.when(F.col("doc_id").eqNullSafe(F.lit(first).cast("long")), F.array(at(F.lit(last), 2))).otherwise(none),
    )
    rows = docs.withColumn("next_bucket", _bucket(splits)).withColumn("next_at", F.explode(places))
    order = Window.partitionBy("next_at.bucket").orderBy("next_at.place", F.asc_nulls_first("doc_id"), "text")
    following = {out: F.lead(c).over(order) for c, out in columns.items()}
    return rows.withColumns(following).where("next_at.place = 0").drop("next_bucket", "next_at")


def fingerprint_documents(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of every text and of its text with the end swapped for the next document's start.

    Null and empty texts have the empty fingerprint. Repeated rows follow each other.
    """
    rows = docs.select("doc_id", whole().alias("text"))
    rows = with_sketch(rows, "text", "sketch", k, width)
    rows = with_next(rows, {"text": "next_text", "sketch": "next_sketch"}).withColumn("n_chars", F.length("text"))
    swapped = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - swapped), F.substring("next_text", F.lit(1), swapped))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    rows = with_sketch(rows.drop("text", "next_text"), "edited", "edited_sketch", k, width)
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("kept_share"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
    )
