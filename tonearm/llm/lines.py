"""Line dedup: line hashes in range partitions, per-document bitmaps of kept lines.

All work is DataFrame expressions. Texts are not moved until the bitmaps are applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import SPACES, as_row, fingerprint, from_row, lower_ascii, stash, whole

WORD_BITS = 64


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, mark, pos) of every line whose key is long enough; two hashes of 64 bits."""
    rows = docs.select("doc_id", whole().alias("text"))
    lines = rows.select("doc_id", fingerprint(F.col("text")).alias("mark"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.select("doc_id", "mark", "pos", line_key(F.col("line")).alias("line_key"))
    return keyed.where(F.length("line_key") >= min_chars).select(
        F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit("line"), "line_key").alias("h2"), "doc_id", "mark", "pos"
    )


def ordered_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """The hashed lines with their ``place`` in the order of key, document and position, and whether
    a line is the ``first`` of its key in its document.

    Texts are split and hashed once, into a table. Its rows go into ranges of key and document, so
    that one line in a third of all documents is spread over several, and are numbered in
    sorted order as they stream by; numbers of later ranges are larger. A null doc_id is one
    document, before all others."""
    lines = stash(hashed_lines(docs, min_chars), "line-hashes")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = lines.repartitionByRange(n, "h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "pos")
    placed = streamed.withColumn("place", F.monotonically_increasing_id())
    own = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")  # lies in one range and is sorted: no shuffle
    return stash(placed.withColumn("first", F.row_number().over(own) == 1), "line-places")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: doc_id, mark, keep_words, n_dropped.

    Bit ``i % 64`` of word ``i / 64`` says whether line ``i`` stays; words after the
    last are all ones. Lines whose key is found in at least ``min_docs`` documents stay
    in the largest doc_id only: there are as many documents as first occurrences, and
    what stands before the last of these in the sorted order goes.

    Null and empty texts have one empty line, which is too short to go. Repeated rows are one
    document; rows that share a doc_id but not a text are one too, and lose their own lines.
    An empty table gives no bitmaps.
    """
    placed = ordered_lines(docs, min_chars)
    repeated = (
        placed.where("first").groupBy("h1", "h2")
        .agg(F.max("place").alias("keeper"), F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    lost = placed.join(repeated, ["h1", "h2"]).where(F.col("place") < F.col("keeper"))
    places = lost.select("doc_id", "mark", "pos").distinct()
    bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
    words = places.groupBy("doc_id", "mark", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("bits")
    )
    packed = words.groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("packed"),
        F.sum(WORD_BITS - F.bit_count("bits")).alias("n_dropped"),
    )
    full = F.lit(-1).cast("long")
    filled = F.zip_with(
        "packed",
        F.slice("packed", F.lit(2), F.size("packed")),
        lambda a, b: F.concat(F.array(a["bits"]), F.array_repeat(full, F.coalesce(b["word"] - a["word"] - 1, F.lit(0)))),
    )
    dense = F.concat(F.array_repeat(full, F.col("packed")[0]["word"]), F.flatten(filled))
    return packed.select("doc_id", "mark", dense.alias("keep_words"), "n_dropped")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped): the columns of ``docs`` as a struct; null text is one empty line."""
    rows = docs.select(as_row(docs), whole().alias("text")).withColumn("mark", fingerprint(F.col("text")))
    marks = bitmaps.select(F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark"), "keep_words", F.col("n_dropped").alias("lost"))
    both = rows.join(marks, F.col("row.doc_id").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark")), "left")
    word = lambda i: F.coalesce(F.get("keep_words", F.floor(i / WORD_BITS).cast("int")), F.lit(-1).cast("long"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: F.getbit(word(i), i % WORD_BITS) == 1), "\n")
    return both.select(
        "row",
        F.when(F.col("keep_words").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce("lost", F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The rows of ``docs`` with repeated lines dropped from the text; no row goes."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    lost = F.col("n_dropped") > 0
    changed = {
        "text": F.when(lost, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(lost, F.length("kept_text")).otherwise(F.col("row.n_chars") if "n_chars" in docs.columns else None),
    }
    return kept.select(*from_row(docs, changed))
