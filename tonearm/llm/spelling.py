"""Spelling variant grouping: words that differ by one inserted, deleted or replaced letter.

A trie-node pair dictionary. The nodes of a trie over all words and of one over all
reversed words are numbered. Leaving out position i of a word gives the pair of (node of
what stands before i, node of what stands after i), and cutting it there without leaving a
letter out gives such a pair as well. Two words share a skip pair if they differ in the
letter at i alone; a skip pair equals a cut pair if the one word has a letter more. The
pairs are four integers (both nodes, both depths), so neighbours are exact.

Words are numbered by a range sort; a task walks its range with the path of the last word at
hand and numbers what leaves it, so a word costs its length, not the sum of its
prefixes. Nodes that ranges share are those of a range's first word up to its common
prefix with the word before; two integers per range tell where such a node first stood, and
are all that the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import LOWER, lower_ascii, stash, whole

LETTERS = LOWER[0] + "-" + LOWER[-1] + "À-ÿ"
#: Least length of a word, least occurrences, how much more often a form is.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Texts get one word in so many with a letter left out.
MISSPELT = 31


def misspelt_words(docs: DataFrame, least_length: int = LEAST_LENGTH, every: int = MISSPELT) -> DataFrame:
    """(word) of every run of letters, A-Z lower-cased; by the hash of document and run, one in
    ``every`` has lost a letter. A null text has none, a null doc_id is an empty one in the hash."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"),
        F.explode(F.regexp_extract_all(lower_ascii(whole()), F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("name", F.lit(":"), "run")).alias("h"), F.length("run").alias("n"))
    at = (F.col("h") % F.col("n")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("n")))
    return hashed.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word"))


def counted_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; null is no word."""
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of the range and of the word in it."""
    part, seq = TaskContext.get().partitionId(), 0
    for b in batches:
        places = pa.array(range(seq, seq + b.num_rows), pa.int64())
        seq += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), places], [*b.schema.names, "part", "seq"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        common = pa.array([_common(r["before"], r["first"]) for r in rows], pa.int32())
        through = pa.array([_common(r["first"], r["last"]) for r in rows], pa.int32())
        yield pa.RecordBatch.from_arrays([b["part"], common, through], ["part", "common", "through"])


NODES = "id long, nodes array<long>"


def _number(shared: dict[int, int], through: dict[int, int]):
    """A word's trie nodes, from the root to the word. ``shared`` is how many nodes a range's first
    word has in common with the word before, ``through`` with the range's last word.

    A node is named by the range that it first stands in: on the path of that range's last
    word by its depth (low numbers), else by a running number. Rows come in order of the words,
    with the range's last word.
    """

    def origin(part: int, depth: int) -> int:
        """The first range with the node of this depth that the range's first word shares with the word before."""
        part = before[part]
        while through[part] >= depth and shared[part] >= depth:
            part = before[part]
        return part

    order = sorted(shared)
    before = dict(zip(order[1:], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, word, path, fresh = None, "", [0], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                ids, nodes = [], []
                for r in batch.slice(at, 4096).to_pylist():
                    own = r["sorted_by"]
                    if r["part"] != part:
                        part, last = r["part"], r["last"]
                        fresh = len(last) + 1
                        path = [0, *((origin(part, d) << 40) + d for d in range(1, shared[part] + 1))]
                        keep = len(path) - 1
                    else:
                        keep = _common(word, own)
                    del path[keep + 1 :]
                    on_last = _common(own, last)
                    for depth in range(keep + 1, len(own) + 1):
                        if depth <= on_last:
                            path.append((part << 40) + depth)
                        else:
                            path.append((part << 40) + fresh)
                            fresh += 1
                    word = own
                    ids.append(r["id"])
                    nodes.append(list(path))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))], ["id", "nodes"])

    return run


def _ranged(words: DataFrame, by: Column, name: str) -> DataFrame:
    """``words`` with their place in the order of ``sorted_by``."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = words.withColumn("sorted_by", by).repartitionByRange(n, "sorted_by").sortWithinPartitions("sorted_by")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    return stash(ranged.mapInArrow(_with_places, f"{kinds}, part int, seq long"), name)


def trie_nodes(ranged: DataFrame) -> DataFrame:
    """(id, nodes): the numbers of a word's nodes in the trie over ``sorted_by``, one per depth from 0."""
    n = int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = ranged.groupBy("part").agg(F.min("sorted_by").alias("first"), F.max("sorted_by").alias("last"))
    # One row per range: the window over all of them is as long as the number of ranges.
    in_order = Window.orderBy("part")
    joints = ends.select("part", "first", "last", F.coalesce(F.lag("last").over(in_order), F.lit("")).alias("before"))
    found = joints.mapInArrow(_shared, "part int, common int, through int").collect()
    number = _number({r["part"]: r["common"] for r in found}, {r["part"]: r["through"] for r in found})
    rows = ranged.join(ends.select("part", "last"), "part").select("part", "seq", "id", "sorted_by", "last")
    return rows.repartition(n, "part").sortWithinPartitions("part", "seq").mapInArrow(number, NODES)


def neighbours(words: DataFrame) -> DataFrame:
    """(id, word, n, n_near, near, near_n): of every row of ``words`` (word, n; each word once) how many
    others are one letter away, and the id and count of the most frequent of these (ties: the
    first word by code points). Ids are in the order of the words."""
    ranged = _ranged(words, F.col("word"), "spelling-words")
    ranged = ranged.withColumn("id", F.shiftleft(F.col("part").cast("long"), 40) + F.col("seq")).drop("sorted_by")
    turned = _ranged(ranged.select("id", "word"), F.reverse("word"), "spelling-reversed").drop("word")
    ahead = trie_nodes(ranged.withColumn("sorted_by", F.col("word")))
    behind = trie_nodes(turned).select("id", F.col("nodes").alias("ends"))
    both = ranged.select("id", "word", "n").join(ahead, "id").join(behind, "id")

    # A letter left out of a run of equal letters gives the same word; the first stands for all.
    letters = F.split("word", "")
    skips = F.transform(
        F.sequence(F.lit(0), F.length("word") - 1),
        lambda i: F.struct(
            F.col("nodes")[i].alias("p"), i.alias("before"), F.col("ends")[F.length("word") - 1 - i].alias("s"),
            (F.length("word") - 1 - i).alias("after"), F.lit(True).alias("skip"),
            ((i == 0) | (F.get(letters, i) != F.get(letters, i - 1))).alias("leads"),
        ),
    )
    cuts = F.transform(
        F.sequence(F.lit(0), F.length("word")),
        lambda i: F.struct(
            F.col("nodes")[i].alias("p"), i.alias("before"), F.col("ends")[F.length("word") - i].alias("s"),
            (F.length("word") - i).alias("after"), F.lit(False).alias("skip"), F.lit(False).alias("leads"),
        ),
    )
    places = both.select("id", "n", F.explode(F.concat(skips, cuts)).alias("pair")).select("id", "n", "pair.*")

    # A pair of nodes has at most one cut and a skip for each letter that there is.
    key = Window.partitionBy("p", "before", "s", "after")
    ranked = key.orderBy(F.desc("skip"), F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leading = key.orderBy(F.desc("leads"), F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("id"))
    met = (
        places.withColumns({
            "rows": F.count(F.lit(1)).over(key), "skips": F.count_if("skip").over(key), "leads_n": F.count_if("leads").over(key),
            "cut": F.max(F.when(~F.col("skip"), top)).over(key), "lead": F.first(top).over(leading),
            "one": F.first(top).over(ranked), "two": F.nth_value(top, 2).over(ranked),
        }).where("rows > 1")
    )
    replaced = F.when(F.col("skips") > 1, F.when(F.col("one.id") == -F.col("id"), F.col("two")).otherwise(F.col("one")))
    of_skip = F.greatest(replaced, F.when(F.col("leads"), F.col("cut")))
    of_cut = F.when(F.col("leads_n") > 0, F.col("lead"))
    found = met.select(
        "id",
        F.when(F.col("skip"), F.col("skips") - 1 + (F.col("leads") & F.col("cut").isNotNull()).cast("long")).otherwise(F.col("leads_n")).alias("n_near"),
        F.when(F.col("skip"), of_skip).otherwise(of_cut).alias("best"),
    ).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return ranged.select("id", "word", "n").join(found, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("best.id")).alias("near"), F.col("best.n").alias("near_n"),
    )


def spelling_forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n; each word once).

    A word's form is its most frequent near word if that is at least ``times`` as frequent,
    else null; its root is where forms lead. A form is always more frequent than its word, so a
    chain is as long as the logarithm of the largest count, and each round doubles the way
    gone. Words of any length take part. An empty table gives no rows.
    """
    near = stash(neighbours(words), "spelling-near")
    links = stash(near.where(F.col("near_n") >= times * F.col("n")).select("id", F.col("near").alias("form"), F.col("near_n").alias("form_n")), "spelling-links")
    roots = links.select("id", F.col("form").alias("root"))
    while True:
        beyond = roots.select(F.col("id").alias("via"), F.col("root").alias("beyond"))
        roots = stash(
            roots.join(beyond, F.col("root") == F.col("via"), "left")
            .select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots"
        )
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.select("id", "root")
    names = near.select(F.col("id").alias("of_id"), F.col("word").alias("name"))
    far = links.join(roots.select("id", "root"), "id")
    far = far.join(names, far.form == names.of_id).withColumnRenamed("name", "form_word").drop("of_id")
    far = far.join(names, far.root == names.of_id).withColumnRenamed("name", "root_word").drop("of_id")
    return near.join(far.select("id", "form_word", "root_word", "form_n"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
