"""Substring dedup: winnowed anchors as seeds, extended both ways to maximal repeats.

Winnowing picks, for every window of ``window`` words, its least hashed run of ``gram``
words; runs of windows with one pick share an anchor. Equal windows have equal anchors
at equal places, so a window can only be repeated if its anchor is. Seeds whose whole
stretch of windows is found again with the same anchor need no further look. The others
are extended word by word around the anchor: their windows are compared within the
anchor's occurrences, of which one stands for all that have an equal stretch. No pairs of
documents are formed, so the work follows the text whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import fingerprint, slices, stash, whole

WINDOW, GRAM = 35, 12
_BASE = 0xD1B54A32D192ED03
_INVERSE = pow(_BASE, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """bytes.split knows the six white space characters of the word definition and no others."""
    return text.encode("utf-8", "surrogatepass").split()


class Runs:
    """Hashes of any run of words in a list, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, words: list[bytes]):
        own = mixed(pd.util.hash_array(np.array([*words, b""], dtype=object)[:-1], categorize=False))
        powers = np.full(len(own) + 1, _BASE, np.uint64)
        powers[0] = 1
        self.sums = np.zeros(len(own) + 1, np.uint64)
        self.sums[1:] = np.cumsum(own * np.cumprod(powers)[:-1])
        powers = np.full(len(own) + 1, _INVERSE, np.uint64)
        powers[0] = 1
        self.back = np.cumprod(powers)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.back[start] + np.asarray(length).astype(np.uint64))


def last_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the last place of the least of ``width`` values."""
    place, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] <= values[left], right, left)
        reach += step
    return place


ONCE, OFTEN, SETTLED = 0, 1, 2


def _seeds(window: int, gram: int):
    """One row per document, anchor and stretch, ONCE or OFTEN by how often it has it.

    What a document holds several times is settled there and then; such windows come as
    merged SETTLED rows under an anchor of their own, so a text that turns in a circle
    brings no more rows of its anchor than any other."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames):
            each = [words_of(t) for t in pdf["text"]]
            counts = np.array([len(w) for w in each])
            starts = np.cumsum(counts) - counts
            n_windows = np.maximum(counts - window + 1, 0)
            if not n_windows.sum():
                continue
            runs = Runs([w for words in each for w in words])
            grams = runs.of(np.arange(counts.sum() - gram + 1), gram)
            picks = last_least(grams, window - gram + 1)
            row = np.repeat(np.arange(len(each)), n_windows)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + starts[row]
            pick = picks[at]
            new = np.r_[True, (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(at)] - 1
            low, high, pick, row = at[first], at[last], pick[first], row[first]
            stretch = mixed(runs.of(low, high - low + window) ^ (pick - low).astype(np.uint64))
            anchor = grams[pick]
            own = mixed(anchor + mixed(stretch + mixed(row.astype(np.uint64))))
            _, one, which, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
            often = np.flatnonzero(times[which] > 1)
            begins = np.ones(len(often), bool)
            begins[1:] = (row[often[1:]] != row[often[:-1]]) | (low[often[1:]] > high[often[:-1]] + 1)
            start = np.flatnonzero(begins)
            end = np.r_[start[1:], len(often)][: len(start)] - 1
            take = np.r_[one, often[start]]
            until = np.r_[high[one], high[often[end]]]
            state = np.r_[np.where(times > 1, OFTEN, ONCE), np.full(len(start), SETTLED)]
            name = np.where(state == SETTLED, mixed(own[take] + take.astype(np.uint64)), anchor[take])
            row = row[take]
            yield pd.DataFrame({
                "anchor": name.view(np.int64),
                "stretch": stretch[take].view(np.int64),
                "doc_id": pdf["doc_id"].astype("Int64").array[row],
                "mark": pdf["mark"].to_numpy()[row],
                "low": (low[take] - starts[row]).astype(np.int32),
                "high": (until - starts[row]).astype(np.int32),
                "state": state.astype(np.int32),
            })

    return run


def _extended(window: int):
    """The windows of stretches that must be looked at one by one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames):
            each = [words_of(t) for t in pdf["text"]]
            counts = np.array([len(w) for w in each])
            runs = Runs([w for words in each for w in words])
            row = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["lows"]])
            low, high = (np.concatenate(pdf[c].to_list()).astype(np.int64) for c in ("lows", "highs"))
            sizes = high - low + 1
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
            row = np.repeat(row, sizes)
            yield pd.DataFrame({
                "anchor": np.repeat(np.concatenate(pdf["anchors"].to_list()), sizes),
                "content": runs.of((np.cumsum(counts) - counts)[row] + at, window).view(np.int64),
                "doc_id": pdf["doc_id"].astype("Int64").array[row],
                "mark": pdf["mark"].to_numpy()[row],
                "low": at.astype(np.int32),
            })

    return run


def _removed(window: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames):
            rows = []
            for text, lows, highs in zip(pdf["text"], pdf["lows"], pdf["highs"]):
                words = words_of(text)
                if lows is None or not len(lows):
                    rows.append((len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass"), [], []))
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.asarray(lows), 1)
                np.add.at(change, np.asarray(highs) + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rows.append((len(words), int(gone.sum()), kept.decode("utf-8", "surrogatepass"), edge[::2], edge[1::2]))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text", "repeat_from", "repeat_to"])
            yield pd.concat([pdf[["doc_id"]].astype("Int64"), out], axis=1)

    return run


def _again(*keys: str) -> tuple[Column, Column]:
    """Whether a row has a neighbour with the same keys, by a look at the rows next to it."""
    w = Window.partitionBy(*keys).orderBy("doc_id", "mark", "low")
    return F.lag("low").over(w), F.lead("low").over(w)


def repeated_stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, mark, low, high): windows starting at low..high that are found elsewhere too."""
    rows = docs.select("doc_id", whole().alias("text")).withColumn("mark", fingerprint(F.col("text")))
    schema = "anchor long, stretch long, doc_id long, mark long, low int, high int, state int"
    seeds = rows.mapInPandas(_seeds(window, gram), schema)
    by_anchor = Window.partitionBy("anchor").orderBy("stretch")
    before, after = F.lag("stretch").over(by_anchor), F.lead("stretch").over(by_anchor)
    found = f"before is not null or after is not null or state = {SETTLED}"
    seeds = seeds.withColumns({"before": before, "after": after}).where(found)
    like = lambda side: F.coalesce(F.col(side) == F.col("stretch"), F.lit(False))
    same = like("before") | like("after") | (F.col("state") != ONCE)
    stands = ~like("before") & (F.col("state") != SETTLED)
    seeds = stash(seeds.select("anchor", "doc_id", "mark", "low", "high", same.alias("same"), stands.alias("stands")), "repeat-seeds")

    unlike = seeds.where("not same").select("anchor").distinct()
    looked = seeds.where("stands").join(unlike, "anchor", "left_semi")
    looked = looked.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "low", "high")).alias("s"))
    looked = looked.select(
        F.col("doc_id").alias("l_doc"), F.col("mark").alias("l_mark"),
        F.col("s.anchor").alias("anchors"), F.col("s.low").alias("lows"), F.col("s.high").alias("highs"),
    )
    texts = rows.join(looked, F.col("doc_id").eqNullSafe(F.col("l_doc")) & (F.col("mark") == F.col("l_mark"))).drop("l_doc", "l_mark")
    windows = texts.mapInPandas(_extended(window), "anchor long, content long, doc_id long, mark long, low int")
    before, after = _again("anchor", "content")
    windows = windows.withColumns({"before": before, "after": after}).where("before is not null or after is not null")
    return (
        seeds.where("same").select("doc_id", "mark", "low", "high")
        .union(windows.select("doc_id", "mark", "low", F.col("low").alias("high")))
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text, repeat_from, repeat_to.

    A word goes if a window of ``window`` words that covers it starts anywhere else too.
    ``repeat_from`` and ``repeat_to`` are the maximal repeats, the last word excluded.
    Null and empty texts have no words. A repeated row is found elsewhere as a whole; rows
    that share a doc_id but not a text are told apart.
    """
    found = repeated_stretches(docs, window, gram).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("low", "high")).alias("s"))
    found = found.select(
        F.col("doc_id").alias("f_doc"), F.col("mark").alias("f_mark"), F.col("s.low").alias("lows"), F.col("s.high").alias("highs")
    )
    rows = docs.select("doc_id", whole().alias("text")).withColumn("mark", fingerprint(F.col("text")))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("mark") == F.col("f_mark")), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_text string, repeat_from array<int>, repeat_to array<int>"
    return rows.select("doc_id", "text", "lows", "highs").mapInPandas(_removed(window), schema)
