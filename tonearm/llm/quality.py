"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Random Fourier features of a document's statistics approximate a Gaussian kernel.
Each partition sums its rows' part of the normal equations, one set per fold, so the
driver solves systems of fixed size whatever the number of rows. Scores of rows by the
solution that leaves out their fold are calibrated by pooling adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import slices, stash, whole

FOLDS, FEATURES, RIDGE, BINS = 5, 128, 1e-3, 1000
THRESHOLD = 0.3

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*@^~<>{}[]\\/_=+"
_DIGITS = b"0123456789"
N_STATISTICS = 14


def statistics(text: str) -> list[float]:
    """Numbers that describe a text's form; all are defined for an empty text."""
    raw, words, lines = text.encode("utf-8", "replace"), text.split(), text.split("\n")
    n, size = max(1, len(words)), max(1, len(raw))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    distinct = len(set(words))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        min(30.0, len(text) / n),
        distinct / n,
        np.log1p(distinct) / np.log1p(n),
        sum(map(eq, words, words[1:])) / n,
        share(_UPPER),
        share(_SYMBOLS),
        share(_DIGITS),
        share(b"|"),
        share(b"!"),
        share(b".,;:?"),
        1 - len(set(lines)) / len(lines),
        np.log1p(len(text) / len(lines)),
    ]


def _statistics_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in slices(frames):
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "stats": [statistics(t) for t in pdf["text"]]})


def document_statistics(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", whole().alias("text")).mapInPandas(_statistics_of, "doc_id long, stats array<double>")


@dataclass
class Model:
    """All that scoring needs; its size doesn't depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.waves + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        """The isotonic curve, with a trace of the raw score so that few scores tie."""
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip(raw, 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.calibrated(self.features(stats) @ self.weights)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from. A null id is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def isotonic(sums: list[float], counts: list[float]) -> list[float]:
    """Pool adjacent violators: the best non-decreasing fit to sums / counts."""
    blocks: list[list[float]] = []
    for s, c in zip(sums, counts):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, n2 = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += c2
            blocks[-1][2] += n2
    return [s / c for s, c, n in blocks for _ in range(int(n))]


def fit(stats: DataFrame, labels: DataFrame, seed: int = 7, features: int = FEATURES) -> Model | None:
    """Learn from labelled rows that are not held out; None if there are none.

    Several labels of a document count as their mean; null labels and labels without a
    document don't count."""
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("y"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    train = stash(stats.join(known.where(~held_out()), "doc_id").select(fold, "stats", "y"), "quality-train")
    parts = [f(F.get("stats", i)) for i in range(N_STATISTICS) for f in (F.avg, F.stddev_pop)]
    row = train.agg(F.count(F.lit(1)), *parts).first()
    if not row[0]:
        return None
    rng = np.random.default_rng(seed)
    waves = rng.normal(size=(N_STATISTICS, features)) / np.sqrt(N_STATISTICS)
    spread = np.array(row[2::2], dtype=float)
    model = Model(
        np.array(row[1::2], dtype=float), np.where(spread > 1e-9, spread, 1.0),
        waves, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1),
    )
    size = features + 1

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in frames:
            for k, part in pdf.groupby("fold"):
                z = model.features(np.stack(part["stats"]))
                own = z.T @ np.hstack([z, part["y"].to_numpy()[:, None]])
                total[k] = total.get(k, 0) + own
        for k, own in total.items():
            yield pd.DataFrame({"fold": k, "line": range(size), "terms": list(own)})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": [key[0]], "line": [key[1]], "terms": [np.sum(np.stack(pdf["terms"]), axis=0)]})

    schema = "fold int, line int, terms array<double>"
    lines = train.mapInPandas(sums, schema).groupBy("fold", "line").applyInPandas(add, schema).collect()
    system = np.zeros((FOLDS, size, size + 1))
    for r in lines:
        system[r["fold"], r["line"]] = r["terms"]
    penalty = np.full(size, RIDGE)
    penalty[-1] = 0.0

    def solve(of: np.ndarray) -> np.ndarray:
        n = max(1.0, of[-1, size - 1])
        return np.linalg.lstsq(of[:, :size] + np.diag(penalty * n), of[:, size], rcond=None)[0]

    whole_sum = system.sum(axis=0)
    without = [solve(whole_sum - own) for own in system]

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            z = model.features(np.stack(pdf["stats"]))
            raw = np.einsum("ij,ij->i", z, np.stack([without[k] for k in pdf["fold"]]))
            yield pd.DataFrame({"bin": np.clip(raw * BINS, -BINS, 2 * BINS).astype(int), "raw": raw, "y": pdf["y"]})

    bins = (
        train.mapInPandas(binned, "bin int, raw double, y double").groupBy("bin")
        .agg(F.avg("raw").alias("raw"), F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    )
    model.weights = solve(whole_sum)
    model.knots = np.array([b["raw"] for b in bins])
    model.values = np.array(isotonic([b["y"] for b in bins], [b["n"] for b in bins]))
    return model


def score_statistics(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row; without a model 0.5."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                score = model.score(np.stack(pdf["stats"])) if model else 0.5
                yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": score})

    return stats.mapInPandas(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. Null texts count as empty."""
    stats = stash(document_statistics(docs), "quality-stats")
    scored = score_statistics(stats, fit(stats, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject; texts are scored where they are."""
    model = fit(stash(document_statistics(docs), "quality-stats"), labels)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.stack([statistics(t) for t in texts])))

    return docs.where(score(whole()) >= threshold)
