"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, mark string, size string, words string, node string, key string, stats string, score string, "
    "kept boolean, n_dropped string, kept_text string, draws string, next_text string, sketch string, turn int, "
    "passes string, rest string, target string, empty string, h1 string, before string, low string, anchor string"
)


def documents() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "réré", "Über", "cc", "by", "all", "rights", "reserved", "x1", "%%", "on"])
    sentence = lambda n: " ".join(word() for _ in range(n))
    shared = sentence(60)
    line = "a line that many documents share, word for word"
    texts = [None, "", " \n\t ", "one", "one two", shared, shared, shared + " end", line, f"{line}\n{line}\n\n{sentence(40)}"]
    texts += [f"{sentence(30)}\n{line.upper()}  \n{sentence(12)}" for _ in range(12)]
    texts += [sentence(rng.choice([3, 34, 35, 36, 80])) for _ in range(30)]
    texts += [sentence(60_000), "z" * 150_000, "no " * 400, "日本語 " * 50, "x y <|endoftext|> cc\x1cby"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, texts[5]), (5, texts[5]), (8, "other text under a known id"), (None, sentence(50)), (None, None), (10**15, "last")]
    sources = ["b", "a", None, "é", "c"]
    return [
        (i, t, None if k % 7 == 0 else "en", sources[k % 5] if k % 3 else "b", None if k % 4 == 0 else len(t or ""), *[None] * 23)
        for k, (i, t) in enumerate(rows)
    ]


def frame(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def labels(spark, rows: list[tuple] | None = None):
    found = [(r[0], i % 4 and 1, 0) for i, r in enumerate(documents())] if rows is None else rows
    return spark.createDataFrame([*found, (None, 1, 0), (3, None, None)] if rows is None else found, "doc_id long, quality int, toxic int")
