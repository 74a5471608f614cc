"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import awkward

from tonearm.llm import spelling as S


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, times=10):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if v != w and near(w, v)]
        form = min(others, key=lambda v: (-counts[v], v), default=None)
        form = form if form is not None and counts[form] >= times * n else None
        out[w] = [form, None, n, len(others), counts.get(form)]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_forms_of_made_up_words(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abéz") for _ in range(rng.randint(1, 6))) for _ in range(250)}
    counts = {w: rng.choice([2, 3, 30, 300, 4000]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(S.spelling_forms(df)) == plain_forms(counts)


def test_chains_of_forms_and_long_words(spark):
    counts = {"colour": 1000, "colours": 100, "coloours": 10, "xcoloours": 1, "z" * 9000: 50, "z" * 9001: 5, "z" * 4000 + "y" + "z" * 5000: 4}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    rows = found(S.spelling_forms(df))
    assert rows == plain_forms(counts)
    assert rows["xcoloours"][1] == "colour"


def test_words_of_awkward_documents(spark):
    rows = awkward.documents() + [(900 + i, "Colour colours couleurs Naïveté naïvete naïveté ÀÖØ×÷ÿÀÖØ " * 4, *[None] * 26) for i in range(40)]
    counts = Counter()
    for r in rows:
        for run in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")):
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    words = S.counted_words(S.misspelt_words(awkward.frame(spark, rows)))
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    assert found(S.spelling_forms(words)) == plain_forms(counts)


def test_empty_table(spark):
    assert S.spelling_forms(S.counted_words(S.misspelt_words(awkward.frame(spark, [])))).collect() == []
