"""Every operator and pipeline stage over awkward rows, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import awkward
from tonearm.llm import near_dedup
from tonearm.llm.fingerprints import fingerprint_documents
from tonearm.llm.license_rules import BASE_PHRASES, rules
from tonearm.llm.licenses import scan_licenses
from tonearm.llm.lines import apply_bitmaps, dedup_lines, keep_bitmaps
from tonearm.llm.mixing import mix_sources, mixed_documents, plan_shares, share_out, split_quotas
from tonearm.llm.near_dedup import near_duplicates, one_of_each
from tonearm.llm.packing import best_fit_packing, pack_lengths
from tonearm.llm.quality import good_documents, isotonic, quality_scores, statistics
from tonearm.llm.substrings import remove_repeats
from tonearm.llm.token_counts import count_widening, load_tokenizer, token_counts

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}
BYTE_BPE, WORD_BPE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in awkward.documents()]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward"))
    awkward.frame(spark).repartition(5).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bag(rows):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in rows)


def test_substrings(docs, rows):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (doc_id, _), w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        want[(doc_id, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g))] += 1
    got = remove_repeats(docs)
    assert bag(got.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == want
    for r in got.collect():
        assert sum(b - a for a, b in zip(r.repeat_from, r.repeat_to)) == r.n_removed
        assert all(b - a >= 35 for a, b in zip(r.repeat_from, r.repeat_to))


@pytest.mark.parametrize("window, gram, words", [(6, 3, 3), (5, 2, 2), (8, 3, 30)])
def test_substrings_of_few_words(spark, window, gram, words):
    rng = np.random.default_rng(window)
    texts: list[str] = []
    for i in range(60):
        w = [str(x) for x in rng.integers(0, words, rng.choice([0, 3, window - 1, window, window + 1, 40, 120]))]
        if i and rng.random() < 0.5:
            other = texts[rng.integers(len(texts))].split()
            at = rng.integers(len(other) + 1)
            w = w[:5] + other[at : at + 30] + w[5:]
        texts.append(" \n".join(w))
    split = [t.split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    want = {}
    for i, w in enumerate(split):
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        want[i] = " ".join(x for j, x in enumerate(w) if j not in gone)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.kept_text for r in remove_repeats(docs, window, gram).collect()} == want


def kept_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for x in (text or "").split("\n"):
            holders[key(x)].add(doc_id)
    number = lambda d: -1 if d is None else d
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        drop = [
            len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and number(doc_id) < max(map(number, holders[key(x)]))
            for x in lines
        ]
        out.append((doc_id, "\n".join(x for x, d in zip(lines, drop) if not d), len(lines), sum(drop)))
    return out


def test_lines(docs, rows):
    got = apply_bitmaps(docs, keep_bitmaps(docs)).select("row.doc_id", "kept_text", "n_lines", "n_dropped")
    want = Counter(kept_lines(rows))
    assert bag(got.collect()) == want
    assert sum(r[3] for r in want) > 0
    stage = dedup_lines(docs)
    assert stage.dtypes == docs.dtypes
    assert bag((r.doc_id, r.text or "") for r in stage.collect()) == Counter((d, t) for d, t, _, _ in want.elements())
    assert all(r.n_chars == len(r.text) for r in stage.collect() if r.n_chars is not None and r.text is not None)


def test_line_bitmap_over_many_words(spark):
    line = "this line is long enough to count"
    texts = ["\n".join(line if i in (0, 64, 500) else f"row {i}" for i in range(501)), line, line]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bitmaps = {r.doc_id: r for r in keep_bitmaps(docs).collect()}
    assert sorted(bitmaps) == [0, 1] and len(bitmaps[0].keep_words) == 8 and bitmaps[0].n_dropped == 3
    kept = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert kept == {d: t for d, t, _, _ in kept_lines(list(enumerate(texts)))}


def scanned(text, found):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    joined = " " + " ".join(words) + " " if words else " "
    starts, labels, spots = [], set(), []
    for phrase, label in BASE_PHRASES.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        starts += at
        labels |= {label} if at else set()
    for turn, r in enumerate(found):
        if r.keyword in joined:
            for m in re.finditer(f" ({r.regex})(?= )", joined):
                start = joined[: m.start()].count(" ")
                spots.append((start, -(start + m[1].count(" ") + 1), -r.priority, turn, r))
    spots.sort(key=lambda s: s[:4])
    kept = [s[4] for i, s in enumerate(spots) if not any(o[1] <= s[1] and o[2] <= s[2] for o in spots[:i])]
    score = max([r.confidence for r in kept] + [0.4 if labels else 0.0])
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {r.label for r in kept})), score,
    )


def test_license_scan(spark, docs, rows):
    found = rules()
    assert len(found) > 200
    got = scan_licenses(docs).collect()
    long_ids = {d for d, t in rows if len(t or "") >= 20_000}
    want = Counter((d, *scanned(t, found)) for d, t in rows if d not in long_ids)
    assert bag(r for r in got if r.doc_id not in long_ids) == want
    assert sum(r.n_base for r in got if r.doc_id in long_ids) > 0
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License); cc by cc by.",
        "GNU Lesser General Public License v2.1 or later, GPL-3.0. All rights reserved, all rights reserved",
        "SPDX-License-Identifier: MIT\nCopyright (c) 2020 2021 by BSD 3-clause license",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International, CC BY-NC-SA 4.0",
        "the general Public\nLICENSE " * 300,
    ]
    notices = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = {}
    for r in scan_licenses(notices).collect():
        assert tuple(r)[1:] == scanned(texts[r.doc_id], found)
        labels[r.doc_id] = r.labels.split(",")
    assert {"apache-2.0", "cc-by"} <= set(labels[0]) and "apache" not in labels[0]
    assert {"lgpl-2.1-or-later", "gpl-3.0", "gpl", "reserved"} <= set(labels[1]) and "cc-by-nc-sa-4.0" in labels[3]


def test_license_keywords_drop_no_match(spark, rows):
    texts = [
        "You can redistribute it and/or modify it under the same terms as Perl itself.",
        "This software is proprietary and confidential.",
        "The person dedicated the work to the public domain by waiving all of his or her rights.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use it "
        "for any purpose, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
        "If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such.",
    ]
    labels = ["perl", "proprietary", "cc0-1.0", "zlib"]
    texts += [t for _, t in rows if len(t or "") < 5_000]
    ungated = [r._replace(keyword="") for r in rules()]
    notices = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in scan_licenses(notices).collect():
        assert tuple(r)[1:] == scanned(texts[r.doc_id], ungated)
        assert r.doc_id >= len(labels) or labels[r.doc_id] in r.labels.split(",")


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = best_fit_packing(docs, WORD_BPE, keep_ids=True).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            raw = np.array(ids[at : at + 4096], "<u4").tobytes()
            want[(doc_id, piece, at, len(raw) // 4, zlib.crc32(raw), raw)] += 1
    assert Counter((*tuple(r)[:5], bytes(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(k[3] * n for k, n in want.items())
    assert len(sequences) <= -(-total // 4096) + 1


def test_pack_lengths_fills_bins():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 300, 2000).tolist() + [1000] * 5
    bins = pack_lengths(items, 1000)
    assert sorted(i for b in bins for i in b) == list(range(len(items)))
    assert all(sum(items[i] for i in b) <= 1000 for b in bins)
    assert len(bins) == -(-sum(items) // 1000)
    assert pack_lengths([], 10) == [] and len(pack_lengths([10, 10, 6, 5], 10)) == 4


def test_mixing(docs, rows):
    source = defaultdict(list)
    for r in awkward.documents():
        source[r[3]].append(len(WORD.findall(r[1] or "")))
    got = mix_sources(docs).collect()
    again = mix_sources(docs.repartition(3)).collect()
    told = lambda rs: bag((r.doc_id, r.size, r.taken, tuple(r.draws)) for r in rs)
    assert told(got) == told(again)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t in rows)
    names = sorted(x for x in source if x is not None) + [None]
    sizes = [sum(source[x]) for x in names]
    target = share_out(sizes, [1, 2, 3, 1, 2], sum(sizes), 3)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(d.words for d in r.draws)
        taken[(r.source_size, r.target)] += r.taken
    assert sorted(taken) == sorted(zip(sizes, target))
    # Documents are taken whole: the last one is off by half its size at most.
    longest = defaultdict(int)
    for r in got:
        longest[(r.source_size, r.target)] = max(longest[(r.source_size, r.target)], r.size)
    assert all(abs(n - t) <= 1 + longest[key] / 2 for key, n in taken.items() for t in [key[1]])
    mix = mixed_documents(docs)
    assert mix.dtypes == docs.dtypes
    mixed = Counter((r.doc_id, r.text) for r in mix.collect())
    whole_rows = Counter()
    for r in mix_sources(docs, keep_columns=True).collect():
        whole_rows[(r.doc_id, r.row["text"])] += len(r.draws)
    assert mixed == +whole_rows


def test_shards_draw_disjoint_runs_of_blocks_by_quota(spark):
    """Every block of every pass goes to one shard, and each shard gets its quota of each source."""
    shards, seed = 8, 17
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 900), "abc"[min(2, int(rng.expovariate(1)))]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text) // 2
    plan = {s.source: s for s in plan_shares(list(sizes.items()), (1, 2, 3), 3, shards)}
    got = mix_sources(docs, shards=shards, seed=seed, keep_columns=True)
    got = got.withColumn("mark", F.xxhash64(F.lit(seed), "doc_id")).collect()
    shard_of, filled = {}, defaultdict(set)
    for r in got:
        share = plan[r.row["source"]]
        block = r.mark % share.blocks
        filled[share.source].add(block)
        for turn, draw in enumerate(r.draws):
            assert shard_of.setdefault((share.source, block, turn), draw.shard) == draw.shard
    held = Counter((source, shard) for (source, _, _), shard in shard_of.items())
    names = sorted(plan)
    totals = [sum(n for (s, _), n in held.items() if s == name) for name in names]
    for name, n in zip(names, totals):
        share = plan[name]
        assert share.passes * len(filled[name]) <= n <= (share.passes + 1) * len(filled[name])
    quotas = split_quotas(np.array(totals, dtype=np.int64), shards, np.random.default_rng(seed))
    assert [[held[name, shard] for name in names] for shard in range(shards)] == quotas.tolist()


def test_mixed_rows_lie_by_shard_and_shuffled(spark):
    rows = [(i, f"w{i} " * 40, "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shard = {r.doc_id: [d.shard for d in r.draws] for r in mix_sources(docs, shards=4).collect()}
    parts = mixed_documents(docs, shards=4).withColumn("part", F.spark_partition_id()).collect()
    slices = -(-8 // 4)
    for r in parts:
        assert r.part // slices in shard[r.doc_id]
    ids = [r.doc_id for r in parts]
    assert ids != sorted(ids)


def test_shares_and_quotas():
    assert share_out([10, 100, 0], [1, 1, 5], 110, 3) == [30.0, 80.0, 0.0]
    quotas = np.array([5, 0, 40])
    tree = split_quotas(quotas, 7, np.random.default_rng(0))
    assert (tree.sum(axis=0) == quotas).all() and tree.min() >= 0 and set(tree.sum(axis=1)) <= {6, 7}


@pytest.mark.parametrize("sizes", [{}, {"chunk": 60, "overlap": 50}])
def test_token_counts(docs, rows, sizes):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    some = docs.where("length(text) < 5000 or text is null") if sizes else docs
    want = Counter()
    for doc_id, text in rows:
        if not sizes or len(text or "") < 5000:
            n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
            want[(doc_id, len((text or "").encode()), n, n > 512)] += 1
    assert bag(token_counts(some, BYTE_BPE, **sizes).collect()) == want


def test_widening_overlap():
    tokenizer = load_tokenizer(BYTE_BPE)
    for text in ("x" * 3000, "ab " * 900, " " * 2000 + "end", "!?" * 700 + "<|endoftext|>" * 9):
        assert count_widening(tokenizer, text, 100, 60) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_quality(spark, docs, rows):
    labels = awkward.labels(spark)
    got = quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    ids, texts, by_text = Counter(d for d, _ in rows), dict(rows), defaultdict(set)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        if ids[r.doc_id] == 1:
            by_text[texts[r.doc_id] or ""].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    kept = good_documents(docs, labels)
    assert kept.dtypes == docs.dtypes
    assert kept.count() == sum(r.predicted for r in got)
    none = awkward.labels(spark, [])
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert good_documents(docs, none).count() == len(rows)


def test_statistics_and_isotonic():
    assert np.isfinite(statistics("")).all() and np.isfinite(statistics("a" * 10)).all()
    assert isotonic([0, 1, 0, 2], [1, 1, 1, 2]) == [0, 0.5, 0.5, 1.0]


def test_quality_on_held_out_rows(spark):
    tables = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert above >= 0.98 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in scored) >= 0.95 * len(scored)


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def grouped(rows, width):
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t:
                shared = len(s & t)
                if 100 * shared >= 80 * (len(s) + len(t) - shared):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, width):
    want = grouped(rows, width)
    assert bag(near_duplicates(docs, width=width).collect()) == Counter(want)
    stage = one_of_each(docs, width=width)
    assert stage.dtypes == docs.dtypes
    kept = {d for d, _, _, k in want if k and d is not None}
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    got = Counter(r.doc_id for r in stage.collect())
    assert set(got) == kept | {None} and got[None] == len(texts[None])
    assert all(got[d] == 1 for d in kept if any(WORD.search(t or "") for t in texts[d]))


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_around_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "SET_BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(40):
        base = rng.integers(0, 3000, rng.choice([8, 30, 100, 300])).tolist()
        for _ in range(rng.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(int(len(w) * rng.uniform(0, 0.09))):
                w[rng.integers(len(w))] = int(rng.integers(3000))
            rows.append((len(rows), " ".join(map(str, w))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(near_duplicates(docs, width=2).collect()) == Counter(grouped(rows, 2))


def test_a_cell_gives_each_pair_of_components_once():
    sets = {1: range(0, 100), 2: range(5, 105), 3: range(10, 110), 7: range(8, 108), 8: range(500, 600)}
    component = {1: 1, 2: 1, 3: 3, 7: 3, 8: 8}
    rows = [(n, component[n], np.array(h, np.int64), n != 1, True) for n, h in sets.items()]
    cell = pd.DataFrame(rows, columns=["node", "component", "hashes", "left", "right"])
    got = near_dedup._linked(80)(cell)
    assert list(got.itertuples(index=False, name=None)) == [(1, 3)]
    assert near_dedup._linked(80)(cell[cell["node"] == 8]).empty


def test_fingerprints(docs, rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for (d, t), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        t, after = t or "", after or ""
        m = len(t) // 4
        want[(d, len(t), hashlib.sha256((t[: len(t) - m] + after[:m]).encode()).hexdigest())] += 1
    got = fingerprint_documents(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (5, 8, None)}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == ""
    assert by_id[6].fingerprint in {r.fingerprint for r in got if r.doc_id == 5}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_over_awkward_and_empty_tables(spark, docs, tmp_path, stage):
    awkward.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    for table in (docs, docs.limit(0)):
        out = run(spark, table, str(tmp_path))
        if stage != "packing":
            assert out.dtypes == docs.dtypes
        out.write.mode("overwrite").parquet(f"{tmp_path}/out")
        assert (spark.read.parquet(f"{tmp_path}/out").count() > 0) == (table is docs)


def test_empty_tables(spark):
    none = awkward.frame(spark, [])
    for out in (
        remove_repeats(none), apply_bitmaps(none, keep_bitmaps(none)), scan_licenses(none), best_fit_packing(none, WORD_BPE),
        mix_sources(none), token_counts(none, BYTE_BPE), quality_scores(none, awkward.labels(spark, [])),
        near_duplicates(none), fingerprint_documents(none),
    ):
        assert out.count() == 0
