"""The pipeline from end to end: each stage's written rows against a plain replay of what it read."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tonearm.llm.common import stash, table
from tonearm.llm.mixing import share_out
from tonearm.llm.quality import good_documents

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def written(spark):
    """The columns of documents after each stage, as rows, in the order of the stages."""
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"test-{name.replace(' ', '-')}")
        out.append(docs.collect())
    return out


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_drops_whole_rows_that_the_classifier_rejects(spark, written):
    before, after = written[0], written[1]
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    good = {r["doc_id"] for r in good_documents(docs, table(spark, "/root/testdata/sf0.001", "labels")).collect()}
    assert bag(after) == bag(r for r in before if r["doc_id"] in good)
    assert 0 < len(after) < len(before)


def test_lines_replayed(written):
    before, after = written[1], written[2]
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for r in before:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(r["doc_id"])
    want = {}
    for r in before:
        kept = [x for x in (r["text"] or "").split("\n") if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == r["doc_id"]]
        want[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] or "" for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None)


def test_near_replayed(written):
    before, after = written[2], written[3]
    sets = {}
    for r in before:
        words = WORD.findall((r["text"] or "").translate(LOWER))
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert bag(after) == bag(r for r in before if find(r["doc_id"]) == r["doc_id"])


def test_mix_takes_whole_rows_near_the_targets(written):
    before, after = written[3], written[4]
    taken, of = bag(after), bag(before)
    assert set(taken) <= set(of) and max(taken.values()) <= 3
    size = lambda r: len(WORD.findall(r["text"] or ""))
    sizes, got, longest = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r)
        longest[r["source"]] = max(longest[r["source"]], size(r))
    for r in after:
        got[r["source"]] += size(r)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = share_out([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))], sum(sizes.values()), 3)
    for name, target in zip(names, targets):
        assert abs(got[name] - target) <= 1 + longest[name] / 2


def test_packed_pieces_are_the_tokens_of_the_mix(written):
    before, after = written[4], written[5]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = Counter()
    for r in before:
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        for piece, start in enumerate(range(0, n, 4096)):
            want[r["doc_id"], piece, start, min(4096, n - start)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in after) == want
    sequences = defaultdict(list)
    for r in after:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_is_the_last_stage(spark, written):
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    digest = lambda rows: hashlib.sha256(str(sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)).encode()).hexdigest()
    assert digest(again) == digest(written[-1])
