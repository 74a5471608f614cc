"""Exact token counts; huge documents are encoded in overlapping chunks and spliced.

The vocabulary's pattern looks ahead but never behind, so from a place where two
encodings both begin a pattern match, they go on alike. Such a place, at least
``MARGIN`` characters before the earlier chunk's end, is a proven boundary: the
earlier chunk is right before it, the later one after it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import fingerprint, same_row, slices, whole

#: Longer than a special token's text plus what the pattern looks ahead.
MARGIN = 48
CHUNK_CHARS, OVERLAP_CHARS = 32_768, 1_024
#: Entries after which a task's table of known pieces is emptied.
KNOWN_PIECES = 500_000

# A piece is white space and the other characters after it. A pattern match never
# runs from another character into white space, so pieces are encoded on their own.
_PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
# White space that _PIECES does not cut at; texts with it are encoded whole.
_ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def boundaries(tokenizer, text: str) -> tuple[dict[int, int], int]:
    """Start of each pattern match with the number of tokens before it, and all tokens."""
    e = tokenizer.encode(text, add_special_tokens=False)
    starts, last = {}, object()
    for i, (word, (start, _)) in enumerate(zip(e.word_ids, e.offsets)):
        if word is None or word != last:
            starts[start] = i
        last = word
    return starts, len(e.ids)


def splice(left: dict[int, int], right: dict[int, int], begin: int, stop: int) -> int | None:
    """First boundary in [begin, stop] that both encodings have."""
    common = [p for p in right if begin <= p <= stop and p in left]
    return min(common, default=None)


def count_widening(tokenizer, text: str, chunk: int, overlap: int) -> int:
    """Tokens of one text, chunk by chunk; an overlap without a common boundary doubles."""
    total, at = 0, 0
    while True:
        wide = overlap
        while True:
            end = at + chunk + wide
            starts, n = boundaries(tokenizer, text[at:end])
            if end >= len(text):
                return total + n
            later, _ = boundaries(tokenizer, text[at + chunk : end + wide])
            later = {p + chunk: n for p, n in later.items()}
            meet = splice(starts, later, chunk, chunk + wide - MARGIN)
            if meet is not None:
                break
            wide *= 2
        total += starts[meet]
        at += meet


def _count_pieces(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load_tokenizer(path)
        known: dict[str, int] = {}
        for pdf in slices(frames):
            texts = pdf["text"].tolist()
            pieces = [[t] if _ODD_SPACE.search(t) else _PIECES.findall(t) for t in texts]
            if len(known) > KNOWN_PIECES:
                known.clear()
            new = list(set().union(*pieces) - known.keys())
            for p, e in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                known[p] = len(e)
            count = known.__getitem__
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "n_bytes": pdf["n_bytes"],
                "n_tokens": [sum(map(count, p)) for p in pieces],
            })

    return run


def _cut(chunk: int, overlap: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for doc_id, mark, n_bytes, text in pdf.itertuples(index=False):
                for k, at in enumerate(range(0, len(text), chunk)):
                    part = text[at : at + chunk + overlap]
                    yield pd.DataFrame({
                        "doc_id": pd.array([doc_id], "Int64"), "mark": [mark], "n_bytes": [n_bytes],
                        "part": [k], "text": [part], "last": [at + chunk + overlap >= len(text)],
                    })
                    if at + chunk + overlap >= len(text):
                        break

    return run


def _encode_chunks(path: str, chunk: int, overlap: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load_tokenizer(path)
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                starts, n = boundaries(tokenizer, text)
                head = [p for p in starts if p <= overlap]
                tail = [p for p in starts if chunk <= p <= chunk + overlap - MARGIN]
                rows.append((n, head, [starts[p] for p in head], [p - chunk for p in tail], [starts[p] for p in tail]))
            cols = ["n", "head", "head_n", "tail", "tail_n"]
            yield pd.concat([pdf.drop(columns="text"), pd.DataFrame(rows, columns=cols)], axis=1)

    return run


def _splice_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum a document's chunks between their common boundaries; null if one is missing."""
    pdf = pdf.sort_values("part").drop_duplicates("part")
    total, before = 0, 0
    rows = list(pdf.itertuples(index=False))
    for row, after in zip(rows, [*rows[1:], None]):
        if after is None:
            total += row.n - before
            break
        left, right = dict(zip(row.tail, row.tail_n)), dict(zip(after.head, after.head_n))
        meet = splice(left, right, 0, max(left, default=0))
        if meet is None:
            total = None
            break
        total += left[meet] - before
        before = right[meet]
    return pd.DataFrame({
        "doc_id": pd.array(pdf["doc_id"].head(1), "Int64"), "mark": pdf["mark"].head(1).tolist(),
        "n_bytes": pdf["n_bytes"].head(1).tolist(), "n_tokens": pd.array([total], "Int64"),
    })


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512,
    chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no tokens. Repeated rows are counted each; rows that
    share a doc_id but not a text are told apart. Texts of more than two chunks are
    cut and their chunks dealt over all tasks; where two chunks of a text have no
    common boundary, that text is counted again with overlaps that double until they do.
    """
    rows = docs.select("doc_id", whole().alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    long_text = F.length("text") > 2 * chunk
    counts = "doc_id long, n_bytes long, n_tokens long"
    short = rows.where(~long_text).select("doc_id", "n_bytes", "text").mapInPandas(_count_pieces(tokenizer_path), counts)

    huge = rows.where(long_text).select("doc_id", fingerprint(F.col("text")).alias("mark"), "n_bytes", "text")
    parts = (
        huge.mapInPandas(_cut(chunk, overlap), "doc_id long, mark long, n_bytes long, part long, text string, last boolean")
        .repartition("doc_id", "mark", "part")
        .mapInPandas(
            _encode_chunks(tokenizer_path, chunk, overlap),
            "doc_id long, mark long, n_bytes long, part long, last boolean, n long, "
            "head array<long>, head_n array<long>, tail array<long>, tail_n array<long>",
        )
    )
    spliced = parts.groupBy("doc_id", "mark").applyInPandas(_splice_chunks, "doc_id long, mark long, n_bytes long, n_tokens long")
    once = huge.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    done = spliced.where(F.col("n_tokens").isNotNull())
    open_rows = spliced.where(F.col("n_tokens").isNull()).select("doc_id", "mark")
    again = huge.join(open_rows, same_row(huge, open_rows, "doc_id", "mark"), "left_semi").select("doc_id", "n_bytes", "text")

    def widen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load_tokenizer(tokenizer_path)
        for pdf in frames:
            pdf["n_tokens"] = [count_widening(tokenizer, t, chunk, 2 * overlap) for t in pdf["text"]]
            yield pdf[["doc_id", "n_bytes", "n_tokens"]]

    done = (
        done.join(once, same_row(done, once, "doc_id", "mark"))
        .select(done.doc_id, "n_bytes", "n_tokens", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
        .drop("copy")
    )
    every = short.unionByName(done).unionByName(again.mapInPandas(widen, counts))
    return every.withColumn("over_limit", F.col("n_tokens") > limit)
