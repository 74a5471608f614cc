"""Best-fit packing by minimum bin slack.

Each sequence starts from the longest piece left. A bitset holds every total that
some of the other available lengths can reach; lengths are added from long to short
until the sequence can be filled exactly, or all are in. The fullest total is traced
back to its pieces, which are removed.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import slices, whole
from tonearm.llm.token_counts import load_tokenizer

CAPACITY, END_ID = 4096, 1
#: Pieces that one task packs together; their rows fit in its memory.
GROUP_PIECES = 65_536
#: Entries after which a task's table of known words is emptied.
KNOWN_WORDS = 800_000

# The vocabulary drops white space before it merges, so words are encoded on their own.
_WORDS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_CONTROL = re.compile(r"[\x1c-\x1f]")
# Its pattern always ends a match between a letter and ASCII punctuation.
_LETTERS = re.compile(r"([A-Za-z]+|[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit bytes, encoded when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        match = _LETTERS.fullmatch(word)
        if match is None:
            ids = self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        elif match[2] or not word.islower():
            ids = self[match[1].lower()] + (self[match[2]] if match[2] else b"")
        elif word.isascii():  # normalising and splitting leave such a word as it is
            ids = self.packed(t.id for t in self.model.tokenize(word))
        else:
            ids = self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    @staticmethod
    def packed(ids: Iterable[int]) -> bytes:
        return array("I", ids).tobytes()


def fullest(lengths: list[int], available: list[int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of a combination of the available lengths that fills most of room.

    ``lengths`` ascends; ``available[length]`` is how many pieces have it."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[i]
        left, copies = min(available[length], room // length), 1
        while left > 0:
            take = min(copies, left)
            wider = (reach | (reach << (length * take))) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left -= take
            copies *= 2
        if reach >> room:
            break
    total, taken = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not (before >> total) & 1:
            taken.append((length, take))
            total -= length * take
    return taken


def pack_lengths(items: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers by minimum bin slack. Every length is in 1..capacity."""
    by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, n in enumerate(items):
        by_length[n].append(i)
    available = [len(x) for x in by_length]
    lengths = [n for n in range(1, capacity + 1) if available[n]]
    bins = []

    def take(length: int, copies: int, into: list[int]) -> None:
        for _ in range(copies):
            into.append(by_length[length].pop())
        available[length] -= copies
        if not available[length]:
            del lengths[bisect_left(lengths, length)]

    while lengths:
        seed, into = lengths[-1], []
        take(seed, 1, into)
        for length, copies in fullest(lengths, available, capacity - seed):
            take(length, copies, into)
        bins.append(into)
    return bins


def _encode(path: str, capacity: int, keep_ids: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordIds(path)
        end = known.packed([END_ID])
        for pdf in slices(frames):
            if len(known) > KNOWN_WORDS:
                known.clear()
            words = [_WORDS.findall(t) if _CONTROL.search(t) else t.split() for t in pdf["text"]]
            rows = []
            for doc_id, own in zip(pdf["doc_id"], words):
                ids = b"".join(map(known.__getitem__, own)) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out if keep_ids else out.drop(columns="ids")

    return run


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids (unsigned 32-bit)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", whole().alias("text")).mapInPandas(_encode(tokenizer_path, capacity, keep_ids), schema)


def pack_pieces(pieces: DataFrame, n_groups: int, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset. Pieces are dealt to groups by hash; each group is packed alone.

    Groups are of bounded size, so a sequence more or less per group is the whole
    price of packing them apart."""
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        lengths = pdf["length"].tolist()
        sequence, offset = [0] * len(pdf), [0] * len(pdf)
        for number, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = key[0] + n_groups * number, at
                at += lengths[i]
        return pdf.drop(columns="pack_group").assign(sequence_id=sequence, offset=offset)

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_groups))
    return pieces.withColumn("pack_group", group).groupBy("pack_group").applyInPandas(pack, schema)


def best_fit_packing(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES, keep_ids: bool = False,
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    A document is its ids and the end id. Longer ones are cut into pieces of
    ``capacity``, of which the last may be shorter. Null and empty texts are the end
    id alone. Repeated rows are packed each.
    """
    size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(whole())), F.lit(0))).first()
    n_groups = max(1, -(-(size[0] + size[1] // capacity) // group_pieces))
    return pack_pieces(tokenized_pieces(docs, tokenizer_path, capacity, keep_ids), n_groups, capacity)
