"""Operator 10, best-fit packing with Martello-Toth dominance reduction.

Documents are tokenized on the executors and cut into pieces of at most one sequence. Pieces are dealt by a hash of
their document into groups of some thousands; each group is packed by itself in one task, so that memory is bounded
and a lost task costs one group. A group ends with at most one poorly filled sequence, which the group size makes
negligible.

Within a group the dominance criterion fixes small sets first: a set F that holds piece j and fits a sequence is
fixed for good if every other feasible set with j can be exchanged against F without using more sequences. Tested
are sets of one, two and three pieces; what is left is packed best fit, longest first.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import table

#: Words, and their pre-tokens, that a task remembers before it starts afresh, if they are no longer than so many characters.
CACHE_WORDS, CACHE_TOKENS, LONG_WORD = 500_000, 500_000, 32
#: Latin without combining marks, white space and the one capital whose lower case has two characters.
SIMPLE = regex.compile(r"(?!.*<\|)[!-~\xa1-\u012f\u0131-\u024f]+").fullmatch
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Params:
    tokenizer: str
    capacity: int = 2048
    end_id: int = 0
    #: Documents in a group that is packed together.
    group: int = 8192
    passes: int = 4


class Tokens(dict):
    """Lower-cased pre-token -> its ids as little-endian 32-bit bytes."""

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize = tokenize
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that the byte level writes as themselves
        self.bytes = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in plain)}

    def __missing__(self, token: str) -> bytes:
        own = token if token.isascii() else token.encode().decode("latin-1").translate(self.bytes)
        ids = [t.id for t in self.tokenize(own)]
        return keep(self, token, pack_ids(f"<{len(ids)}I", *ids), CACHE_TOKENS)


def keep(known: dict, word: str, ids: bytes, most: int) -> bytes:
    if len(word) <= LONG_WORD:
        if len(known) >= most:
            known.clear()
        known[word] = ids
    return ids


class Ids(dict):
    """Word -> its token ids, of a tokenizer that drops white space and never merges across it, so that a text's ids are
    its words' ids in a row.

    A tokenizer's normalizing and alignments cost more than its merges. Words of Latin letters, digits and signs, which
    normalizing only lower-cases, are therefore split here by the tokenizer's own pattern and go straight to its model;
    all others, and whatever could hold a special token, go the long way. Tests hold either against the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        known = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        pre = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        known = known and [x["type"] for x in pre] == ["Split", "ByteLevel"] and not pre[1]["add_prefix_space"]
        self.parts = regex.compile(pre[0]["pattern"]["Regex"]).findall if known else None
        self.tokens = Tokens(self.tokenizer.model.tokenize)

    def __missing__(self, word: str) -> bytes:
        if self.parts and (word.isprintable() and "<" not in word if word.isascii() else SIMPLE(word)):
            low = word if word.islower() else word.lower()  # one string in both dictionaries where it can be
            # letters alone are one pre-token: by far the most common case, without the pattern
            out = self.tokens[low] if low.isalpha() else b"".join(map(self.tokens.__getitem__, self.parts(low)))
        else:
            out = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return keep(self, word, out, CACHE_WORDS)

    def forget(self) -> None:
        """What a task remembered goes with it: a worker lives on through other jobs, beside which the words would lie."""
        self.clear()
        self.tokens.clear()

    def of(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def ids_of(path: str) -> Ids:
    """The tokenizer of this worker, read once for all its tasks."""
    return Ids(path)


def cut_up(docs: DataFrame, p: Params) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(p.tokenizer)
        end, most = np.array([p.end_id], "<u4").tobytes(), 4 * p.capacity
        try:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    own = ids.of(text.as_py()) + end
                    rows += [(doc_id, k, at // 4, len(x := own[at : at + most]) // 4, zlib.crc32(x)) for k, at in enumerate(range(0, len(own), most))]
                columns = zip(*rows) if rows else [()] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            ids.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Bag:
    """A multiset of piece lengths; a bit mask of those present answers 'largest up to' and 'smallest'."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.items: list[list[int]] = [[] for _ in range(capacity + 1)]
        for i in range(len(lengths) - 1, -1, -1):
            self.items[lengths[i]].append(i)
        self.mask = sum(1 << w for w in range(capacity + 1) if self.items[w])

    def take(self, w: int) -> int:
        out = self.items[w].pop()
        if not self.items[w]:
            self.mask ^= 1 << w
        return out

    def give(self, w: int, item: int) -> None:
        self.items[w].append(item)
        self.mask |= 1 << w

    def largest(self, limit: int) -> int:
        """Largest length up to ``limit``; 0 if none (no piece is empty)."""
        return max(0, (self.mask & ((2 << limit) - 1)).bit_length() - 1) if limit > 0 else 0

    def above(self, w: int) -> int:
        """Smallest length over ``w``; 0 if none."""
        rest = self.mask >> (w + 1)
        return w + (rest & -rest).bit_length() if rest else 0

    def smallest(self, n: int) -> list[int]:
        out, w = [], 0
        while len(out) < n and (w := self.above(w)):
            out += [w] * min(n - len(out), len(self.items[w]))
        return out


def best_pair(bag: Bag, room: int) -> tuple[int, int]:
    """Lengths a >= b of two pieces in the bag with the largest sum that fits the room; (0, 0) if none."""
    best, a = (0, 0), bag.largest(room)
    while a and 2 * a > sum(best):
        b = bag.largest(min(a if len(bag.items[a]) > 1 else a - 1, room - a))
        if b and a + b > sum(best):
            best = (a, b)
        a = bag.largest(a - 1)
    return best


def dominating(bag: Bag, room: int) -> list[int] | None:
    """Lengths to add to a piece that leaves ``room``, such that with it they dominate every feasible set; else None."""
    low = bag.smallest(3)
    if not low or low[0] > room:
        return []  # nothing fits beside it
    one = bag.largest(room)
    if one == room or len(low) < 2 or low[0] + low[1] > room:
        return [one]  # a perfect fit, or a single partner at most: the largest stands for any other
    if len(low) < 3 or sum(low) > room:  # two partners at most
        a, b = best_pair(bag, room)
        if one >= a + b:
            return [one]  # exchanged for any pair as a whole
        if a == one:  # dominates if no feasible pair has a second piece over b
            x = bag.above(b)
            y = x if x and len(bag.items[x]) > 1 else bag.above(x) if x else 0
            if not y or x + y > room:
                return [a, b]
    return None


def pack(lengths: np.ndarray, capacity: int, passes: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    place, offset = np.full(len(lengths), -1), np.zeros(len(lengths), np.int64)
    bag, n = Bag(lengths, capacity), 0
    for _ in range(passes):
        fixed, w = 0, bag.largest(capacity)
        while w:
            held = []
            while bag.items[w]:
                j = bag.take(w)
                partners = dominating(bag, capacity - w)
                if partners is None:
                    held.append(j)
                    break  # pieces of this length are alike
                at = 0
                for i, size in [(j, w), *((bag.take(x), x) for x in partners)]:
                    place[i], offset[i], at = n, at, at + size
                n, fixed = n + 1, fixed + 1
            for j in held:
                bag.give(w, j)
            w = bag.largest(w - 1)
        if not fixed or not bag.mask:
            break
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by space left: (sequence, its length)
    free, w = 0, bag.largest(capacity)
    while w:
        i = bag.take(w)
        if rest := free >> w:
            r = w + (rest & -rest).bit_length() - 1
            k, used = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            k, used, r, n = n, 0, capacity, n + 1
        place[i], offset[i] = k, used
        if r > w:
            room[r - w].append((k, used + w))
            free |= 1 << (r - w)
        w = bag.largest(w)
    return place, offset


def pack_pieces(pieces: DataFrame, n_docs: int, p: Params) -> DataFrame:
    """``pieces`` with sequence_id and offset. Full pieces are sequences by themselves."""
    groups = max(1, -(-n_docs // p.group))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32", "start", "length"], kind="stable").reset_index(drop=True)
        place, offset = pack(rows["length"].to_numpy(dtype=np.int64), p.capacity, p.passes)
        # numbered apart: group g uses g, g + groups, g + 2 * groups and so on
        return rows.drop(columns="g").assign(sequence_id=int(key[0]) + place * groups, offset=offset)

    # pieces alike in everything are counted before the shuffle and numbered after it: so repeated rows, and those of null
    # id, spread over the groups like all others, and a task run again deals them out the same way
    own = [k.split()[0] for k in PIECES.split(", ")]
    alike = pieces.groupBy(*own).agg(F.count("*").cast("int").alias("n"))
    every = alike.select(*own, F.explode(F.sequence(F.lit(1), "n")).alias("nth"))
    dealt = every.withColumn("g", F.pmod(F.xxhash64(*own, "nth"), F.lit(groups))).drop("nth")
    return dealt.groupBy("g").applyInPandas(run, PIECES + ", sequence_id long, offset long")


def best_fit(docs: DataFrame, p: Params) -> DataFrame:
    """Pack all documents; one row per piece, with doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A null or empty text is one piece that holds the end id alone. Rows count one by one: a repeated doc_id or a null
    one has pieces for each of its rows. An empty table gives no rows; other columns are ignored. Ties in length are
    broken by doc_id and piece, so that reruns agree."""
    docs = docs.select("doc_id", "text")
    return pack_pieces(cut_up(docs, p), docs.count(), p)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10(spark, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"), Params(word_bpe()))
