"""Operator 13, SentencePiece encoding and decoding by vectorised merge rounds.

A text is normalized as the model asks (spaces become U+2581, one more before the text) and cut into chunks, a run of
spaces with what follows it. No piece of a model that splits at white space reaches over such a cut, so chunks are
encoded on their own, and each distinct one of a slab of texts once. New chunks are cut further between neighbouring
characters that no piece has side by side. What is left are words: runs of symbols in one flat array.

A round looks up the rank of each pair of neighbours, finds the least rank of each word, and merges all pairs of that
rank at once, from the left and without overlap; words without pairs leave the arrays. That equals merging one pair at
a time unless a merge makes a pair of no worse rank, which then comes next. The round tests each merge for that; the
few words that hold such a merge are gone through from left to right. Characters outside the vocabulary become bytes.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import table

#: Chunks of up to so many characters are remembered, so many of them, until the task ends.
LONG, KNOWN = 32, 300_000
#: Characters of texts whose chunks are encoded together.
SLAB = 1 << 21
SPACE = "▁"
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: What an unknown piece decodes to.
UNKNOWN_TEXT = " ⁇ "
NONE = np.iinfo(np.int32).max


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


codecs.register_error("skein-each-byte", _each_byte)


class Unsupported(ValueError):
    """A model with features beyond byte-pair pieces, byte fallback and white-space escaping."""


class Model:
    """A byte-pair SentencePiece model: its tables, ``encode`` and ``decode``."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as format_

        m = format_.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n, t = m.normalizer_spec, m.trainer_spec
        kinds = {p.type or NORMAL for p in m.pieces}
        if t.model_type != 2 or not t.byte_fallback or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or t.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or m.denormalizer_spec.precompiled_charsmap:
            raise Unsupported(path)
        self.prefix = n.add_dummy_prefix
        ids = {p.piece: i for i, p in enumerate(m.pieces) if (p.type or NORMAL) == NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids):
            raise Unsupported(f"{path}: pieces across words")
        # symbols: ids of pieces, then the characters of pieces that are none themselves
        own = dict(ids)
        for p in ids:
            for c in p:
                own.setdefault(c, len(m.pieces) + len(own) - len(ids))
        self.width = len(m.pieces) + len(own) - len(ids)
        scores = np.array([p.score for p in m.pieces], np.float32)
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)  # equal scores are equal ranks
        pairs = [(own[p[:k]] * self.width + own[p[k:]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in own and p[k:] in own]
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.made = np.array([i for _, i in pairs] + [-1], np.int32)
        self.rank = np.append(rank, np.int32(NONE))  # of piece -1: none
        # characters that can merge, numbered from 1, and which of them stand side by side in a piece
        near = sorted({c for p in ids if len(p) > 1 for c in p})
        self.dense = np.zeros(0x110000, np.int32)
        self.dense[[ord(c) for c in near]] = np.arange(1, len(near) + 1)
        self.beside = np.zeros((len(near) + 1,) * 2, bool)
        for p in ids:
            at = self.dense[[ord(c) for c in p]] if len(p) > 1 else []
            for a, b in zip(at, at[1:]):
                self.beside[a, b] = True
        self.symbol = np.full(0x110000, -1, np.int32)
        for c, i in own.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        self.is_piece = np.zeros(self.width, bool)
        self.is_piece[list(ids.values())] = True
        self.byte = np.zeros(256, "<i4")
        for i, p in enumerate(m.pieces):
            if p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
        text = {CONTROL: lambda p: b"", UNKNOWN: lambda p: UNKNOWN_TEXT.encode(), BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
        says = [text.get(p.type, lambda p: p.piece.replace(SPACE, " ").encode())(p) for p in m.pieces]
        self.bytes = np.frombuffer(b"".join(says), np.uint8)
        self.length = np.array([len(b) for b in says], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.silent = np.array([p.type == CONTROL for p in m.pieces])
        self.spaced = np.array([(p.type or NORMAL) == NORMAL and p.piece.startswith(SPACE) for p in m.pieces])
        self.known: dict[str, bytes] = {}
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes; -1 for none."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat symbols and the word of each (ascending), merged until no pair is left: symbols and words, in order."""
        done_s, done_w, done_p = [], [], []
        at = np.arange(len(sym))  # places keep the order of what leaves early
        new = np.full(len(sym), -1, np.int32)  # what each symbol makes with the next one of its word
        inside = np.flatnonzero(word[:-1] == word[1:])
        new[inside] = self.pair(sym[inside], sym[inside + 1])
        while len(sym):
            rank = self.rank[new]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            alive = least < NONE
            if not alive.all():  # compaction: finished words leave
                stay = np.repeat(alive, size)
                done_s.append(sym[~stay]), done_w.append(word[~stay]), done_p.append(at[~stay])
                sym, word, at, new, rank, least, size = sym[stay], word[stay], at[stay], new[stay], rank[stay], least[alive], size[alive]
                if not len(sym):
                    break
                first = np.cumsum(size) - size
            floor = np.repeat(least, size)
            hit = rank == floor
            # of neighbouring hits in a run every second one, from its left
            i = np.arange(len(sym))
            begin = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], i, 0))
            take = hit & ((i - begin) % 2 == 0)
            drop = np.zeros(len(sym), bool)
            m, before, after = self.around(sym, word, new, take)
            again = np.minimum(self.rank[before], self.rank[after]) <= floor[m]
            if again.any():
                for w in np.unique(np.searchsorted(first, m[again], "right") - 1):
                    a, b = first[w], first[w] + size[w]
                    out = self.in_turn(sym[a:b].tolist(), int(least[w]))
                    take[a:b] = False
                    sym[a : a + len(out)] = out
                    drop[a + len(out) : b] = True
                    new[a : a + len(out)] = np.r_[self.pair(sym[a : a + len(out) - 1], sym[a + 1 : a + len(out)]), np.int32(-1)]
                still = take[m]
                m, before, after = m[still], before[still], after[still]
            sym[m] = new[m]
            drop[m + 1] = True
            new[m] = after
            ahead = (m > 0) & (word[m - 1] == word[m])
            new[np.where(drop[m - 1], m - 2, m - 1)[ahead]] = before[ahead]
            keep = ~drop
            sym, word, at, new = sym[keep], word[keep], at[keep], new[keep]
        order = np.argsort(np.concatenate([*done_p, at]), kind="stable")
        return np.concatenate([*done_s, sym])[order], np.concatenate([*done_w, word])[order]

    def around(self, sym: np.ndarray, word: np.ndarray, new: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the merges, and what each new symbol makes with its neighbours: on the left with what was merged just
        before, on the right with what is still whole."""
        m = np.flatnonzero(take)
        left = np.where(np.r_[False, False, take[:-2]][m], new[m - 2], sym[m - 1])
        left = np.where((m > 0) & (word[m - 1] == word[m]), left, -1)
        end = np.minimum(m + 2, len(sym) - 1)
        right = np.where((m + 2 < len(sym)) & (word[end] == word[m]), sym[end], -1)
        return m, self.pair(left, new[m]), self.pair(new[m], right)

    def in_turn(self, sym: list[int], floor: int) -> list[int]:
        """One round of one word from left to right, in which a merge may be followed by those that it makes possible."""
        out, k = [], 0

        def made(a: int, b: int) -> tuple[int, int]:
            key = a * self.width + b
            at = int(np.searchsorted(self.keys, key)) if min(a, b) >= 0 else -1
            piece = int(self.made[at]) if self.keys[at] == key else -1
            return int(self.rank[piece]), piece

        memo: dict[tuple[int, int], tuple[int, int]] = {}

        def ask(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in memo:
                memo[a, b] = made(a, b)
            return memo[a, b]

        none = (NONE, -1)
        while k < len(sym):
            one = ask(sym[k], sym[k + 1]) if k + 1 < len(sym) else none
            if one[0] != floor:
                out.append(sym[k])
                k += 1
                continue
            m, k = one[1], k + 2
            while True:
                a, b = ask(out[-1], m) if out else none, ask(m, sym[k]) if k < len(sym) else none
                if min(a[0], b[0]) > floor:
                    break
                if a[0] <= b[0]:
                    out.pop()
                    m = a[1]
                else:
                    m, k = b[1], k + 1
            out.append(m)
        return out

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids, as little-endian 32-bit bytes, of each of some distinct chunks."""
        flat = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        chunk = np.repeat(np.arange(len(chunks)), sizes)
        d = self.dense[flat]
        cut = np.r_[True, ~self.beside[d[:-1], d[1:]] | (chunk[1:] != chunk[:-1])]
        word = np.cumsum(cut) - 1
        # what no piece has is written as bytes: its place in the text stands for it until the end
        sym = self.symbol[flat].copy()
        own = np.flatnonzero(cut)
        sym, word = self.merged(np.where(sym < 0, -2 - np.arange(len(flat), dtype=np.int32), sym), word)
        of = chunk[own[word]]
        known = (sym >= 0) & self.is_piece[np.maximum(sym, 0)]
        if known.all():
            ids, n = sym.astype("<i4"), np.bincount(of, minlength=len(chunks))
        else:
            single = {i: chr(c) for c, i in self.characters.items()}
            raw = [b"" if k else (single[s] if s >= 0 else chr(flat[-2 - s])).encode("utf-8", "surrogatepass") for s, k in zip(sym.tolist(), known.tolist())]
            each = np.where(known, 1, np.fromiter(map(len, raw), np.int64, len(raw)))
            ids = np.repeat(sym, each).astype("<i4")
            ids[np.repeat(~known, each)] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
            n = np.bincount(of, each, len(chunks)).astype(np.int64)
        ends = 4 * np.cumsum(n)
        whole = ids.tobytes()
        return {c: whole[e - 4 * k : e] for c, e, k in zip(chunks, ends.tolist(), n.tolist())}

    @property
    def characters(self) -> dict[int, int]:
        """code point -> symbol, of characters that stand in pieces but are none."""
        at = np.flatnonzero(self.symbol >= 0)
        return {int(c): int(s) for c, s in zip(at, self.symbol[at]) if not self.is_piece[s]}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit bytes."""
        parts = [self.chunks((SPACE if self.prefix and t else "") + t.replace(" ", SPACE)) for t in texts]
        known = self.known
        new = list({c for p in parts for c in p if c not in known})
        if new:
            known.update(self.learn(new))
        out = [b"".join(map(known.__getitem__, p)) for p in parts]
        if len(known) > KNOWN:
            known.clear()
        for c in new:
            if len(c) > LONG:
                known.pop(c, None)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: pieces joined, one leading space of the first that says something left out, bytes that
        are no UTF-8 as U+FFFD each. An id outside the vocabulary is an IndexError."""
        if len(ids) and ids.min() < 0:
            raise IndexError("negative id")
        size = self.length[ids]
        first = np.cumsum(size) - size
        raw = self.bytes[np.repeat(self.start[ids] - first, size) + np.arange(size.sum())].tobytes()
        told = np.flatnonzero(~self.silent[ids])
        if self.prefix and len(told) and self.spaced[ids[told[0]]]:
            raw = raw[1:]  # everything before it is silent
        return raw.decode("utf-8", "skein-each-byte")


@lru_cache(maxsize=1)
def model(path: str) -> Model:
    """The model of this worker, read once for all its tasks."""
    return Model(path)


_GAP = re.compile(f"(?<![ {SPACE}]) (?![ {SPACE}])")


def stretches(text: str) -> Iterator[str]:
    """A text in pieces of about ``SLAB`` characters, cut before single spaces; a piece but the first lacks that space,
    which the encoder puts before each text anyway."""
    at = 0
    while len(text) - at > SLAB and (m := _GAP.search(text, at + SLAB)) and m.end() < len(text):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def slabs(texts: Iterator[str], pieces: bool) -> Iterator[list[tuple[int, str]]]:
    """(number, stretch) lists of about ``SLAB`` characters."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for s in stretches(t) if pieces else [t]:
            held.append((i, s))
            size += len(s)
            if size >= SLAB:
                yield held
                held, size = [], 0
    yield held


#: Rows whose ids and texts are returned together.
ROWS = 512


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the ids of each whole text by the model of ``path``, and if asked with ``decoded``, the text
    that these ids decode to; columns of these names are replaced.

    No begin or end ids, no sampling. A null or empty text has no ids. All other columns pass, whatever their names and
    rows however often they come; an empty table gives no rows."""
    named = {ids.lower(), *([decoded.lower()] if decoded else [])}
    more = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), *([T.StructField(decoded, T.StringType(), False)] if decoded else [])]
    out = T.StructType([*(f for f in docs.schema.fields if f.name.lower() not in named), *more])

    def one(b: pa.RecordBatch, m: Model) -> pa.RecordBatch:
        found: list[list[bytes]] = [[] for _ in range(b.num_rows)]
        for slab in slabs((t.as_py() or "" for t in b.column(text)), m.prefix):
            for (i, _), own in zip(slab, m.encode([s for _, s in slab])):
                found[i].append(own)
        found = [b"".join(f) for f in found]
        ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
        kept = [k for k, f in enumerate(b.schema) if f.name.lower() not in named]
        columns = [*(b.column(k) for k in kept), pa.ListArray.from_arrays(pa.array(ends), values)]
        if decoded:
            columns.append(pa.array([m.decode(np.frombuffer(f, "<i4")) for f in found], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=[*(b.schema.field(k).name for k in kept), ids, *([decoded] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        try:
            for b in batches:
                yield from (one(b.slice(at, ROWS), m) for at in range(0, b.num_rows, ROWS))
        finally:
            m.known.clear()  # a worker lives on through other jobs

    return docs.mapInArrow(run, out)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids``; null for null ids, empty for none. A column of that name is replaced."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(path)
        for a in batches:
            yield pa.array([None if x is None else m.decode(x) for x in (v.values.to_numpy(zero_copy_only=False) if v.is_valid else None for v in a)], pa.string())

    return rows.withColumn(text, run(F.col(ids)))


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with n_tokens, ids_sha256 and decoded_sha256."""
    return encoded.withColumns({"n_tokens": F.size(ids).cast("long"), "ids_sha256": F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256), "decoded_sha256": F.sha2(F.col(decoded), 256)})


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document's whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode(docs, piece_bpe(), decoded="decoded")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
