"""Operator 5, MinHash near-dedup with sequential Bayesian verification (BayesLSH).

1. A document's set of word shingles becomes a fingerprint and a MinHash signature; equal sets are one class, whose
   smallest id stands for it from here on.
2. Bands of the signature form buckets. Instead of all pairs of a bucket, each member is held against the bucket's hub:
   the member that shares most buckets with others, which in a group of near copies is the text they come from.
3. Candidates are compared by batches of signature positions. After each batch the posterior probability of a
   similarity at or over the threshold, under a uniform prior, is bounded from below by ``miss``; pairs under it go.
4. Survivors are verified exactly on the full sets of both texts.
5. Buckets whose members are then still in different components are gone through in tiles of bounded size, which hold
   signatures and no texts: each pair of different components is compared in the first bucket that it shares. Members
   that have a pair which outlasts all batches get their texts, in the same tiles, and such pairs are verified there
   until their components are one. Only members and links leave a tile, never pairs, and no link between components is
   lost.

Texts of sizes that rule the threshold out are never compared. Texts are read as Arrow values one at a time, so a task
holds one batch of them and one set or two.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import WORD, boxed, cut, only, stretches, table
from skein.llm.components import components

#: Words a worker remembers before it starts afresh, if they are no longer than so many bytes.
CACHE_WORDS, LONG_WORD = 1 << 17, 32
#: Pairs compared at once, and shingles of the sets that a tile keeps for further pairs.
PAIRS, KEPT = 1 << 15, 4_000_000


@dataclass(frozen=True)
class Params:
    words: int = 5
    #: Similarity threshold in per cent.
    percent: int = 80
    bands: int = 30
    rows: int = 6
    batch: int = 30
    #: Chosen probability that pruning drops a pair at or over the threshold.
    miss: float = 1e-4
    seed: int = 5
    #: Members of a bucket, and their shingles, in one block of a tile, which has two.
    tile: int = 4096
    tile_shingles: int = 2_000_000

    @property
    def size(self) -> int:
        return self.bands * self.rows


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out


_words = WordHash()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of MurmurHash3."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    """A text's words, A-Z lower-cased, as 64-bit hashes."""
    each = (piece.lower().split() for piece in stretches(text))
    return np.concatenate([np.empty(0, np.uint64), *(np.fromiter(map(_words.__getitem__, ws), np.uint64, len(ws)) for ws in each)])


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-word shingles; of its whole sequence if shorter; empty without words."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = _mix(out * _MIX + h[k : len(h) - n + 1 + k])
    return np.unique(_mix(out + np.uint64(n)))


def signature(s: np.ndarray, p: Params) -> np.ndarray:
    """MinHash values of a non-empty set, their low 16 bits each."""
    a, b = _functions(p.size, p.seed)
    x, out = (s >> np.uint64(32)).astype(np.uint32), np.full(p.size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):  # bounded memory for a text of any length
        np.minimum(out, (a * x[None, at : at + 4096] + b).min(axis=1), out=out)
    return (out ^ (out >> np.uint32(16))).astype(np.uint16)


@cache
def _functions(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, (k, 1), np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, (k, 1), np.uint32)


def band_keys(sigs: np.ndarray, p: Params) -> np.ndarray:
    """Keys by (signature, band)."""
    rows = sigs.reshape(-1, p.bands, p.rows).astype(np.uint64)
    out = np.broadcast_to(_mix(np.arange(1, p.bands + 1, dtype=np.uint64) * _MIX), rows.shape[:2])
    for k in range(p.rows):
        out = _mix(out * _MIX + rows[:, :, k])
    return out.view(np.int64)


def grid(sigs: pa.Array, p: Params) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint16).reshape(-1, p.size)


@cache
def least_matches(p: Params) -> tuple[int, ...]:
    """For each number of compared positions after a batch, the fewest matches that keep a pair.

    With a uniform prior, m matches of n give J ~ Beta(m + 1, n - m + 1), so P(J >= t) = P(Binomial(n + 1, t) <= m)."""
    t, out = p.percent / 100, []
    for n in range(p.batch, p.size + 1, p.batch):
        total, m = 0.0, 0
        while (total := total + math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)) < p.miss:
            m += 1
        out.append(m)
    return tuple(out)


def likely(x: np.ndarray, y: np.ndarray, r: np.ndarray, t: np.ndarray, p: Params) -> np.ndarray:
    """Of the pairs (x[r], y[t]) of signatures: indices of those that outlast all batches."""
    at, same = np.arange(len(r)), np.zeros(len(r), np.int32)
    for k, least in enumerate(least_matches(p)):
        cols = slice(k * p.batch, (k + 1) * p.batch)
        same = same + (x[r[at], cols] == y[t[at], cols]).sum(axis=1, dtype=np.int32)
        stay = same >= least
        at, same = at[stay], same[stay]
    return at


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    inter = len(np.intersect1d(x, y, assume_unique=True))
    return inter > 0 and 100 * inter >= percent * (len(x) + len(y) - inter)


def sketch(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, n_shingles, fingerprint halves f1 and f2, and signature (null for an empty set), with h1 and h2 as they
    are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f, sigs = [], np.zeros((len(b), 2), np.int64), []
            for i, t in enumerate(b.column("text")):
                s = shingles(t.as_py(), p.words)
                n.append(len(s))
                sigs.append(signature(s, p).tobytes() if len(s) else None)
                if len(s):
                    f[i] = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            own = [pa.array(n, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h1"), b.column("h2"), *own], names=names)

    kinds = "doc_id long, h1 long, h2 long, n_shingles long, f1 long, f2 long, sig binary"
    names = [k.split()[0] for k in kinds.split(", ")]
    return docs.select("doc_id", "h1", "h2", "text").mapInArrow(run, kinds)


def bands_of(reps: DataFrame, p: Params) -> DataFrame:
    """(key, doc_id) of every band of every signature."""

    @F.arrow_udf("array<long>")
    def keys(sigs: pa.Array) -> pa.Array:
        flat = band_keys(grid(sigs, p), p).reshape(-1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sigs) + 1, dtype=np.int32) * p.bands), pa.array(flat))

    return reps.select(F.explode(keys("sig")).alias("key"), "doc_id")


def sizes_fit(x, y, p: Params):
    """Whether sets of these sizes can reach the threshold at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * p.percent


def likely_pairs(pairs: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """The (a, b) pairs that neither sizes nor the posterior rule out."""

    @F.arrow_udf("boolean")
    def keep(x: pa.Array, y: pa.Array) -> pa.Array:
        out = np.zeros(len(x), bool)
        if len(x):
            every = np.arange(len(x))
            out[likely(grid(x, p), grid(y, p), every, every, p)] = True
        return pa.array(out)

    of = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").filter(sizes_fit(F.col("n_a"), F.col("n_b"), p))
    return both.filter(keep("sig_a", "sig_b")).select("a", "b").distinct()


def exact_links(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The (a, b) pairs whose full shingle sets reach the threshold."""

    @F.arrow_udf("boolean")
    def test(x: pa.Array, y: pa.Array) -> pa.Array:
        out, last, s = np.zeros(len(x), bool), None, None
        for i in range(len(x)):
            t = x[i].as_py()
            if last != t:  # pairs of one text come in a row
                last, s = t, shingles(t, p.words)
            out[i] = linked(s, shingles(y[i].as_py(), p.words), p.percent)
        return pa.array(out)

    texts = only(docs.select("doc_id", "text"), pairs.selectExpr("explode(array(a, b)) doc_id"), "doc_id")
    of = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(of("b"), "b").join(of("a"), "a").filter(test("text_a", "text_b")).select("a", "b").distinct()


def hubs(buckets: DataFrame) -> DataFrame:
    """(key, hub) of (key, doc_id, n), n being the members of the bucket."""
    degree = buckets.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    best = F.max(F.struct("degree", -F.col("doc_id")))  # ties: the smallest id
    return buckets.join(degree, "doc_id").groupBy("key").agg(best.alias("m")).select("key", (-F.col("m.col2")).alias("hub"))


def tile_pairs(t: pa.Table, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Of whole tiles, sorted by tile, size and id: the rows of the pairs of one tile, but of different components (and, in
    a tile of two blocks, of different blocks), that outlast all batches and share no bucket before the tile's."""
    key, i, j, block, ids, comp, size = (t.column(c).to_numpy() for c in ("key", "i", "j", "block", "doc_id", "comp", "n_shingles"))
    sigs, at, same_block = grid(t.column("sig"), p), np.arange(len(ids)), i == j
    tid = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    # by size, so the partners of a row that are as large and fit are a stretch behind it
    order = tid << np.int64(40)
    most = np.minimum(100 * size // p.percent, (1 << 40) - 1)
    rest = np.searchsorted(order + size, order + most, side="right") - at - 1
    found, held, n, d = [(at[:0], at[:0])], [], 0, 1

    def flush() -> None:
        x, y = (np.concatenate(k) for k in zip(*held))
        for k in range(0, len(x), PAIRS):
            r, u = x[k : k + PAIRS], y[k : k + PAIRS]
            ok = likely(sigs, sigs, r, u, p)
            r, u = r[ok], u[ok]
            first = (sigs[r] == sigs[u]).reshape(-1, p.bands, p.rows).all(axis=2).argmax(axis=1)
            here = band_keys(sigs[r], p)[np.arange(len(r)), first] == key[r]
            found.append((r[here], u[here]))

    act = at[rest >= 1]
    while len(act):
        ok = (comp[act] != comp[act + d]) & (same_block[act] | (block[act] != block[act + d]))
        if ok.any():
            held.append((act[ok], act[ok] + d))
            n += len(held[-1][0])
        if n >= PAIRS:
            flush()
            held, n = [], 0
        d += 1
        act = act[rest[act] >= d]
    if held:
        flush()
    return tuple(np.concatenate(x) for x in zip(*found))


def tile_links(t: pa.Table, p: Params) -> list[tuple[int, int]]:
    """Links of whole tiles, which have texts, that join components not yet joined in the tile."""
    x, y = tile_pairs(t, p)
    ids, comp, size, text = (t.column(c) for c in ("doc_id", "comp", "n_shingles", "text"))
    ids, comp, size = ids.to_numpy(), comp.to_numpy(), size.to_numpy()
    up, sets, out, n = {}, {}, [], 0

    def root(c: int) -> int:
        while (d := up.get(c, c)) != c:
            c = d
        return c

    for r, u in sorted(zip(x.tolist(), y.tolist())):
        a, b = root(comp[r]), root(comp[u])
        if a == b:
            continue
        for k in (r, u):
            if k not in sets:
                if n > KEPT:
                    sets, n = {q: sets[q] for q in (r, u) if q in sets}, 0
                sets[k] = shingles(text[k].as_py(), p.words)
                n += int(size[k])
        if linked(sets[r], sets[u], p.percent):
            up[max(a, b)] = min(a, b)
            out.append((min(ids[r], ids[u]), max(ids[r], ids[u])))
    return out


def by_tile(rows: DataFrame, of, kinds: str) -> DataFrame:
    """``of`` (a function of a table of whole tiles) of all tiles; a task holds a batch of rows and a tile at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last tile, which the next batch may go on with
        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            name = [t.column(c).to_numpy() for c in ("key", "i", "j")]
            other = np.flatnonzero(np.any([x != x[-1] for x in name], axis=0))
            whole = int(other[-1]) + 1 if len(other) else 0
            if whole:
                yield from of(t.slice(0, whole).combine_chunks()).to_batches()
            rest = t.slice(whole)
        if rest is not None:
            yield from of(rest.combine_chunks()).to_batches()

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n_shingles", "doc_id")
    return dealt.mapInArrow(run, kinds)


def cross_links(buckets: DataFrame, docs: DataFrame, reps: DataFrame, comps: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) between different components within a bucket that join all that can be joined so."""
    comp = F.coalesce("component", "doc_id").alias("comp")
    own = buckets.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", comp)
    mixed = own.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    own = own.join(mixed.select("key"), "key").join(reps.select("doc_id", "n_shingles", "sig"), "doc_id")
    per = own.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all"))
    blocks = F.ceil(F.greatest(F.col("n") / p.tile, F.least(F.col("all") / p.tile_shingles, F.col("n")))).cast("int")
    # a member of a bucket of b blocks goes to each tile that its block is part of: b of them
    own = own.join(per.select("key", blocks.alias("blocks")), "key")
    own = own.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "comp", "n_shingles", "sig")
    likely_ones = cut(by_tile(own, lambda t: t.take(pa.array(np.unique(np.concatenate(tile_pairs(t, p))))), own.schema.simpleString()[7:-1]))
    texts = only(docs.select("doc_id", "text"), likely_ones.select("doc_id"), "doc_id")

    def links(t: pa.Table) -> pa.Table:
        a, b = zip(*found) if (found := tile_links(t, p)) else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return by_tile(likely_ones.join(texts, "doc_id"), links, "a long, b long").distinct()


def members(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, h1, h2, n_shingles, f1, f2 and component_id for each row of ``docs`` (doc_id, text, h1, h2)."""
    sk = cut(sketch(docs, p))
    # cut, so that it meets the rows by a shuffle of its own, which can split a set that very many rows have
    first = cut(sk.filter("n_shingles > 0 and doc_id is not null").groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")))
    member = sk.drop("sig").join(first, ["f1", "f2", "n_shingles"], "left")
    member = cut(member.withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))))
    # one row for each class: the others of it are of no further use
    same = (sk["f1"] == first["f1"]) & (sk["f2"] == first["f2"]) & (F.col("doc_id") == F.col("rep"))
    reps = sk.join(first.select("f1", "f2", "rep"), same).select("doc_id", "n_shingles", "sig")
    reps = cut(reps.dropDuplicates(["doc_id", "sig"]))
    keys = bands_of(reps, p)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = cut(keys.join(shared, "key"))
    star = buckets.join(hubs(buckets), "key").filter("doc_id <> hub").select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct()
    links = cut(exact_links(cut(likely_pairs(star, reps, p)), docs, p))
    comps = components(links.unionByName(cross_links(buckets.select("key", "doc_id"), docs, reps, components(links), p)))
    out = member.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", "h1", "h2", "n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id), one row per row of ``docs``.

    Documents without words link with nothing and are their own component. Rows that share an id are judged one by one,
    and a link with either goes by that id. A null id links with nothing: component_id is null and kept is true. An empty table gives no rows;
    other columns are ignored."""
    none = F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", none.alias("h1"), none.alias("h2"))
    out = members(rows, p).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with one document of each group, in all its columns: that of the smallest id.

    Of rows of one id and one set of shingles one stays. A row of null id takes part by a number of its text over 2^62,
    and so is kept only where no row with an id is in its group. Rows of one id but different sets stay or go together.
    Rows without words stay, repeated or not. An empty table gives no rows."""
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    h1, h2 = F.xxhash64("text"), F.xxhash64("text", F.lit(2))
    key = F.coalesce(F.col("doc_id").cast("long"), F.shiftrightunsigned(h1, 2).bitwiseOR(F.lit(1 << 62)))
    rows = docs.filter(has_words).select(boxed(docs).alias("r"), key.alias("doc_id"), "text", h1.alias("h1"), h2.alias("h2"))
    member = members(rows.select("doc_id", "text", "h1", "h2"), p).filter("doc_id = component_id")
    one = F.min(F.struct("h1", "h2")).alias("m")  # of the texts of one id and set
    kept = member.groupBy("doc_id", "f1", "f2", "n_shingles").agg(one).select("doc_id", "m.h1", "m.h2")
    by = ["doc_id", "h1", "h2"]
    # repeated rows meet before the shuffle, and in order for the join
    out = rows.select("r", *by).dropDuplicates(by).join(kept, by, "left_semi").select("r.*")
    return out.unionByName(docs.filter(~has_words))


def op5(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Params(words=4))


#: op5 by all pairs that share a shingle.
SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) < 4 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) end) g from w where len(ws) > 0),
n as (select doc_id, count(*)::bigint n from s group by doc_id),
c as (select x.doc_id a, y.doc_id b, count(*) m from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
links as (select c.a, c.b from c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * c.m >= 80 * (x.n + y.n - c.m)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a doc_id, min(b) b from reach group by a)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) component_id, d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) kept
from documents d left join n using (doc_id) left join low using (doc_id)
"""
