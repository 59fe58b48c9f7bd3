"""Operator 12, source divergence audit by mergeable radix tries.

Each task counts the terms of its documents in byte tries, one a language, whose leaves have a counter for each source:
occurrences, and documents. Counters lie in flat arrays by leaf and source, added up some hundred thousand terms at a
time. Tries that have grown to a bound are sent off and new ones begun. What is sent are subtries, cut at prefixes of a
few bytes; ranges of prefixes are dealt to tasks, which merge the subtries of a prefix into one trie and walk it in
UTF-8 order. The walk drops the terms that too few documents of the language hold and numbers the others; the numbers
of a task go on from those of the ranges before it, and even chunks are cut of a language's numbers, whatever the tasks.

Totals of each group come from the kept counts. A second walk goes through each chunk in the same order with the totals of
its language: it adds up the differences of each pair of sources, and streams the candidates of each group, whose ties
are thus in UTF-8 order. Sums and candidates of the chunks, not terms, meet in the end.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import BROADCAST_IDS, cut, table

#: Bytes of terms lower-cased, all others to spaces: a term is a run of ASCII letters and characters from U+0080 on.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Params:
    #: A language keeps the terms that so many of its documents hold.
    min_docs: int = 30
    #: Added to each count.
    prior: int = 5
    #: Probabilities are whole numbers of this unit.
    unit: int = 1_000_000_000
    #: Terms listed of each group.
    top: int = 50
    #: Counters (term and source) in a task's tries before they are sent off, and terms added up at a time.
    held: int = 1_000_000
    fold: int = 1 << 19
    #: Bytes of the prefixes at which tries are cut.
    prefix: int = 4
    #: Kept terms, and sources, of a block of the second walk.
    chunk: int = 2048
    sources: int = 256
    #: Bytes of a text counted at a time.
    slab: int = 1 << 22


class Trie:
    """A byte radix trie that numbers its keys as they come. A node is [label, children by first byte, leaf number]."""

    def __init__(self):
        self.root, self.size = [b"", {}, None], 0

    def leaf(self, key: bytes) -> int:
        """The number of a key, which is inserted if it is new."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None]
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            n = 1
            while n < len(label) and at + n < len(key) and label[n] == key[at + n]:
                n += 1
            upper = [label[:n], {label[n]: child}, None]  # the edge is split
            child[0] = label[n:]
            node[1][key[at]] = upper
            node, at = upper, at + n
        if node[2] is None:
            node[2] = self.size
            self.size += 1
        return node[2]

    def walk(self) -> Iterator[tuple[bytes, int]]:
        """Keys and leaves in byte order, which is that of UTF-8."""
        stack = [(b"", self.root)]
        while stack:
            head, node = stack.pop()
            head += node[0]
            if node[2] is not None:
                yield head, node[2]
            if len(node[1]) == 1:
                stack += [(head, child) for child in node[1].values()]
            elif node[1]:
                stack += [(head, node[1][b]) for b in sorted(node[1], reverse=True)]


class Leaves(dict):
    """Term -> leaf of a trie: the trie is walked once a term."""

    def __init__(self):
        super().__init__()
        self.trie = Trie()

    def __missing__(self, term: bytes) -> int:
        out = self[term] = self.trie.leaf(term)
        return out


def added(leaf: np.ndarray, group: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counters of equal leaf and group added up, by leaf and then group."""
    order = np.lexsort((group, leaf))
    leaf, group = leaf[order], group[order]
    first = np.flatnonzero(np.r_[True, (leaf[1:] != leaf[:-1]) | (group[1:] != group[:-1])]) if len(leaf) else np.zeros(0, np.int64)
    return leaf[first], group[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


class Counts:
    """The tries of a task, and their counters."""

    def __init__(self):
        self.leaves: dict[int, Leaves] = {}  # by language
        self.parts: dict[int, list[tuple]] = {}
        self.size = 0

    def add(self, lang: int, docs: list[tuple[int, list[bytes], list[int] | None]]) -> None:
        """Documents of a language: source, terms, and how often each comes (once each time if null)."""
        leaves = self.leaves.setdefault(lang, Leaves())
        sizes = np.array([len(t) for _, t, _ in docs])
        leaf = np.fromiter((x for _, t, _ in docs for x in map(leaves.__getitem__, t)), np.int64, int(sizes.sum()))
        times = np.concatenate([np.ones(len(t), np.int64) if n is None else np.array(n, np.int64) for _, t, n in docs])
        doc = np.repeat(np.arange(len(docs)), sizes)
        leaf, doc, times = added(leaf, doc, times)
        source = np.array([s for s, _, _ in docs], np.int64)[doc]
        self.parts.setdefault(lang, []).append(added(leaf, source, times, np.ones(len(leaf), np.int64)))
        self.size += len(self.parts[lang][-1][0])

    def sent(self, n: int) -> Iterator[pa.RecordBatch]:
        """The subtries by language and prefix of ``n`` bytes."""
        for lang, leaves in self.leaves.items():
            walk = list(leaves.trie.walk())
            if not walk:
                continue
            rank = np.empty(len(walk), np.int64)
            rank[[i for _, i in walk]] = np.arange(len(walk))
            parts = [np.concatenate(x) for x in zip(*self.parts[lang])]
            leaf, source, times, docs = added(rank[parts[0]], *parts[1:])
            heads = [k[:n] for k, _ in walk]
            first = [i for i in range(len(walk)) if not i or heads[i] != heads[i - 1]]
            cuts = np.array([*first, len(walk)], np.int32)
            sizes = np.bincount(leaf, minlength=len(walk)).astype(np.int32)
            ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            by = lambda v, at: pa.ListArray.from_arrays(pa.array(at), v)
            columns = [pa.array([heads[i] for i in first], pa.binary()), pa.array([lang] * len(first), pa.int64()), by(pa.array([k[n:] for k, _ in walk], pa.binary()), cuts), by(pa.array(sizes), cuts), *(by(pa.array(v), ends[cuts]) for v in (source, times, docs))]
            batch = pa.RecordBatch.from_arrays(columns, names=["prefix", "lang_id", "terms", "sizes", "source_ids", "times", "docs"])
            yield from (batch.slice(at, 500) for at in range(0, len(first), 500))


#: A subtrie as sent: the rests of its terms, how many counters each has, and the counters one after the other.
SENT = "prefix binary, lang_id long, terms array<binary>, sizes array<int>, source_ids array<long>, times array<long>, docs array<long>"
KEPT = "lang_id long, part long, nth long, term string, source_id long, n long, whole long"


def count(docs: DataFrame, p: Params) -> DataFrame:
    """(lang_id, source_id, text) -> the tasks' tries, a row a subtrie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, size = Counts(), {}, 0
        for b in batches:
            for lang, source, text in zip(b.column("lang_id").to_pylist(), b.column("source_id").to_pylist(), b.column("text")):
                held.setdefault(lang, []).append((source, *terms(text.as_py() or "", p.slab)))
                size += len(held[lang][-1][1])
                if size >= p.fold:
                    for k, d in held.items():
                        out.add(k, d)
                    held, size = {}, 0
                    if out.size >= p.held:
                        yield from out.sent(p.prefix)
                        out = Counts()
        for k, d in held.items():
            out.add(k, d)
        yield from out.sent(p.prefix)

    return docs.mapInArrow(run, SENT)


def terms(text: str, slab: int) -> tuple[list[bytes], list[int] | None]:
    """The terms of a text, one after the other; of a very long one each once, with how often it comes."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) <= slab:
        return raw.translate(FOLD).split(), None
    out, rest = Counter(), b""
    for at in range(0, len(raw), slab):
        piece = rest + raw[at : at + slab].translate(FOLD)
        whole, _, rest = piece.rpartition(b" ") if at + slab < len(raw) else (piece, b"", b"")
        out.update(whole.split())
    return list(out), list(out.values())


def merge(sent: DataFrame, p: Params) -> DataFrame:
    """The subtries of each prefix merged; a row for each kept term of a language and source that has it. ``part`` is the
    task of a term, ascending by prefix, ``nth`` the term's place there among its language's, in UTF-8 order."""

    def walked(rows: list[tuple], part: int, place: Counter) -> Iterator[pa.RecordBatch]:
        """The rows of some neighbouring prefixes, all that there are of each."""
        for lang in {r[1] for r in rows}:
            own, leaves = [r for r in rows if r[1] == lang], Leaves()
            leaf = np.array([leaves[r[0] + t] for r in own for t in r[2].as_py()], np.int64)
            flat = lambda k: np.concatenate([r[k].values.to_numpy() for r in own])
            walk = list(leaves.trie.walk())
            rank = np.empty(len(walk), np.int64)
            rank[[i for _, i in walk]] = np.arange(len(walk))
            leaf, source, times, docs = added(rank[np.repeat(leaf, flat(3))], flat(4), flat(5), flat(6))
            size = np.bincount(leaf, minlength=len(walk))
            first = np.cumsum(size) - size
            keep = np.add.reduceat(docs, first) >= p.min_docs
            whole, nth = np.add.reduceat(times, first), place[lang] + np.cumsum(keep) - 1
            place[lang] += int(keep.sum())
            stay = keep[leaf]
            leaf, source, times = leaf[stay], source[stay], times[stay]
            names = pa.array([t.decode("utf-8", "surrogatepass") if k else None for (t, _), k in zip(walk, keep.tolist())], pa.string())
            n = len(leaf)
            columns = [np.full(n, lang), np.full(n, part), nth[leaf], names.take(pa.array(leaf)), source, times, whole[leaf]]
            batch = pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["lang_id", "part", "nth", "term", "source_id", "n", "whole"])
            yield from (batch.slice(at, 20_000) for at in range(0, n, 20_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, held, size = TaskContext.get().partitionId(), Counter(), [], 0
        for b in batches:
            for k, (prefix, lang) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if size > p.fold and prefix != held[-1][0]:
                    yield from walked(held, part, place)
                    held, size = [], 0
                held.append((prefix, lang, *(b.column(c)[k] for c in range(2, 7))))
                size += len(held[-1][4])
        if held:
            yield from walked(held, part, place)

    # kept, since the ranges are drawn by a look at all prefixes first
    return cut(sent).repartitionByRange("prefix").sortWithinPartitions("prefix").mapInArrow(run, KEPT)


def spans(kept: DataFrame, p: Params) -> DataFrame:
    """lang_id, part, start (kept terms of the language in the parts before), v (those of the language), and width: the
    terms of each of its chunks, as even as can be and ``chunk`` at most."""
    per = Window.partitionBy("lang_id")
    own = kept.groupBy("lang_id", "part").agg((F.max("nth") + 1).alias("own"))
    own = own.select("lang_id", "part", (F.sum("own").over(per.orderBy("part")) - F.col("own")).alias("start"), F.sum("own").over(per).alias("v"))
    chunks = f"((v + {p.chunk} - 1) div {p.chunk})"
    return own.withColumn("width", F.expr(f"(v + {chunks} - 1) div {chunks}"))


def numbered(kept: DataFrame, spans: DataFrame) -> DataFrame:
    """``kept`` with ``nth`` counted through the language, and ``chunk`` in place of ``part``."""
    few = spans.select("lang_id", "part", "start", "width")
    out = kept.join(F.broadcast(few) if few.count() <= BROADCAST_IDS else few, ["lang_id", "part"]).withColumn("nth", F.col("start") + F.col("nth"))
    return out.select("lang_id", F.expr("nth div width").alias("chunk"), "nth", "term", "source_id", "n", "whole")


def share(n: np.ndarray, total: np.ndarray, p: Params) -> np.ndarray:
    """1 + floor(unit * n / total), by long division in steps of 1000, so that no product leaves 64 bits below totals of
    9e15."""
    out, rest, unit = np.zeros(np.broadcast_shapes(n.shape, total.shape), np.int64), n, 1
    while unit < p.unit:
        step = min(1000, p.unit // unit)
        more, rest = np.divmod(rest * step, total)
        out, unit = out * step + more, unit * step
    return out + 1


def block(rows: pd.DataFrame, totals: pd.DataFrame, p: Params) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The terms that the sources have, in order, and of each term the count and the share by source."""
    order = rows.drop_duplicates("nth").sort_values("nth")
    n = np.zeros((len(order), len(totals)), np.int64)
    n[pd.Index(order["nth"]).get_indexer(rows["nth"]), pd.Index(totals["source"]).get_indexer(rows["source"])] = rows["n"].to_numpy()
    return order, n, share(n + p.prior, totals["total"].to_numpy(np.int64)[None, :], p)


def differences(key: tuple, rows: pd.DataFrame, totals: pd.DataFrame, p: Params) -> pd.DataFrame:
    """Sums of |p - q| over a chunk's terms, for each source of the block ``key[2]`` and each of the block ``key[3]``."""
    order, _, q = block(rows, totals, p)
    none = share(np.full((1, len(totals)), p.prior), totals["total"].to_numpy(np.int64)[None, :], p)[0]
    absent = int(totals["terms"].iloc[0]) - len(order)  # terms of the chunk that none of these sources has
    one, two = (np.flatnonzero(totals["block"].to_numpy() == key[k]) for k in (2, 3))
    out = np.zeros((len(one), len(two)), np.int64)
    for k, i in enumerate(one):
        out[k] = np.abs(q[:, two] - q[:, i, None]).sum(axis=0) + absent * np.abs(none[two] - none[i])
    a, b = np.repeat(one, len(two)), np.tile(two, len(one))
    names = totals["source"].to_numpy()
    out = pd.DataFrame({"lang": key[0], "source": names[a], "item": names[b], "value": out.ravel()})[a != b]
    return out if key[2] == key[3] else pd.concat([out, out.rename(columns={"source": "item", "item": "source"})])


def candidates(key: tuple, rows: pd.DataFrame, totals: pd.DataFrame, p: Params) -> pd.DataFrame:
    """The best terms of a chunk for each source of a block; equal ones in the order of the walk."""
    order, n, q = block(rows, totals, p)
    whole = share(order["whole"].to_numpy(np.int64) + p.prior, totals["lang_total"].to_numpy(np.int64)[:1], p)
    terms_, out = order["term"].tolist(), []
    for i, source in enumerate(totals["source"]):
        f = np.where((n[:, i] > 0) & (q[:, i] > whole), q[:, i] - whole, 0)
        best = heapq.nsmallest(p.top, zip((-f).tolist(), range(len(f))))
        out += [(key[0], source, terms_[k], -v) for v, k in best if v < 0]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"]).astype({"value": "int64"})


def audit(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """lang, source, part, item, value and rank: how each (lang, source) differs from the other sources of its language
    (part ``pair``: all of them) and by which terms it stands out from its language (part ``term``: the first ``top``).

    Null text, lang and source are empty strings. A group without terms counts: its shares are those of the prior. A
    language without kept terms has pairs of value 0 and no terms. Repeated rows count as often as they come; an empty
    table gives no rows; other columns are ignored. Sources of one language are compared all with all, as the result
    has a row for each pair; they are dealt in blocks, so no task holds more than two blocks of them."""
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    ids = {"lang_id": F.xxhash64("lang"), "source_id": F.xxhash64("source")}
    kept = cut(merge(count(docs.withColumns(ids).select(*ids, "text"), p), p))
    # totals by group: kept occurrences, kept terms of the language, and its own total
    own = kept.groupBy("lang_id", "source_id").agg(F.sum("n").alias("n"))
    parts = cut(spans(kept, p))
    langs_ = parts.select("lang_id", "v", "width").distinct()
    groups = docs.select("lang", "source").distinct().withColumns(ids)
    groups = groups.join(own, ["lang_id", "source_id"], "left").join(langs_.select("lang_id", "v"), "lang_id", "left")
    per = Window.partitionBy("lang").orderBy("source")
    smooth = p.prior * F.coalesce("v", F.lit(0))
    groups = groups.select("lang", "source", *ids, (F.coalesce("n", F.lit(0)) + smooth).alias("total"), (F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy("lang")) + smooth).alias("lang_total"), F.floor((F.row_number().over(per) - 1) / p.sources).cast("int").alias("block"))
    groups = cut(groups)
    n_lang, n_source, langs, sources = groups.agg(F.count_distinct("lang_id"), F.count_distinct("source_id"), F.count_distinct("lang"), F.count_distinct("source")).first()
    if (n_lang, n_source) != (langs, sources):
        raise ArithmeticError("two names have one 64-bit hash")
    named = groups.select("lang", "source", *ids, "block")
    rows = numbered(kept, parts).join(named, ["lang_id", "source_id"]).select("lang", "chunk", "nth", "term", "source", "n", "whole", "block")
    chunks = langs_.select("lang_id", "v", "width", F.explode(F.expr("sequence(0, (v - 1) div width)")).alias("chunk"))
    chunks = chunks.select("lang_id", "chunk", F.least("width", F.expr("v - chunk * width")).alias("terms"))
    blocks = groups.select("lang", "block").distinct()
    pairs = blocks.withColumnRenamed("block", "i").join(blocks.withColumnRenamed("block", "j"), "lang").filter("i <= j")

    out = "lang string, source string, item string, value long"
    key = ["lang", "chunk"]
    dealt = groups.join(chunks, "lang_id")
    renamed = lambda t: t.select(*(F.col(c).alias(c) for c in t.columns))  # noqa: E731  columns of its own beside those of rows
    # every chunk with every pair of blocks of sources; a row has its own block only
    tiles = lambda t: renamed(t.join(pairs, "lang").filter("block in (i, j)")).groupBy(*key, "i", "j")
    by_pair = tiles(rows).cogroup(tiles(dealt)).applyInPandas(lambda k, a, b: differences(k, a, b, p), out)
    by_pair = by_pair.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # sources that no chunk of kept terms has met: languages without kept terms
    every = groups.alias("a").join(groups.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
    every = every.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"))
    by_pair = every.join(by_pair, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
    by_term = rows.groupBy(*key, "block").cogroup(renamed(dealt).groupBy(*key, "block")).applyInPandas(lambda k, a, b: candidates(k, a, b, p) if len(a) else pd.DataFrame(columns=["lang", "source", "item", "value"]), out)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda t, part: t.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(by_pair, "pair").unionByName(ranked(by_term, "term").filter(F.col("rank") <= p.top))


def op12(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


#: op12 over all terms, groups and pairs.
SQL = r"""
with d as (select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') as text from documents),
t as (select id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
k as (select lang, term from (select distinct lang, term, id from t) group by lang, term having count(*) >= 30),
c as (select t.lang, t.source, t.term, count(*)::hugeint n from t join k using (lang, term) group by all),
g as (select distinct lang, source from d),
v as (select lang, count(k.term)::hugeint v from (select distinct lang from d) join_ left join k using (lang) group by lang),
full_ as (select g.lang, g.source, k.term, coalesce(c.n, 0) n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
p as (select lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * v) p from full_ join v using (lang)),
q as (select lang, term, 1 + (1000000000 * (sum(n) + 5)) // (sum(sum(n)) over (partition by lang) + 5 * any_value(v)) q from full_ join v using (lang) group by lang, term),
pairs as (select a.lang, a.source, b.source item from g a join g b on a.lang = b.lang and a.source <> b.source),
sums as (select a.lang, a.source, b.source item, sum(abs(a.p - b.p)) s from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (select lang, source, 'pair' part, item, coalesce(s, 0)::bigint as value from pairs left join sums using (lang, source, item)),
e as (select p.lang, p.source, 'term' part, p.term item, (p.p - q.q)::bigint as value from p join q using (lang, term) where p.n > 0 and p.p > q.q)
select * from (select *, row_number() over (partition by lang, source order by value desc, item)::int rank from r
  union all select *, row_number() over (partition by lang, source order by value desc, item)::int rank from e)
where part = 'pair' or rank <= 50
"""
