"""Operator 11, hard-negative mining by bit-sliced integer products.

Components are whole numbers, and a vector is its bit planes: component = sum of 2^k * plane_k, less an offset that makes
all of them non-negative. The score against an anchor is the weighted sum of the planes' products with it. Planes are
taken from the most significant one on. After each, what the planes to come can add lies between (2^k - 1) times the
anchor's negative and its positive components, so each candidate has an interval that holds its score and halves with
every plane. A candidate is dropped when its interval can no longer qualify: below as many lower ends as are wanted, or
outside every window that a positive allows. After the last plane intervals are scores.

Two passes do that, for positives and then for negatives. In each, anchors and rows are dealt in blocks, and a pair of
blocks is the unit of work: its task returns the few best of each anchor, and the best of all blocks meet in a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, table


@dataclass(frozen=True)
class Params:
    positives: int = 5
    negatives: int = 3
    #: Components are floor(scale * x).
    scale: int = 256
    #: A negative's score in per cent of the positive's: from and to, each times ``whole``.
    low: int = 50
    high: int = 95
    whole: int = 100
    #: Rows of a block, and anchors of one.
    block: int = 4096
    anchors: int = 512
    #: While more than this share of a block's pairs is alive, planes are multiplied as matrices; then pair by pair.
    dense: float = 0.1


#: Largest component: products of two, over vectors of up to a million components, stay within a long.
MOST = 1 << 20


def whole_numbers(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(scale * x.cast("double")).cast("long"))


def usable(v: Column) -> Column:
    """Non-null and of finite components."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


class Planes:
    """The vectors of a block as bit planes, most significant first."""

    def __init__(self, v: np.ndarray):
        self.offset = int(v.min(initial=0))
        high = v - self.offset
        self.bits = range(int(high.max(initial=0)).bit_length() - 1, -1, -1)
        self.of = {k: (high >> k & 1).astype(np.float64) for k in self.bits}


class Intervals:
    """Intervals of the scores of anchors (rows) and vectors (columns), tightened a plane at a time.

    Pairs are all of a matrix first; once few are alive, a list of them, by rows. Sums of whole numbers below 2^53 are
    exact in double precision."""

    def __init__(self, anchors: np.ndarray, planes: Planes, alive: np.ndarray, dense: float):
        self.a, self.planes, self.dense = anchors.astype(np.float64), planes, dense
        self.up, self.down = np.maximum(anchors, 0).sum(axis=1), np.minimum(anchors, 0).sum(axis=1)
        self.alive, self.pairs = alive, None
        self.sum = np.repeat((planes.offset * anchors.sum(axis=1))[:, None], alive.shape[1], axis=1)
        self.settle()

    def settle(self) -> None:
        """From the matrix to a list, if few pairs are alive."""
        if self.pairs is None and np.count_nonzero(self.alive) <= self.dense * self.alive.size:
            self.pairs = np.nonzero(self.alive)
            self.sum = self.sum[self.pairs]

    def add(self, k: int) -> None:
        bits = self.planes.of[k]
        if self.pairs is None:
            self.sum += (self.a @ bits.T).astype(np.int64) << k
            return
        r, c = self.pairs
        for at in range(0, len(r), 1 << 16):
            part = slice(at, at + (1 << 16))
            self.sum[part] += np.einsum("ij,ij->i", self.a[r[part]], bits[c[part]]).astype(np.int64) << k

    def ends(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the intervals once plane ``k`` is taken, as a matrix or by pair."""
        at = (slice(None), None) if self.pairs is None else self.pairs[0]
        rest = (1 << k) - 1
        return self.sum + rest * self.down[at], self.sum + rest * self.up[at]

    def keep(self, stay: np.ndarray) -> None:
        if self.pairs is None:
            self.alive &= stay
            self.settle()
        else:
            r, c = self.pairs
            self.pairs, self.sum = (r[stay], c[stay]), self.sum[stay]

    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and sums of the pairs alive."""
        if self.pairs is not None:
            return *self.pairs, self.sum
        r, c = np.nonzero(self.alive)
        return r, c, self.sum[r, c]


def nth_largest(rows: np.ndarray, values: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each of ``size`` rows (ascending) its ``n``-th largest value; the least possible where there are fewer."""
    out, cuts = np.full(size, np.iinfo(np.int64).min), np.searchsorted(rows, np.arange(size + 1))
    for i in np.flatnonzero(np.diff(cuts) >= n):
        v = values[cuts[i] : cuts[i + 1]]
        out[i] = np.partition(v, len(v) - n)[len(v) - n]
    return out


def best(anchors: np.ndarray, planes: Planes, alive: np.ndarray, n: int, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs alive, those that can be among the first ``n`` of their anchor in the block, ties included: rows,
    columns, scores. A column that stands for several rows counts once here, which keeps too many and none too few."""
    x = Intervals(anchors, planes, alive, max(p.dense, 0.5))  # n of each row, whatever the matrix: a list is soon better
    for k in planes.bits:
        x.add(k)
        if x.pairs is None:
            x.pairs = np.nonzero(x.alive)
            x.sum = x.sum[x.pairs]
        low, high = x.ends(k)
        r = x.pairs[0]
        x.keep(high >= nth_largest(r, low, n, len(anchors))[r])
    return x.listed()


def within(anchors: np.ndarray, windows: np.ndarray, owner: np.ndarray, planes: Planes, alive: np.ndarray, n: int, p: Params) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for windows of scores, each (from, to) of one anchor, ``owner``: for each window's pairs the window, the
    column and the score. While pairs are a matrix, they are tested against all windows of the anchor as one."""
    x = Intervals(anchors, planes, alive, p.dense)
    slots = [np.flatnonzero((owner == i) & (windows[:, 0] <= windows[:, 1])) for i in range(len(anchors))]
    depth = max(map(len, slots), default=0)
    lo, hi = np.full((depth, len(anchors)), np.iinfo(np.int64).max), np.full((depth, len(anchors)), np.iinfo(np.int64).min)  # empty
    name = np.zeros((depth, len(anchors)), np.int64)
    for i, of in enumerate(slots):
        lo[: len(of), i], hi[: len(of), i], name[: len(of), i] = windows[of, 0], windows[of, 1], of
    least, most = (lo.min(axis=0), hi.max(axis=0)) if depth else (np.full(len(anchors), 1), np.full(len(anchors), 0))
    for k in planes.bits:
        x.add(k)
        low, high = x.ends(k)
        if x.pairs is None:
            x.keep((high >= least[:, None]) & (low <= most[:, None]))
            continue
        r, stay = x.pairs[0], np.zeros(len(low), bool)
        for j in range(depth):
            can = (high >= lo[j][r]) & (low <= hi[j][r])
            sure = (low >= lo[j][r]) & (high <= hi[j][r])
            stay |= can & (high >= nth_largest(r[sure], low[sure], n, len(anchors))[r])
        x.keep(stay)
    r, c, s = x.listed()
    out = []
    for j in range(depth):
        can = np.flatnonzero((s >= lo[j][r]) & (s <= hi[j][r]))
        can = can[s[can] >= nth_largest(r[can], s[can], n, len(anchors))[r[can]]]
        out.append((name[j][r[can]], c[can], s[can]))
    return out


def first(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, copies: np.ndarray, n: int) -> np.ndarray:
    """Places of each group's first ``n`` by score and id, those that several rows share once."""
    order = np.lexsort((vec_id, -score, group))
    g, w = group[order], copies[order]
    start = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    before = np.cumsum(w) - w
    before = before - np.repeat(before[start], np.diff(np.r_[np.flatnonzero(start), len(g)]))
    return order[before < n]


def vectors(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["v"].to_numpy()).astype(np.int64).reshape(len(rows), -1)


POSITIVES = "a long, vec_id long, score long, n int"
NEGATIVES = "a long, slot int, vec_id long, score long, n int"


def positives(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame, p: Params) -> pd.DataFrame:
    if not len(anchors) or not len(rows):
        return pd.DataFrame({"a": [], "vec_id": [], "score": [], "n": []})
    same = anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]
    # an anchor's own row is no other one, but its copies are
    copies = rows["copies"].to_numpy()[None, :] - (anchors["a"].to_numpy()[:, None] == rows["a"].to_numpy()[None, :])
    r, c, s = best(vectors(anchors), Planes(vectors(rows)), same & (copies > 0), p.positives, p)
    n, ids = copies[r, c], rows["vec_id"].to_numpy()[c]
    at = first(r, s, ids, n, p.positives)
    return pd.DataFrame({"a": anchors["a"].to_numpy()[r[at]], "vec_id": ids[at], "score": s[at], "n": np.minimum(n[at], p.positives)})


def negatives(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame, p: Params) -> pd.DataFrame:
    if not len(anchors) or not len(rows):
        return pd.DataFrame({"a": [], "slot": [], "vec_id": [], "score": [], "n": []})
    other = anchors["label"].to_numpy()[:, None] != rows["label"].to_numpy()[None, :]
    scores = anchors["scores"].tolist()
    owner = np.repeat(np.arange(len(anchors)), [len(s) for s in scores])
    slot = np.concatenate([np.arange(len(s)) for s in scores])
    s = np.concatenate(scores).astype(np.int64)
    # low * s <= whole * score <= high * s, in whole numbers
    windows = np.stack([-(-p.low * s // p.whole), p.high * s // p.whole], axis=1)
    out = []
    ids = rows["vec_id"].to_numpy()
    for w, c, x in within(vectors(anchors), windows, owner, Planes(vectors(rows)), other, p.negatives, p):
        n = rows["copies"].to_numpy()[c]
        at = first(w, x, ids[c], n, p.negatives)
        out.append(pd.DataFrame({"a": anchors["a"].to_numpy()[owner[w[at]]], "slot": slot[w[at]], "vec_id": ids[c[at]], "score": x[at], "n": np.minimum(n[at], p.negatives)}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "slot": [], "vec_id": [], "score": [], "n": []})


def mine(rows: DataFrame, p: Params = Params(), relabel: Column | None = None, anchor: Column | None = None) -> DataFrame:
    """(vec_id, embedding, label) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``relabel`` is the label to go by, ``anchor`` says which rows are anchors (default: ids divisible by 50). A row with a
    null id, label or vector, or a component that is null or not finite, takes no part, nor does one with a component
    beyond +-2^20 after scaling, whose scores might not be longs. Vectors of different lengths have no score; empty ones
    score 0. Rows that come several times count as often, as anchors, positives and negatives. An empty table gives no
    rows; other columns are ignored."""
    relabel = F.col("label") if relabel is None else relabel
    anchor = F.col("vec_id") % 50 == 0 if anchor is None else anchor
    v = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(v)
    kept = rows.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), relabel.cast("long").alias("label"), anchor.alias("anchor"), whole_numbers(v, p.scale).alias("v"))
    kept = kept.filter(F.forall("v", lambda x: F.abs(x) <= MOST)).withColumn("v", F.col("v").cast("array<int>"))
    kept = kept.groupBy("vec_id", "label", "v").agg(F.count("*").cast("int").alias("copies"), F.bool_or("anchor").alias("anchor"))
    # numbered once: the checkpoint has the numbers
    kept = cut(kept.withColumns({"a": F.monotonically_increasing_id(), "dim": F.size("v")}))
    n, n_anchors = kept.agg(F.count("*"), F.count_if("anchor")).first()
    blocks, of_anchors = max(1, -(-n // p.block)), max(1, -(-n_anchors // p.anchors))
    place = lambda k, seed: F.pmod(F.xxhash64("a", F.lit(seed)), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    right = kept.select("dim", "a", "vec_id", "label", "v", "copies", place(blocks, 1).alias("j")).withColumn("i", every(of_anchors)).groupBy("dim", "i", "j")
    anchors = kept.filter("anchor").select("dim", "a", "vec_id", "label", "v", "copies", place(of_anchors, 2).alias("i"))

    def ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
        """The first ``most`` of each, rows of equal ids and vectors one by one."""
        by = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        each = found.withColumn("_", F.explode(F.sequence(F.lit(1), "n"))).drop("_", "n")
        return each.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= most)

    left = anchors.withColumn("j", every(blocks)).select("dim", "i", "j", "a", "label", "v").groupBy("dim", "i", "j")
    found = ranked(left.cogroup(right).applyInPandas(lambda k, a, b: positives(k, a, b, p), POSITIVES), ["a"], p.positives)
    pos = cut(found.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("pos")))
    anchors = cut(anchors.join(pos, "a").withColumn("scores", F.transform("pos", lambda x: x["score"])))
    left = anchors.withColumn("j", every(blocks)).select("dim", "i", "j", "a", "label", "v", "scores").groupBy("dim", "i", "j")
    found = ranked(left.cogroup(right).applyInPandas(lambda k, a, b: negatives(k, a, b, p), NEGATIVES), ["a", "slot"], p.negatives)
    out = found.withColumnRenamed("vec_id", "negative_id").join(anchors.select("a", "vec_id", "copies", "pos"), "a")
    out = out.withColumn("p", F.get("pos", F.col("slot"))).withColumn("_", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select(F.col("vec_id").alias("anchor_id"), F.col("p.vec_id").alias("positive_id"), "rank", "negative_id", F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op11(spark, sf_dir: str) -> DataFrame:
    """Ids divisible by 7 get a wrong label first."""
    rows = table(spark, sf_dir, "embeddings")
    return mine(rows, relabel=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


#: op11 by all scores of the anchors.
SQL = """
with v as (select row_number() over () r, vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint label,
  list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
s as (select a.r, a.vec_id anchor_id, a.label, b.vec_id, b.label other, list_dot_product(a.e, b.e)::bigint s
  from v a join v b on a.r <> b.r and len(a.e) = len(b.e) where a.vec_id % 50 = 0),
p as (select *, row_number() over (partition by r order by s desc, vec_id) k from s where other = label qualify k <= 5),
n as (select p.r, p.k, p.anchor_id, p.vec_id positive_id, s.vec_id negative_id, p.s positive_score, s.s negative_score,
  row_number() over (partition by p.r, p.k order by s.s desc, s.vec_id)::int rank
  from p join s on s.r = p.r and s.other <> s.label and 50 * p.s <= 100 * s.s and 100 * s.s <= 95 * p.s)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
