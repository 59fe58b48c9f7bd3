"""Operator 1, embedding near-dedup by a pivot-permutation index.

Every distinct vector is described by its ``prefix`` nearest reference vectors (pivots), in order. The inverted list
of a pivot holds the vectors that have it in their description. Two vectors are candidates if they share ``shared``
pivots or more; candidates are verified by the cosine in double precision. Lists are cut into blocks, and a pair of
blocks is the unit of work, so a list of any length is spread over tasks. A pair is judged in the list of its lowest
shared pivot alone, so it counts once.

Pivots are a bounded sample, drawn by a hash; their number grows with the square root of the distinct vectors, as does
the mean length of a list. Vectors of each length have pivots of their own, numbered together, so one plan serves all
lengths. Equal vectors are one row with a count throughout, under a number of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, table
from skein.llm.components import components


@dataclass(frozen=True)
class Params:
    cosine: float = 0.95
    prefix: int = 8
    shared: int = 2
    #: Pivots of a length: this many times the square root of its number of distinct vectors, within these bounds.
    pivots_per_root: float = 4.0
    min_pivots: int = 16
    max_pivots: int = 32_768
    #: Pivots as near as this to one before are left out.
    apart: float = 0.85
    #: Vectors of a list in one block.
    block: int = 1024
    seed: int = 1


def usable(v: Column) -> Column:
    """Non-null, of finite components, not all zero."""
    big = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(big & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows: list) -> np.ndarray:
    """Rows scaled to length 1, in double precision; scaled by the largest part first, so that no square overflows."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """For each row the k nearest pivots, nearest first; ties go to the lower number."""
    near = np.round(x @ pivots.T, 12)
    k = min(k, near.shape[1])
    top = np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1)
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)


def thin(pivots: np.ndarray, cosine: float) -> np.ndarray:
    """Pivots in order, without those as near as ``cosine`` to one before: in a dense group they would part its members,
    each describing another of them."""
    out, n = pivots.copy(), 1
    for x in pivots[1:]:
        if (out[:n] @ x).max() < cosine:
            out[n], n = x, n + 1
    return out[:n]


def matches(x, y, px, py, pivot: int, same: bool, p: Params) -> np.ndarray:
    """Of two blocks of one pivot's list, which pairs are linked and belong to this list."""
    count = np.zeros((len(x), len(y)), np.int8)
    for i in range(px.shape[1]):
        for j in range(py.shape[1]):
            count += px[:, i, None] == py[None, :, j]
    hit = count >= min(p.shared, px.shape[1])
    if same:
        hit &= np.tri(len(x), dtype=bool, k=-1).T
    if hit.any():
        hit &= x @ y.T >= p.cosine
    r, c = np.nonzero(hit)
    for at in range(0, len(r), 1 << 16):  # the lowest shared pivot
        a, b = px[r[at : at + (1 << 16)]], py[c[at : at + (1 << 16)]]
        low = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.iinfo(np.int32).max).min(axis=1)
        hit[r[at : at + (1 << 16)][low != pivot], c[at : at + (1 << 16)][low != pivot]] = False
    return hit


def spread(hit: np.ndarray, ids: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and each column of a block pair reaches through its links."""
    low, lo2 = ids.copy(), other.copy()
    far = np.iinfo(np.int64).max
    while True:
        row = np.minimum(low, np.where(hit, lo2[None, :], far).min(axis=1))
        col = np.minimum(lo2, np.where(hit, row[:, None], far).min(axis=0))
        if (row == low).all() and (col == lo2).all():
            return low, lo2
        low, lo2 = row, col


def draw(classes: DataFrame, p: Params) -> dict[int, tuple[int, np.ndarray]]:
    """For each length of vectors the number of its first pivot, and its pivots. They are drawn and thinned on Spark, a
    length in a task; the driver gets at most ``max_pivots`` vectors a length."""
    n = classes.groupBy("dim").agg(F.count("*").alias("n"))
    want = F.greatest(F.lit(p.min_pivots), F.least(F.lit(p.max_pivots), F.ceil(p.pivots_per_root * F.sqrt("n")))).cast("int")
    at = F.xxhash64("embedding", F.lit(p.seed))
    some = classes.join(n.select("dim", "n", want.alias("want")), "dim").withColumn("at", at)
    # twice as many as wanted, some more where few are, so that not all vectors are put in order
    some = some.filter(F.pmod("at", F.lit(1 << 31)) * F.col("n") <= (2 * F.col("want") + 64) * F.lit(float(1 << 31)))
    place = F.row_number().over(Window.partitionBy("dim").orderBy("at", "embedding"))
    some = some.withColumn("place", place).filter("place <= want").select("dim", "place", "embedding")

    def apart(rows: pd.DataFrame) -> pd.DataFrame:
        x = thin(unit(rows.sort_values("place")["embedding"].tolist()), p.apart)
        return pd.DataFrame({"dim": rows["dim"].iloc[0], "place": np.arange(len(x)), "embedding": list(x)})

    found = some.groupBy("dim").applyInPandas(apart, "dim int, place int, embedding array<double>").toArrow().sort_by([("dim", "ascending"), ("place", "ascending")])
    dims, flat, out, row, val = found["dim"].to_numpy(), found["embedding"].combine_chunks().flatten().to_numpy(), {}, 0, 0
    for d, k in zip(*np.unique(dims, return_counts=True)):
        out[int(d)] = (row, flat[val : val + k * d].reshape(k, d))
        row, val = row + int(k), val + int(k) * int(d)
    return out


def links(classes: DataFrame, p: Params) -> DataFrame:
    """From (cls, dim, copies, embedding) of distinct vectors: (a, b, n), meaning that a has n more linked vectors and
    is in a component with b."""
    sent = classes.sparkSession.sparkContext.broadcast(draw(classes, p))

    @F.pandas_udf("array<int>")
    def describe(v: pd.Series) -> pd.Series:
        out, dims = np.empty(len(v), object), v.map(len).to_numpy()
        for d in np.unique(dims):
            of, (first, pivots) = np.flatnonzero(dims == d), sent.value[int(d)]
            for at in range(0, len(of), 1024):
                near = nearest(unit(v.iloc[of[at : at + 1024]].tolist()), pivots, p.prefix) + first
                for i, x in zip(of[at : at + 1024], near.astype(np.int32)):
                    out[i] = x
        return pd.Series(out, dtype=object)

    indexed = cut(classes.select("cls", "copies", "embedding", describe("embedding").alias("near")))
    lists = indexed.select(F.explode("near").alias("pivot")).groupBy("pivot").agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    own = indexed.withColumn("pivot", F.explode("near")).join(F.broadcast(lists), "pivot")  # a row a pivot
    own = own.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    own = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("pivot", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "cls", "copies", "near", "embedding")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        one = rows[rows["block"] == key[1]]
        two = rows[rows["block"] == key[2]]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        grid = lambda t: (unit(t["embedding"].tolist()), np.stack(t["near"].to_numpy()), t["cls"].to_numpy(), t["copies"].to_numpy())
        (x, px, a, na), (y, py, b, nb) = grid(one), grid(two)
        hit = matches(x, y, px, py, key[0], key[1] == key[2], p)
        if key[1] == key[2]:
            hit |= hit.T
        low, lo2 = spread(hit, a, b)
        sides = [(a, low, hit @ nb)] + ([] if key[1] == key[2] else [(b, lo2, na @ hit)])
        out = pd.concat([pd.DataFrame({"a": s[0], "b": s[1], "n": s[2]}) for s in sides])
        return out[out["n"] > 0].astype("int64")

    return own.groupBy("pivot", "i", "j").applyInPandas(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id), one row per row of ``vectors``.

    A vector that is null, empty or zero, or holds null or non-finite components, links with nothing; so do vectors of
    different lengths. Rows that share an id and a vector count each; rows that share an id but not the vector are
    judged one by one, each with its own links and component. A row of null id links with nothing, its
    component_id is null and kept is true. An empty table gives no rows; other columns are ignored."""
    kind = vectors.select("embedding").dtypes[0][1]
    # floats stay floats up to the task that computes with them, so that half as much is shuffled
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    ok = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    classes = v.filter(ok).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # numbered once: the checkpoint has the numbers
    classes = cut(classes.select(F.monotonically_increasing_id().alias("cls"), "rep", "copies", F.size("embedding").alias("dim"), "embedding"))
    found = cut(links(classes, p))
    comps = components(found.select("a", "b"))
    # a component's smallest id: of its nodes (minima before the shuffle), and of the one that it is named by
    reps = lambda c: classes.select(F.col("cls").alias(c), "rep")
    least = comps.join(reps("node"), "node").groupBy("component").agg(F.min("rep").alias("m"))
    least = least.join(reps("component"), "component").select("component", F.least("m", "rep").alias("low"))
    low = comps.join(least, "component").select("node", "low").unionByName(least.withColumnRenamed("component", "node"))
    more = found.groupBy("a").agg(F.sum("n").alias("more"))
    of = classes.join(more, classes["cls"] == more["a"], "left").join(low, classes["cls"] == low["node"], "left")
    of = of.select(F.col("embedding").alias("value"), (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("low", "rep").alias("component_id"))
    out = v.select("vec_id", F.when(ok, F.col("embedding")).alias("key")).join(of, F.col("key") == F.col("value"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: op1 by all pairs.
SQL = """
with recursive v as (select vec_id, embedding::double[] e from embeddings where embedding is not null
  and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (select x.vec_id a, y.vec_id b from v x join v y on x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.95),
n as (select a vec_id, count(*)::bigint n from links group by a),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a vec_id, min(b) b from reach group by a)
select m.vec_id, coalesce(n.n, 0)::bigint n_links, least(m.vec_id, coalesce(low.b, m.vec_id)) component_id, m.vec_id = least(m.vec_id, coalesce(low.b, m.vec_id)) kept
from embeddings m left join n using (vec_id) left join low using (vec_id)
"""
