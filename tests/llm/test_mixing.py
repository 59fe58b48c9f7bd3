"""Operator 8: targets, quotas, permutations, and the mixture itself."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from skein.llm import mixing as m


def brute_targets(sizes, weights=(3, 1, 2)):
    """By exact fractions: the largest level at which sources filled up to twice their size take 1.5 times all words."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    goal = Fraction(3, 2) * sum(sizes.values())
    for level in sorted({Fraction(2 * sizes[s], w[s]) for s in order}):
        if sum(min(2 * sizes[s], level * w[s]) for s in order) >= goal:
            under = [s for s in order if 2 * sizes[s] >= level * w[s]]
            level = (goal - sum(2 * sizes[s] for s in order if s not in under)) / sum(w[s] for s in under)
            return {s: float(min(2 * sizes[s], level * w[s])) for s in order}
    return {s: 2.0 * sizes[s] for s in order}


def targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()) or [], "source string, words long").repartition(3)
    return {r.source: r.target for r in m.with_targets(m.ranked(df), m.Params()).collect()}


def test_targets(spark):
    assert targets(spark, {"a": 100, "b": 100, "c": 100}) == {"a": 200.0, "b": 250 / 3, "c": 500 / 3}
    assert targets(spark, {}) == {} and targets(spark, {"a": 0}) == {"a": 0.0}
    rng = random.Random(2)
    for n in (2, 7, 40):
        sizes = {chr(rng.choice([97, 0x3b1, 0x1f600, 0xfb00]) + k): rng.choice([0, 3, 10, 1000, 50_000]) for k in range(n)} | {None: 700}
        got, want = targets(spark, sizes), brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_tree_splits_exactly_and_evenly():
    q, room = np.array([1000, 10, 0, 333]), np.diff(np.arange(8) * 1343 // 7)
    out = m.split_tree(q, room, (1,))
    assert (out.sum(axis=0) == q).all() and (out >= 0).all() and (out.sum(axis=1) == room).all()
    mean = sum(m.split_tree(q, room, (s,)) for s in range(200)) / 200
    assert np.abs(mean - q / 7).max() < 3


def test_query(spark, sf_dir):
    rows = m.op8(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    total, taken, target = Counter(), Counter(), {}
    for i, n in size.items():
        total[source[i]] += n
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == total[source[r.doc_id]] and 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert len(rows) == len(docs) and all(abs(target[s] - t) < 1e-6 for s, t in brute_targets(dict(total)).items())
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.03 * target[s] + 20
    again = {r.doc_id: (r.taken, r.shards) for r in m.op8(spark, sf_dir).repartition(3).collect()}
    assert again == {r.doc_id: (r.taken, r.shards) for r in rows}
    assert len({s for r in rows for s in r.shards}) > 1
    other = m.assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), m.Params(seed=9)).collect()
    assert {r.doc_id: r.shards for r in other} != {r.doc_id: r.shards for r in rows}
    assert {r.source: r.target for r in other} == target


def test_many_sources(spark):
    """20,000 sources, in several groups of the tree: each is near its target, and shards hold alike."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("h"), F.col("id") % 20_000).alias("source"), F.expr("repeat('w ', int(id % 7 + 1))").alias("text"))
    out = m.assign(docs, m.Params(group_draws=4_000, fill_docs=1000))
    n, taken, target = out.agg(F.count("*"), F.sum("taken"), F.sum(F.col("target") * F.col("size") / F.col("source_size"))).first()
    assert n == 40_000 and abs(taken - target) < 0.05 * target
    per = [r["count"] for r in out.select(F.explode("shards").alias("s")).groupBy("s").count().collect()]
    assert len(per) == 64 and max(per) < 1.5 * min(per)


def test_mixture_is_what_was_assigned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("r", F.col("lang")).withColumn("m_block", F.col("n_chars")).withColumn("extra", F.create_map(F.lit("a"), F.col("lang")))
    p = m.Params(block_docs=4, shards=9)
    plan = {r.doc_id: r.shards for r in m.assign(docs, p).collect()}
    got, order = defaultdict(list), defaultdict(list)
    out = m.mix(docs, p)
    assert out.columns == [*docs.columns, "m_shard", "m_order"]
    for r in out.collect():
        got[r.doc_id].append(r.m_shard)
        order[r.m_shard].append((r.m_order, r.doc_id))
    assert {i: sorted(v) for i, v in got.items()} == {i: c for i, c in plan.items() if c}
    assert len(order) == 9 and all(v == sorted(v) for v in order.values())  # each shard lies in its order
    ids = [i for _, i in order[0]]
    assert ids != sorted(ids)  # which is a shuffled one


def test_edges(spark):
    rows = [(1, "a b", None), (1, "a b", None), (None, "c", "s"), (2, None, "s"), (3, "", "s"), (4, "x " * 30_000, "t")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, size int")
    out = m.assign(df).collect()
    assert len(out) == 6 and sum(r["size"] for r in out if r.source is None) == 4
    assert all(r.source_size == 4 for r in out if r.source is None) and all(r.taken <= 2 * r["size"] for r in out)
    assert m.mix(df).count() == sum(len(r.shards) for r in out)
    assert m.assign(df.limit(0)).count() == m.mix(df.limit(0)).count() == 0


def test_draws_beyond_numpys_limit():
    rng = np.random.default_rng(1)
    counts = np.array([3 * 10**9, 5, 0, 10**9, 77], np.int64)
    n = int(counts.sum()) // 3
    for _ in range(3):
        got = m.multivariate(rng, counts, n)
        assert got.sum() == n and (got >= 0).all() and (got <= counts).all()
        assert abs(got[0] - counts[0] / 3) < 10 * (counts[0] / 3) ** 0.5
    room = np.array([n, n, int(counts.sum()) - 2 * n])
    out = m.split_tree(counts, room, (8,))
    assert (out.sum(axis=0) == counts).all() and (out.sum(axis=1) == room).all()


def test_inversion_agrees_with_numpy(monkeypatch):
    rng, args = np.random.default_rng(2), (300, 500, 200)
    want = rng.hypergeometric(*args, 20_000)
    monkeypatch.setattr(m, "LARGE", 0)
    got = np.array([m.hypergeometric(rng, *args) for _ in range(20_000)])
    assert abs(got.mean() - want.mean()) < 0.15 and abs(got.std() - want.std()) < 0.12
    for good, bad, n in ((0, 9, 4), (9, 0, 4), (5, 5, 10), (1, 1, 1), (3, 2, 0)):
        k = m.hypergeometric(rng, good, bad, n)
        assert max(0, n - bad) <= k <= min(good, n)
