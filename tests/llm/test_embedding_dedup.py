"""Operator 1 against all pairs, and its edges."""

import numpy as np
from conftest import same_rows

from skein.llm import embedding_dedup as e

SCHEMA = "vec_id long, embedding array<float>, copies int, node long"


def brute(ids, vectors, cosine=0.95):
    """n_links and component of each vector by all pairs."""
    x = e.unit([list(v) for v in vectors])
    hit = (x @ x.T >= cosine) & ~np.eye(len(x), dtype=bool)
    comp = np.array(ids)
    while True:
        low = np.minimum(comp, np.where(hit, comp[None, :], comp.max()).min(axis=1))
        if (low == comp).all():
            return hit.sum(axis=1), comp
        comp = low


def test_links_and_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    near = np.concatenate([base, base[:40] + rng.normal(scale=0.07, size=(40, 16)), np.repeat(base[:1], 60, 0) + rng.normal(scale=0.04, size=(60, 16)), base[5:9]])
    ids = (rng.permutation(len(near)) * 3).tolist()
    near = near.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1, 2) for i, v in zip(ids, near)], SCHEMA)
    got = {r.vec_id: r for r in e.near_duplicates(df, e.Params(block=32)).collect()}
    n, comp = brute(ids, near.astype(np.float64))
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.98 * n.sum() and all(got[i].n_links <= k for i, k in zip(ids, n))
    assert np.mean([got[i].component_id == c for i, c in zip(ids, comp)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e30, 1e-30])]
    got = e.near_duplicates(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    for i in (1, 2, 3, 12):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (4, 1, i == 1)
    for i in (4, 5, 6, 7, 8, 9, 10, 11):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert (by[None].n_links, by[None].component_id, by[None].kept) == (0, None, True)
    assert e.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_of_one_id_with_other_vectors(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (7, [2.0, 0.0])]
    got = e.near_duplicates(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False)]


def test_many_lengths_in_one_plan(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for d in range(2, 42):
        ids = [1000 - 10 * d + i for i in range(6)]
        x = rng.normal(size=(6, d))
        x[3:] = x[:3] * 2 + 0.01 * rng.normal(size=(3, d))
        n, comp = brute(ids, x)
        rows += [(i, v.tolist()) for i, v in zip(ids, x)]
        want.update({i: (int(a), int(b)) for i, a, b in zip(ids, n, comp)})
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in e.near_duplicates(df).collect()} == want


def test_query_equals_sql(spark, sf_dir, duck):
    out = e.op1(spark, sf_dir)
    assert out.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    same_rows(out, duck.execute(e.SQL))


def test_components_of_a_long_path_and_a_star(spark):
    from skein.llm.components import components

    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
