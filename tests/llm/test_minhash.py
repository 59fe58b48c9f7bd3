"""Operator 5 against all pairs of full sets."""

import random
import re

import numpy as np
import pytest
from conftest import same_rows

from skein.llm import minhash as m

W = re.compile(r"[^\x20\x09-\x0D]+")


def sets(text, n):
    w = W.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(docs, n, percent=80):
    s = [sets(t, n) for _, t in docs]
    comp = [i for i, _ in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != comp[b]
            comp[a] = comp[b] = low
    return {i: (len(x), c) for (i, _), x, c in zip(docs, s, comp)}


def run(spark, docs, p):
    out = m.near_duplicates(spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, key long, n int"), p)
    rows = out.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def near_copies(seed, groups, each, edits):
    """Groups whose members differ from a text of their own by some words; pairs fall on both sides of the threshold."""
    rng, docs = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 160))]
        for _ in range(each):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = f"e{rng.randint(0, 10**6)}"
            docs.append(" ".join(t))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("n", [4, 5])
def test_equals_all_pairs(spark, n):
    docs = near_copies(n, 12, 12, 5)
    docs += [(1000, docs[0][1].upper()), (1001, docs[3][1] + "  "), (1002, "Only three words"), (1003, "ONLY\tthree\nwords"), (1004, ""), (1005, None), (1006, " \n "), (1007, "ÉTÉ a b c"), (1008, "été a b c")]
    assert run(spark, docs, m.Params(words=n, tile=16)) == brute(docs, n)


def test_whole_texts_of_any_length(spark):
    rng = random.Random(1)
    long = [f"w{rng.randint(0, 10**6)}" for _ in range(60_000)]
    other = long[:5000] + [f"v{i}" for i in range(55_000)]
    docs = [(1, " ".join(long)), (2, " ".join(long[:59_000])), (3, " ".join(other)), (4, "x " * 50_000), (5, "x x x x x x")]
    assert run(spark, docs, m.Params(words=4)) == brute(docs, 4)


def test_edges(spark):
    rows = run(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g")], m.Params(words=4))
    assert rows == {1: (4, 1), 2: (4, 1), None: (4, None)}
    assert m.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z"), (3, None, "u")], "doc_id long, text string, rep string")
    assert sorted((r.rep) for r in m.keep_first(docs).collect()) == ["u", "y"]


def test_one_of_each_group_stays(spark):
    a, b, c = "a b c d e f g h", "one two three four five six", "to be or not to be that is"
    rows = [(7, a, "x"), (7, a, "x"), (7, c, "own"), (None, a, "y"), (None, b, "z"), (None, b, "z"), (None, b + " ", "z"), (None, "", "e"), (None, "", "e"), (8, None, "e"), (9, a.upper(), "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string")
    out = m.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(r.h1 for r in out.collect()) == ["e", "e", "e", "own", "x", "z"]
    assert m.keep_first(docs.limit(0)).count() == 0


def test_hot_bucket_of_unlike_documents(spark):
    """20,000 documents in one bucket by their first band, in several tiles: the links of those alike, and nothing else."""
    p, rng, n = m.Params(), np.random.default_rng(3), 20_000
    sigs = rng.integers(0, 1 << 16, (n, p.size), np.uint16)
    sigs[:, : p.rows] = 7
    sigs[1::1000] = sigs[::1000]  # alike in signature; the texts of every other such pair are alike too
    sigs[100:200, p.rows : 2 * p.rows] = 9
    text = [f"{i // 2 if i % 4000 < 2 else i} b c d e f" for i in range(n)]
    reps = spark.createDataFrame([(i, 2, s.tobytes()) for i, s in enumerate(sigs)], "doc_id long, n_shingles long, sig binary").repartition(8)
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    shared = m.bands_of(reps, p)
    buckets = shared.join(shared.groupBy("key").count().filter("count > 1"), "key").select("key", "doc_id")
    none = spark.createDataFrame([], "node long, component long")
    assert sorted(map(tuple, m.cross_links(buckets, docs, reps, none, p).collect())) == [(i, i + 1) for i in range(0, n, 4000)]
    joined, few = spark.createDataFrame([(1, 0)], "node long, component long"), "doc_id < 50"
    assert m.cross_links(buckets.filter(few), docs, reps.filter(few), joined, p).count() == 0


def test_group_below_the_threshold_without_its_source(spark):
    """Many texts, each alike to few others: the components of all pairs, from tiles of any size."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(100)]
    docs = []
    for i in range(150):
        t = list(base)
        for k in range(3):
            t[rng.randrange(100)] = f"e{rng.randint(0, 3)}"
        docs.append((i, " ".join(t)))
    for p in (m.Params(words=4), m.Params(words=4, tile=32), m.Params(words=4, tile_shingles=500)):
        assert run(spark, docs, p) == brute(docs, 4)


def test_both_ways_of_finding_texts(spark):
    """Few ids are broadcast, many are met by a shuffle: the same rows."""
    from skein.llm.common import only

    rows, ids = spark.range(1000).withColumnRenamed("id", "doc_id"), spark.createDataFrame([(5,), (5,), (900,), (None,)], "doc_id long")
    for limit in (100, 1):
        assert sorted(r.doc_id for r in only(rows, ids, "doc_id", limit).collect()) == [5, 900]


def test_estimates_and_bounds():
    p, rng = m.Params(), np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 4000, np.uint64)
    for share in (0.5, 0.8, 0.9):
        k = int(2 * 2000 * share / (1 + share))
        x, y = m.signature(a[:2000], p), m.signature(np.concatenate([a[:k], a[2000 : 4000 - k]]), p)
        assert abs((x == y).mean() - share) < 0.12
    assert list(m.least_matches(p)) == sorted(m.least_matches(p))
    t, n = p.percent / 100, p.size
    sample = rng.binomial(n, t, 200_000)
    assert (sample < m.least_matches(p)[-1]).mean() < 20 * p.miss
    assert len(np.unique(m.band_keys(x, p))) == p.bands


def test_query_equals_sql(spark, sf_dir, duck):
    out = m.op5(spark, sf_dir)
    assert out.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    same_rows(out, duck.execute(m.SQL))
