"""Operator 2: held-out accuracy, whole texts, edges."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from skein.llm import quality_classifier as q


def test_accuracy_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    rows = q.op2(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]).all()
    out = rows[rows["held_out"]]
    assert len(out) > 50 and (out["predicted"] == out["quality"]).mean() > 0.93
    assert (rows["predicted"] == (rows["score"] >= 0.7)).all() and rows["score"].between(0, 1).all()


def test_score_is_the_model_on_the_whole_text(spark):
    p = q.Params(buckets=1 << 10, dim=4, steps=200)
    rng = np.random.default_rng(0)
    text = lambda c: " ".join(rng.choice(["alpha", "beta", "gamma"] if c else ["x$$$", "y###", "WOW!!"], 30))
    rows = [(i, text(i % 2), i % 2) for i in range(60)] + [(100, ("alpha " * 5000) + "y### " * 30000, 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(p.seed)).alias("h")).collect()}
    got = {r.doc_id: r.score for r in q.classify(docs, labels, p).collect()}
    chosen = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda r: order[r[0]])
    vectors, layer, bias = (x.astype(np.float64) for x in q.fit([t for _, t, _ in chosen], np.array([c for *_, c in chosen]), p))

    def mixed(x):
        x &= 0xFFFFFFFF
        return (x ^ x >> 15) * 0x85EBCA6B & 0xFFFFFFFF

    def bucket(gram):  # of a character n-gram, from its definition
        h = ord(gram[0])
        for c in gram[1:]:
            h = h * 0x9E3779B1 + ord(c) & 0xFFFFFFFF
        x = mixed(h ^ len(gram))
        return (x ^ x >> 13) % p.buckets

    for i, t, _ in rows:
        ws, at = t.split(), []
        for w in ws:
            m = f"<{w}>"
            at += [zlib.crc32(w.encode()) % p.buckets] + [bucket(m[k : k + n]) for n in (2, 3, 4) for k in range(len(m) - n + 1)]
        for v, w in zip(ws, ws[1:]):
            x = mixed(zlib.crc32(v.encode()) * 0x9E3779B1 + zlib.crc32(w.encode()))
            at.append(p.buckets + (x ^ x >> 13) % p.buckets)
        z = layer @ vectors[at].mean(axis=0) + bias
        assert abs(got[i] - 1 / (1 + np.exp(z[0] - z[1]))) < 1e-6
    assert got[100] < 0.5 < got[1]


def test_long_words_have_all_their_ngrams():
    p = q.Params()
    place, at = q.features([b"abcdefghij" * 50, b"a"], p)
    assert (place == 0).sum() == 1 + 501 + 500 + 499 and (place == 1).sum() == 1 + 2 + 1
    alone = q.features([b"a"], p)[1]
    assert sorted(at[place == 1]) == sorted(alone)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "k", 9), (2, "", "k", 9), (None, "a b", "k", 9), (3, "a b", "k", 9), (3, "a b", "k", 9)], "doc_id long, text string, score string, quality int")
    labels = spark.createDataFrame([(1, 1, 2), (3, None, 2), (3, 7, 2), (None, 1, 2)], "doc_id long, quality int, text int")
    out = q.classify(docs, labels, q.Params(steps=50))
    rows = out.collect()
    assert len(rows) == 5 and out.columns == ["doc_id", "text", "quality", "score", "held_out", "predicted"]
    assert len({r.score for r in rows if not r.text}) == 1 and all(0 <= r.score <= 1 for r in rows)
    none = q.classify(docs, labels.limit(0), q.Params(steps=50)).collect()
    assert {r.score for r in none} == {0.5}
    assert q.classify(docs.limit(0), labels).count() == 0


def test_the_sample_is_of_labelled_documents(spark):
    """Labels without a document use up none of it, and characters are bounded too."""
    rows = [(i, "good words here " * 5 if i % 2 else "$$$ ### !!! " * 5) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(i, 0) for i in range(1000, 6000)], "doc_id long, quality int")
    score = {r.doc_id: r.score for r in q.classify(docs, labels, q.Params(max_train=8, steps=4000)).collect()}
    assert len({round(x, 9) for x in score.values()}) > 1 and np.mean([score[i] for i in range(1, 60, 2)]) > np.mean([score[i] for i in range(0, 60, 2)])
    none = q.classify(docs, labels, q.Params(max_chars=10, steps=50)).collect()
    assert {r.score for r in none} == {0.5}


def test_one_huge_text_is_left_out_of_the_sample_alone(spark):
    rows = [(i, ("good calm words here " if i % 2 else "bad junk spam noise ") * 5, i % 2) for i in range(40)]
    huge = [(1000 + i, "x " * 60_000, 1) for i in range(3)]
    both = rows + huge
    docs = spark.createDataFrame([(i, t) for i, t, _ in both], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in both], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in q.classify(docs, labels, q.Params(max_chars=20_000, steps=2000)).collect()}
    assert all((got[i] > 0.5) == bool(y) for i, _, y in rows)
