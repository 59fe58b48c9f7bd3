"""The pipeline: each stage's decisions take effect on all that the one before kept."""

import corpus_pipeline as c
from skein.llm import line_dedup, minhash, mixing, packing, quality_classifier
from pyspark.sql import functions as F


def test_stages_in_turn(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, names = {}, docs.columns
    for k, (name, stage) in enumerate(c.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == names
        kept[k] = (before, docs)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = kept[0]
    good = quality_classifier.classify(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("predicted = 1")
    assert ids(after) == ids(good) and 0 < after.count() < before.count()
    before, after = kept[1]
    want = {r.doc_id: r.text for r in line_dedup.dedup_lines(before).collect()}
    got = {r.doc_id: r for r in after.collect()}
    assert all(r.text == want[i] and r.n_chars == len(r.text) for i, r in got.items()) and all(not want[i].strip() for i in set(want) - set(got))
    before, after = kept[2]
    assert ids(after) == ids(minhash.near_duplicates(before, minhash.Params(words=4)).filter("kept"))
    before, after = kept[3]
    plan = mixing.assign(before).select("doc_id", F.explode("shards"))
    assert ids(after) == ids(plan)
    before, after = kept[4]
    assert sorted(set(ids(after))) == sorted(set(ids(before)))
    assert sum(r.piece == 0 for r in after.collect()) == before.count()
    run = c.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32", "length")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, after.select("doc_id", "piece", "ids_crc32", "length").collect()))
    assert packing.word_bpe() and [n for n, _ in c.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing to target weights", "best-fit packing"]


def test_rows_without_text_pass(spark, sf_dir, tmp_path):
    docs = spark.createDataFrame([(1, None, "en", "s", None), (2, "", "en", None, 0), (None, "a b c", None, "s", 5), (3, "the and of " * 30, "en", "s", 330)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in c.STAGES[1:]:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0


NAMES = "doc_id long, text string, lang string, source string, n_chars long, score string, Predicted int, n_lines string, m_shard string, M_ORDER int, `a.b` string, m_shard_0 int"


def clashing(spark, rows):
    return spark.createDataFrame([(*r, "sc", 1, "nl", f"sh{r[0]}", 4, "dot", 9) for r in rows], NAMES)


def good_rows():
    text = "the quick brown fox of house number {0} runs over field {0} and back to town {0} before evening {0} comes"
    return [(i, text.format(i * 7919), "en", f"s{i % 3}", 100) for i in range(30)]


def test_clashing_columns_pass(spark, sf_dir):
    rows = [*good_rows(), (None, None, None, None, None), (98, "", "en", None, 0)]
    docs = before = clashing(spark, rows)
    for name, stage in c.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        assert docs.dtypes == before.dtypes, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    out = docs.collect()
    assert out and all((r.score, r.Predicted, r.n_lines, r.M_ORDER, r["a.b"], r.m_shard_0) == ("sc", 1, "nl", 4, "dot", 9) and r.m_shard == f"sh{r.doc_id}" for r in out)


def test_empty_tables(spark, sf_dir):
    docs = clashing(spark, [])
    for _, stage in c.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_repeated_rows_ties_and_a_hot_source(spark, sf_dir):
    """Copies of one text under one source: one row is left of them before mixing, and the mixture takes no more than twice."""
    rows = [(1, good_rows()[0][1], "en", "hot", 100)] * 60 + [(i, good_rows()[0][1], "en", "hot", 100) for i in range(2, 40)] + good_rows()[5:]
    docs = clashing(spark, rows)
    for _, stage in c.STAGES[1:3]:
        docs = stage(spark, docs, sf_dir)
    left = docs.collect()
    assert sorted(r.doc_id for r in left) == [1, *range(5, 30)] or sum(r.source == "hot" for r in left) == 1
    mixed = c.STAGES[3][1](spark, docs, sf_dir).groupBy("doc_id").count().collect()
    assert mixed and max(r["count"] for r in mixed) <= 2
