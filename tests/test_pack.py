"""Next-fit packing by blocks, against a plain fold."""

import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skein.operators import pack
from skein.operators.pack import next_fit_pack, placed, summary

SCHEMA = "source_file string, pos long, n long, instruction string, input string"


def fold(counts, budget, separator=0):
    out, held, n = [], 0, 1
    for k, x in enumerate(counts):
        if k and held + separator + x > budget:
            held, n = x, n + 1
        else:
            held += x + (separator if k else 0)
        out.append(n)
    return out


counts = st.lists(st.integers(0, 9), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(counts, st.integers(1, 12), st.integers(1, 7))
def test_blocks_chain_like_a_fold(n, budget, size):
    want, held, bin_, got = fold(n, budget), None, 1, []
    parts = [np.array(n[i : i + size]) for i in range(0, len(n), size)]
    for b in parts:
        got += pack.bins(b, budget, held, bin_).tolist()
        s = summary(b, budget)
        held, more = s.fresh if held is None else s(held, budget)
        bin_ += more
    assert got == want and bin_ == want[-1]


@settings(max_examples=300, deadline=None)
@given(counts, counts, counts, st.integers(1, 12), st.integers(0, 15))
def test_summaries_compose(a, b, c, budget, held):
    one = summary(np.array(a + b + c), budget)
    both = summary(np.array(a), budget).then(summary(np.array(b), budget), budget).then(summary(np.array(c), budget), budget)
    assert both(held, budget) == one(held, budget) and both.fresh == one.fresh
    assert len(both.reach) <= 2 * budget + 4


def test_many_levels_and_files(spark):
    r = np.random.default_rng(1)
    files = {f: r.integers(0, 9, n).tolist() for f, n in (("a", 200), ("b", 1), ("c", 61), (None, 90), ("", 33))}
    rows = spark.createDataFrame([(f, 5 + 3 * i, x, None, "") for f, n in files.items() for i, x in enumerate(n)], SCHEMA)
    for block, fan in ((2, 2), (13, 8)):
        got = {}
        for x in placed(rows, 20, block, fan).orderBy("pos").collect():
            got.setdefault(x.source_file, []).append(x.bin)
        assert got == {f: fold(n, 20) for f, n in files.items()}


def packed(spark, n, budget, separator=0):
    rows = spark.createDataFrame([("f", i, x, "i", str(i)) for i, x in enumerate(n)], SCHEMA)
    return next_fit_pack(rows, budget, separator_tokens=separator).orderBy("id").collect()


def test_separators_are_charged_from_the_second_part_on(spark):
    out = packed(spark, [4, 4], 10, 2)
    assert [(x.input, x.n_tokens, x.n_parts) for x in out] == [("0\n\n1", 10, 2)]
    out = packed(spark, [4, 5, 12, 0, 3, 3], 10, 2)
    assert [(x.input, x.n_tokens) for x in out] == [("0", 4), ("1", 5), ("2", 12), ("3\n\n4\n\n5", 10)]
    r = np.random.default_rng(2).integers(0, 7, 300).tolist()
    out = packed(spark, r, 15, 3)
    assert [x.id for x in out for _ in range(x.n_parts)] == fold(r, 15, 3)


def test_nulls_and_other_columns(spark):
    rows = spark.createDataFrame([(None, 1, 4, None, "a"), (None, 2, None, "x", None), (None, 3, 7, "y", "c")], SCHEMA)
    out = next_fit_pack(rows, 10).orderBy("id").collect()
    assert [tuple(x) for x in out] == [(None, 1, "x", "a", "", 4, 2), (None, 2, "x", "c", "", 7, 1)]
    assert next_fit_pack(rows.limit(0)).count() == 0


def test_one_file_goes_to_many_tasks_in_linear_time(spark):
    from pyspark.sql import functions as F

    def run(n):
        rows = spark.range(n).select(F.lit("f").alias("source_file"), F.col("id").alias("pos"), (F.col("id") * 7919 % 900).alias("n"))
        began = time.perf_counter()
        out = placed(rows, 6000).agg(F.max("bin"), F.count("*")).first()
        return time.perf_counter() - began, out

    run(1000)
    small, large = run(250_000), run(2_000_000)
    assert large[1][1] == 2_000_000 and abs(large[1][0] - 8 * small[1][0]) < 20
    assert large[0] < 8 * max(small[0], 3)
