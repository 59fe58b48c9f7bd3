"""Token splitting and packing: invariants and small cases."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skein.functions.tokens import count_tokens, measure
from skein.operators.pack import next_fit_pack
from skein.operators.split import split_text, token_split

words = measure("words")
chars = lambda texts: [len(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text("ab \n", max_size=200), st.integers(2, 30), st.integers(0, 10))
def test_chunks_stay_in_budget_and_order(text, size, overlap):
    overlap = min(overlap, size - 1)
    out = split_text(text, size, overlap, chars)
    at = 0
    for c in out:
        assert c and c == c.strip() and len(c) <= size
        at = text.index(c, max(0, at - overlap - 2))
    assert "".join(text.split()) == "" or out
    kept = set("".join(out))
    assert set("".join(text.split())) <= kept | set()


def test_overlap_and_separators():
    assert split_text("aa bb cc dd", 6, 3, chars) == ["aa bb", "bb cc", "cc dd"]
    assert split_text("aa\n\nbb cc", 5, 0, chars) == ["aa", "bb", "cc"]
    assert split_text("abcdefgh", 3, 1, chars) == ["abc", "cde", "efg", "gh"]
    assert split_text("short", 100, 10, words) == ["short"]


def test_columns_are_copied(spark):
    rows = spark.createDataFrame([(1, "a b c d", "x"), (2, None, "y"), (3, "  ", "z")], "k int, content string, other string")
    out = token_split(rows, 3, 0, "words").orderBy("k", "chunk_pos").collect()
    assert [tuple(r) for r in out] == [(1, "a b c", "x", 0), (1, "d", "x", 1)]


def test_long_batches_and_columns_of_all_kinds(spark):
    """Runs of a batch keep their rows' columns, null numbers and nested ones too."""
    texts = [None, "a b c", " ", *["word " * 60_000] * 9, "", "x y z u"]
    rows = [(k if k % 2 else None, t, [k, None], {"s": k}) for k, t in enumerate(texts)]
    out = token_split(spark.createDataFrame(rows, "k long, content string, v array<long>, m map<string, int>").coalesce(1), 50_000, 0, "words")
    got = sorted((r.v[0], r.k, r.m["s"], r.v[1], r.chunk_pos, len(r.content.split())) for r in out.collect())
    want = [(k, k if k % 2 else None, k, None, n, len(c.split())) for k, t in enumerate(texts) if t for n, c in enumerate(split_text(t, 50_000, 0, words))]
    assert got == want and len(want) == 2 + 9 * 2


def bins(spark, counts, budget=10):
    rows = spark.createDataFrame([("f", i, n, "i", str(n)) for i, n in enumerate(counts)], "source_file string, pos long, n long, instruction string, input string")
    out = next_fit_pack(rows, budget).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, len(out) + 1)) and all(r.output == "" for r in out)
    return [[int(x) for x in r.input.split("\n\n")] for r in out]


def test_packing_edges(spark):
    assert bins(spark, [4, 6, 1]) == [[4, 6], [1]]
    assert bins(spark, [11, 1]) == [[11], [1]]
    assert bins(spark, [3, 11, 3]) == [[3], [11], [3]]
    assert bins(spark, [0, 10, 0]) == [[0, 10, 0]]
    assert bins(spark, [6, 5, 4]) == [[6], [5, 4]]
    assert bins(spark, []) == []


def test_instruction_is_the_first_that_is_not_null(spark):
    rows = spark.createDataFrame([("f", 1, 1, None, "a"), ("f", 2, 1, "x", "b"), ("g", 1, 1, None, "c"), ("h", 1, 1, "", "d"), ("h", 2, 1, "y", "e")], "source_file string, pos long, n long, instruction string, input string")
    assert {r.source_file: r.instruction for r in next_fit_pack(rows, 9).collect()} == {"f": "x", "g": None, "h": ""}


def test_counts(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a b\tc",), (None,), ("<|endoftext|>",), ("",)], "t string")
    assert [r[0] for r in rows.select(count_tokens(F.col("t"))).collect()] == [3, None, 1, 0]
    for name in ("bpe50k", "bpe_multi50k"):
        got = [r[0] for r in rows.select(count_tokens(F.col("t"), name)).collect()]
        assert got[1] is None and got[3] == 0 and got[2] > 1


def test_counts_hold_few_texts_at_a_time():
    import tracemalloc

    import pyarrow as pa

    from skein.functions.tokens import counts, encoding, slabs

    texts = pa.array([None, "", *["some words of a text " * 50 + str(i) for i in range(20_000)], "long " * 300_000, None, "é日"])
    runs = list(slabs(texts))
    assert pa.concat_arrays(runs) == texts and all(len(r) == 1 or sum(len(t.encode()) for t in r.to_pylist() if t) <= 1 << 20 for r in runs)
    assert len(runs) < 40 and list(slabs(texts[:0])) == []
    encode = encoding("bpe50k").encode_ordinary
    some = pa.concat_arrays([texts[:40], texts[-4:]])
    assert counts(some, "bpe50k").to_pylist() == [None if t is None else len(encode(t)) for t in some.to_pylist()]
    tracemalloc.start()
    got = counts(texts[:-3], "words")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 20_002 and most < 6_000_000 < texts.nbytes / 3


def plain_split(text, size, overlap, count, separators=("\n\n", "\n", " ", "")):
    """Chunks by the rules, written down once more: recursive cuts, then windows over running lists."""
    sep, rest = next((s, separators[i + 1 :]) for i, s in enumerate(separators) if s == "" or s in text)
    pieces = list(text) if sep == "" else [(sep if i else "") + x for i, x in enumerate(text.split(sep))]
    out, small = [], []

    def windows():
        at = 0
        while at < len(small):
            end = at + 1
            while end < len(small) and sum(n for _, n in small[at : end + 1]) <= size:
                end += 1
            out.append("".join(p for p, _ in small[at:end]).strip())
            if end == len(small):
                break
            while (left := sum(n for _, n in small[at:end])) > overlap or left and left + small[end][1] > size:
                at += 1
        small.clear()

    for p in (p for p in pieces if p):
        n = count([p])[0]
        if n < size:
            small.append((p, n))
            continue
        windows()
        out.extend(plain_split(p, size, overlap, count, rest) if rest else [p])
    windows()
    return [c for c in out if c]


def some_texts(n):
    r = random.Random(3)
    bits = ["a", "bb", "ccc ", " ", "\n", "\n\n", "\t", "é", "日本語", "x　", "\x1c", "word word ", "😀", "\r\n", "."]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 60))) for _ in range(n)] + ["", " \n ", "a\tb" * 40, "word" * 50]


@pytest.mark.parametrize("counter", ["words", "bpe50k", "bpe_multi50k"])
def test_chunks_equal_a_plain_split(spark, counter):
    texts, count = some_texts(250), measure(counter)
    for size, overlap in ((4, 1), (9, 4), (40, 10)):
        rows = spark.createDataFrame(list(enumerate(texts)), "k int, content string")
        got = {k: [] for k in range(len(texts))}
        for x in token_split(rows, size, overlap, counter).orderBy("chunk_pos").collect():
            assert x.chunk_pos == len(got[x.k])
            got[x.k].append(x.content)
        for k, t in enumerate(texts):
            assert got[k] == (plain_split(t, size, overlap, count) if t else []), (t, size)


@pytest.mark.parametrize(("size", "overlap"), [(3, 1), (6, 2), (7, 5), (25, 10)])
def test_chunks_equal_sql(size, overlap):
    import duckdb

    from skein.plans.catalogue import split_sql

    texts, con = some_texts(250), duckdb.connect()
    con.execute("create table t (key int, content varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(texts)))
    rows = con.execute(f"with recursive {split_sql('t', size, overlap)} select key, chunk_pos, content from chunks").fetchall()
    want = [(k, i, c) for k, t in enumerate(texts) for i, c in enumerate(split_text(t, size, overlap, words) if t else [])]
    assert sorted(rows) == want
