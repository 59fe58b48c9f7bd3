"""Operator 7 against a plain reading of the rule."""

import random
import re

import pytest

from skein.llm import line_dedup as l

W = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, gone string, n_lines int"


def run(spark, docs, p=l.Params()):
    df = spark.createDataFrame([(i, t, "g", 7) for i, t in docs], SCHEMA)
    out = l.dedup_lines(df, p)
    assert out.columns == ["doc_id", "text", "gone", "n_lines", "n_deleted"]
    return out.collect()


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_long_lines_and_runs_go_later_and_stay_first(spark):
    long, run3 = words("p", 60), "\n".join(words(f"r{k}_", 20) for k in range(3))
    docs = [(1, f"one\n{long}\nend"), (2, f"{long}\nother"), (3, f"x\n{run3}\ny"), (4, f"{run3}"), (5, f"z\n{run3}\ny\nq"), (6, "one\nend"), (7, long)]
    got = {r.doc_id: (r.text, r.n_deleted) for r in run(spark, docs)}
    assert got == {1: (docs[0][1], 0), 2: ("other", 1), 3: (docs[2][1], 0), 4: ("", 3), 5: ("z\nq", 4), 6: ("one\nend", 0), 7: ("", 1)}


def test_repeats_within_a_document(spark):
    a = words("a", 55)
    got = {r.doc_id: r.text for r in run(spark, [(1, f"{a}\nx\n{a}\n {a} \ny"), (2, "\n".join(["la la", "lo"] * 40))])}
    assert got[1] == f"{a}\nx\ny"
    assert got[2].split("\n")[:2] == ["la la", "lo"] and 2 <= len(got[2].split("\n")) < 12


def test_guarantee_and_whole_first_occurrences(spark):
    """Every repeated run that holds enough is found; what is deleted has an equal line before it; firsts stay."""
    rng, p = random.Random(2), l.Params(min_words=12, max_lines=3, window=2)
    pool = [" ".join(f"k{rng.randint(0, 99)}" for _ in range(rng.randint(0, 14))) for _ in range(60)]
    docs = []
    for i in range(60):
        lines = [f"own{i}_{k} " + words("u", rng.randint(0, 5)) for k in range(rng.randint(0, 4))]
        at = rng.randrange(50)
        docs.append((i, "\n".join(lines[:2] + pool[at : at + rng.randint(1, 9)] + lines[2:])))
    out = {r.doc_id: r for r in run(spark, docs, p)}
    seen, grams = set(), set()
    for i, t in docs:
        lines = t.split("\n")
        kept = out[i].text.split("\n") if out[i].n_deleted < len(lines) else []
        assert len(kept) == len(lines) - out[i].n_deleted
        rest, k = [], 0
        for x in lines:  # kept lines are a subsequence; the others were seen before
            if k < len(kept) and kept[k] == x:
                k += 1
            else:
                rest.append(x.strip())
        assert k == len(kept) and all(x in seen for x in rest)
        for a in range(len(lines) - 4):
            if tuple(lines[a : a + 5]) in grams:  # holds two grams of at most three lines and a neighbour
                assert not any(lines[a : a + 5] == kept[b : b + 5] for b in range(len(kept)))
        grams.update(tuple(lines[a : a + 5]) for a in range(len(lines) - 4))
        seen.update(x.strip() for x in lines)
    assert sum(r.n_deleted for r in out.values()) > 100


@pytest.mark.parametrize("window", [1, 2, 4, 5])
def test_runs_that_hold_one_window(spark, window):
    """160 lines in runs of exactly the limit, each between other neighbours in its two places: all go."""
    docs = [(2 * k + at, "\n".join([f"own{k} {at}", *(words(f"r{k}_{j}_", 13) for j in range(4)), f"end{k} {at}"])) for k in range(40) for at in range(2)]
    assert sum(r.n_deleted for r in run(spark, docs, l.Params(window=window))) == 160


def test_fewer_fingerprints_than_runs(spark):
    rng = random.Random(9)
    text = "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(2000))
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, text)], "doc_id int, text string").select(F.struct("doc_id").alias("row"), "text")
    one, five = (l.fingerprints(docs, l.Params(window=n)) for n in (1, 5))
    n = five.select(F.explode("runs")).distinct().count()
    assert one.count() >= 1990 and one.select(F.explode("runs")).distinct().count() == n
    assert five.count() < 0.45 * n and five.count() < 0.45 * one.count()


def test_runs_of_exactly_the_limit(spark):
    """Runs that hold one gram and no more, between different neighbours, and tails that hold none by themselves."""
    docs = []
    for k in range(40):
        run_ = [words(f"r{k}_{j}_", n) for j, n in enumerate([(20, 20, 20), (26, 26), (1,) * 5, (49, 1), (30, 19, 1)][k % 5])]
        docs += [(2 * k + at, "\n".join([f"own{k} {at}", *run_, f"end{k} {at}"])) for at in range(2)]
    tail = ["\n".join(words(f"t{j}_", n) for j, n in enumerate((30, 30, 5)[:m])) for m in (2, 3)]
    docs += [(100, f"x1\n{tail[0]}\ny1"), (101, f"x2\n{tail[1]}\ny2"), (102, f"x3\n{tail[1]}\ny3")]
    got = {r.doc_id: r.text for r in run(spark, docs)}
    for k in range(40):
        assert got[2 * k] == docs[2 * k][1] and got[2 * k + 1] == f"own{k} 1\nend{k} 1"
    assert got[100] == docs[-3][1] and got[101] == f"x2\n{words('t2_', 5)}\ny2" and got[102] == "x3\ny3"


@pytest.mark.parametrize("window", [1, 2, 3, 4])
@pytest.mark.parametrize(("seed", "min_words", "max_lines"), [(5, 12, 3), (6, 20, 5)])
def test_equals_all_runs(spark, window, seed, min_words, max_lines):
    """What is deleted is every full run that an earlier document has, to the line."""
    rng, p = random.Random(seed), l.Params(min_words=min_words, max_lines=max_lines, window=window)
    pool = [" ".join(f"k{j}_{i}" for i in range(rng.randint(1, 9))) for j in range(40)]
    docs = []
    for i in range(80):
        at = rng.sample(range(36), 2)
        docs.append((i, "\n".join([f"own{i}", *pool[at[0] : at[0] + rng.randint(1, 5)], f"mid{i}", *pool[at[1] : at[1] + rng.randint(1, 5)], f"end{i}"])))
    got, seen = {r.doc_id: r.text for r in run(spark, docs, p)}, set()
    for i, t in docs:
        lines, gone = t.split("\n"), set()
        runs = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) if b - a >= max_lines or len(W.findall(" ".join(lines[a:b]))) >= min_words]
        first = {}
        for a, b in runs:
            key = tuple(lines[a:b])
            if key in seen:
                gone.update(range(a, b))
            elif key in first:
                gone.update(range(max(a, first[key]), b))
            first.setdefault(key, b)
        assert got[i].split("\n") == [x for k, x in enumerate(lines) if k not in gone]
        seen.update(first)


def test_blank_lines(spark):
    """They count for nothing, are passed over in comparing, and go with the run around them."""
    run_ = [words(f"r{j}_", 3) for j in range(5)]
    heads = "own{0}\n\n\nReferences\n \n\nmore{0}\n\n\n\nSee also\n\nend{0}"
    docs = [(k, heads.format(k)) for k in range(3)]
    docs += [(3, "a3\n\n" + "\n\n".join(run_) + "\n\nb3"), (4, "a4\n\n" + "\n\n\n".join(run_) + "\n\nb4"), (5, "\n\n" + "\n".join(run_) + "\n\n")]
    got = {r.doc_id: (r.text, r.n_deleted) for r in run(spark, docs)}
    assert got == {**{k: (t, 0) for k, t in docs[:4]}, 4: ("a4\n\n\nb4", 13), 5: ("", 9)}


def test_edges(spark):
    a = words("a", 60)
    rows = run(spark, [(1, None), (2, ""), (3, "\n\n\n\n\n\n\n"), (4, "\n\n\n\n\n\n\n"), (None, a), (5, a), (6, a), (6, a)])
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in rows), key=str)
    assert got == sorted([(1, None, 0, 0), (2, "", 1, 0), (3, "\n" * 7, 8, 0), (4, "\n" * 7, 8, 0), (None, a, 1, 0), (5, "", 1, 1), (6, "", 1, 1), (6, "", 1, 1)], key=str)
    assert run(spark, []) == []
    long = "\n".join(words(f"l{k}_", 30) for k in range(20_000))
    big = {r.doc_id: r.n_deleted for r in run(spark, [(1, long), (2, "x\n" + long)])}
    assert big == {1: 0, 2: 20_000}


def test_query(spark, sf_dir):
    out = l.op7(spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert not [x for x in out._jdf.queryExecution().executedPlan().toString().split() if "Python" in x or "Pandas" in x]
