"""The divergence audit against plain Python, tries against dicts, and the query against SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import same_rows

from skein.llm import divergence as dv
from skein.llm.divergence import Params, Trie, audit, op12

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "lang string, source string, text string, rank int, value string"


def brute(rows, p):
    rows = [tuple(x or "" for x in r[:3]) for r in rows]
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = Counter("".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text))
        count[lang, source].update(found)
        docs[lang].update(found.keys())
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= p.min_docs]
        whole = Counter()
        for (l, _), c in count.items():
            if l == lang:
                whole.update(c)

        def shares(c):
            total = sum(c[t] for t in kept) + p.prior * len(kept)
            return {t: 1 + p.unit * (c[t] + p.prior) // total for t in kept}

        q, of = shares(whole), {s: shares(c) for (l, s), c in count.items() if l == lang}
        for s, mine in of.items():
            pair = sorted((-sum(abs(mine[t] - other[t]) for t in kept), o.encode(), o) for o, other in of.items() if o != s)
            term = sorted((q[t] - mine[t], t.encode(), t) for t in kept if count[lang, s][t] and mine[t] > q[t])[: p.top]
            out += [(lang, s, "pair", i, -v, k + 1) for k, (v, _, i) in enumerate(pair)] + [(lang, s, "term", i, -v, k + 1) for k, (v, _, i) in enumerate(term)]
    return sorted(out)


def audited(spark, rows, p):
    out = audit(spark.createDataFrame(rows, SCHEMA), p).select("lang", "source", "part", "item", "value", "rank")
    return sorted(map(tuple, out.collect()))


def some(seed, n=250):
    r = random.Random(seed)
    words = ["".join(r.choice("abB") for _ in range(r.randint(1, 4))) for _ in range(40)] + ["é", "日本", "日本語", "ß", "\x80", "ab́"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", "\n", "-", "1", "_", "\x7f"]) for _ in range(r.randint(0, 30)))
    return [(r.choice(["en", "de", "", None]), r.choice(["s1", "s1", "s1", "s2", "s3", "é", "", None, "Z"]), r.choice([text(), text(), text(), "", None]), 1, "v") for _ in range(n)]


@pytest.mark.parametrize("p", [Params(min_docs=3), Params(min_docs=3, held=50, fold=40, prefix=1, chunk=4, sources=2, top=5, slab=16), Params(min_docs=10, prefix=2, sources=1, chunk=1)])
def test_equals_plain_counts(spark, p):
    rows = some(1)
    assert audited(spark, rows, p) == brute(rows, p) != []


def test_edges(spark):
    p = Params(min_docs=2)
    assert audited(spark, [], p) == []
    for rows in (
        [("en", "a", None, 1, ""), ("en", "b", "", 1, "")],  # no terms
        [("en", "a", "once", 1, ""), ("en", "b", "other", 1, "")],  # no kept terms
        [("en", "a", "x y", 1, "")] * 5,  # one source, repeated rows
        [("en", "a", "tie tee", 1, "")] * 3 + [("en", "b", "zz", 1, "")] * 3 + [("en", None, "zz", 1, "")],
        [("en", "a", "w" * 100_000 + " " + "v " * 50_000, 1, "")] * 2,
    ):
        assert audited(spark, rows, p) == brute(rows, p)


def test_trie_is_a_sorted_dict():
    r = random.Random(3)
    trie, want = Trie(), {}
    for _ in range(4000):
        k = bytes(r.choice(b"ab\xc3\xa9") for _ in range(r.randint(1, 7)))
        assert trie.leaf(k) == want.setdefault(k, len(want))
    assert list(trie.walk()) == sorted(want.items()) and trie.size == len(want)


def test_subtries_hold_the_counts():
    out = dv.Counts()
    out.add(7, [(1, [b"abc", b"abd", b"abc"], None), (2, [b"abc"], None), (1, [b"b", b"abc"], [5, 2])])
    out.add(7, [(1, [b"b"], None)])
    (batch,) = out.sent(2)
    rows = [{k: v for k, v in r.items() if k != "lang_id"} for r in batch.to_pylist()]
    assert rows == [
        {"prefix": b"ab", "terms": [b"c", b"d"], "sizes": [2, 1], "source_ids": [1, 2, 1], "times": [4, 1, 1], "docs": [2, 1, 1]},
        {"prefix": b"b", "terms": [b""], "sizes": [1], "source_ids": [1], "times": [6], "docs": [2]},
    ]


def test_chunks_are_even_whatever_the_tasks(spark):
    p = Params(chunk=16)
    # language 1: 3 terms of two sources in each of 40 parts; language 2: 33 terms in one part
    rows = [(1, part, nth, f"{part:02}{nth}", s, 1, 2) for part in range(2, 42) for nth in range(3) for s in (5, 6)]
    rows += [(2, 7, nth, f"{nth:02}", 5, 1, 1) for nth in range(33)]
    kept = spark.createDataFrame(rows, dv.KEPT)
    out = dv.numbered(kept, dv.spans(kept, p)).collect()
    for lang, sizes in ((1, [15] * 8), (2, [11] * 3)):
        own = {(r.nth, r.term): r.chunk for r in out if r.lang_id == lang}
        assert [n for n, _ in sorted(own)] == list(range(len(own)))
        assert [t for _, t in sorted(own)] == sorted(t for _, t in own)
        assert [list(own.values()).count(k) for k in range(max(own.values()) + 1)] == sizes
    assert len(out) == len(rows)


def test_many_tasks(spark):
    p = Params(min_docs=3, chunk=16, sources=4, prefix=2, top=5)
    rows = some(2, 400)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("40", "false")):
            spark.conf.set(k, v)
        assert audited(spark, rows, p) == brute(rows, p) != []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_shares_are_exact():
    import numpy as np

    p, r = Params(), random.Random(4)
    for _ in range(300):
        total = r.randint(1, 10 ** r.randint(1, 15))
        n = r.randint(0, total)
        assert dv.share(np.array([n]), np.array([total]), p)[0] == 1 + p.unit * n // total


def test_query(spark, sf_dir, duck):
    same_rows(op12(spark, sf_dir), duck.execute(dv.SQL))
