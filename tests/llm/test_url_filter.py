"""Operator 9 against its SQL and against a walk through dated changes."""

import random
from datetime import date, timedelta

from conftest import same_rows

from skein.llm import url_filter as u

CAPTURES = "page_id long, url string, fetched date, host string, m int"
CHANGES = "host string, path string, action string, at date, list_id int"
DAY = date(2024, 1, 1)


def test_query_equals_sql(spark, sf_dir, duck):
    same_rows(u.op9(spark, sf_dir), duck.execute(u.SQL))


def test_list_as_it_stood(spark):
    rng = random.Random(4)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "d.org", "xa.com", "com"]
    changes = [(rng.choice(hosts), rng.choice([None, "/", "/p", "/p/q"]), rng.choice(["add", "remove"]), DAY + timedelta(rng.randrange(40)), rng.randrange(2)) for _ in range(120)]
    caps = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/p', '/p/q?x=1', '/z#/p'])}", DAY + timedelta(rng.randrange(45))) for i in range(200)]
    rows = u.judge(spark.createDataFrame([(*c, "old", 1) for c in caps], CAPTURES), spark.createDataFrame(changes, CHANGES)).collect()
    assert len(rows) == 200
    for r in rows:
        h = r.url.split("/")[2]
        p = "/" + r.url.split("#")[0].split("?")[0].split("/", 3)[3] if r.url.count("/") > 2 else "/"
        held = []
        for entry in {(c[0], c[1] or "/", c[4]) for c in changes}:
            past = sorted((c[3], c[2]) for c in changes if (c[0], c[1] or "/", c[4]) == entry and c[3] <= r.fetched)
            if past and past[-1][1] == "add" and (h == entry[0] or h.endswith("." + entry[0])) and p.startswith(entry[1]):
                held.append(entry)
        best = min(held, key=lambda e: (-len(e[0]), -len(e[1]), e[0], e[1], e[2]), default=None)
        assert (r.n_entries, r.blocked, r.host) == (len(held), bool(held), h)
        assert r.rule == (best[0] + best[1] if best else None)


def test_edges(spark):
    caps = [(1, None, DAY), (2, "no url", DAY), (3, "HTTPS://user:pw@A.com.:80/x", DAY), (3, "HTTPS://user:pw@A.com.:80/x", DAY), (4, "http://a.com", None), (5, "http://[::1]:8/x", DAY), (None, "//a.com/x", DAY)]
    df = spark.createDataFrame([(*c, None, 1) for c in caps], CAPTURES)
    changes = spark.createDataFrame([("A.COM.", None, "add", DAY, 1), (None, "/", "add", DAY, 1), ("a.com", "/", "add", None, 1), ("b.com", "/", "drop", DAY, 1), ("a.com", "/", "add", DAY - timedelta(1), 2), ("a.com", "/", "remove", DAY, 2)], CHANGES)
    got = sorted(((r.page_id, r.host, r.n_entries, r.rule) for r in u.judge(df, changes).collect()), key=str)
    assert got == sorted([(1, None, 0, None), (2, None, 0, None), (3, "a.com", 1, "a.com/"), (3, "a.com", 1, "a.com/"), (4, "a.com", 0, None), (5, "[::1]", 0, None), (None, None, 0, None)], key=str)
    assert u.judge(df, changes.limit(0)).filter("blocked").count() == 0 and u.judge(df.limit(0), changes).count() == 0
