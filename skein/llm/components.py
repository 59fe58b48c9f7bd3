"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import cut


#: Nodes that a task holds at once.
NODES = 1_000_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one partition -> a star for each tree of them: same components, no more rows than nodes."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    def stars() -> pd.DataFrame:
        rows = [(x, root(x)) for x in list(up) if root(x) != x]
        return pd.DataFrame(rows, columns=["u", "v"]).astype("int64")

    for b in batches:
        for x, y in zip(b["u"].tolist(), b["v"].tolist()):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if len(up) > NODES:
            yield stars()
            up.clear()
    yield stars()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) links of longs that isn't its component's smallest; null ends and
    loops are passed over. A step is shuffles by node with minima taken before them; steps are few, as paths halve."""
    a, b = links.columns
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")
    e = cut(e.mapInPandas(_forest, "u long, v long").distinct())
    before = None
    while True:
        # by contents, so that equal tables are known as such in any order
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        hooked = large.join(least, F.col("u") == F.col("k")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(least.select(F.col("k").alias("u"), F.col("m").alias("v")).unionByName(hooked).distinct())
