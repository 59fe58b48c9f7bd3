"""The final set: projection, union, seeded shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.schemas import FINAL


def project(rows: DataFrame) -> DataFrame:
    return rows.select(*FINAL)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def shuffle_key(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def hash_shuffle(rows: DataFrame, *keys: str, seed: int = 42) -> DataFrame:
    """``rows`` with ``pos``, a place from 1 in an order set by the seed and the keys alone, whatever the partitions.

    Places are numbered in 4096 ranges of the hash, each with the offset of the ranges before it, so that no task has
    the whole table."""
    marked = rows.withColumn("_key", shuffle_key(seed, *(F.col(k) for k in keys))).withColumn("_range", F.substring("_key", 1, 3))
    counts = marked.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over 4096 rows at most
    offsets = counts.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_key", *keys))
    out = marked.withColumn("_at", within).join(F.broadcast(offsets), "_range")
    return out.withColumn("pos", F.col("_offset") + F.col("_at")).drop("_key", "_range", "_offset", "_at")


def first_row(rows: DataFrame, order: str = "pos") -> DataFrame:
    return rows.orderBy(order).limit(1)
