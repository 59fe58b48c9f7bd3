"""JSON-lines writers. A job's commit makes its output appear as a whole, so a crash leaves nothing that looks done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.sources import named


def json_line(*columns: str) -> Column:
    """The columns as a JSON object in this order, nulls kept, characters as they are."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_per_source(records: DataFrame, folder: str, by: str = "source_file", order: str = "id", mode: str = "overwrite") -> None:
    """A folder for each source, ``<by>=<name>``, of lines in order. ``overwrite`` replaces all that was there, ``dynamic``
    the sources that are written."""
    names = [c for c in records.columns if c != by]
    rows = records.repartition(by).sortWithinPartitions(by, order).select(by, json_line(*names).alias("value"))
    one = mode == "dynamic"
    rows.write.mode("overwrite" if one else mode).option("partitionOverwriteMode", "dynamic" if one else "static").partitionBy(by).text(folder)


def write_single(records: DataFrame, path: str, order: str) -> None:
    """The file ``path``, its lines in order. All rows pass one task: for sets that one trainer reads from one file.
    ``write_ordered`` has no such limit."""
    folder, _, name = path.rpartition("/")
    names = [c for c in records.columns if c != order]
    rows = records.select(F.lit(name).alias("name"), F.lit(None).cast("string").alias("verdict"), json_line(*names).alias("value"), order)
    empty = records.sparkSession.range(1).select(F.lit(name).alias("name"), F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("value"), F.lit(None).cast(records.schema[order].dataType).alias(order))
    named.write(rows.unionByName(empty), folder or ".", order)


def write_ordered(records: DataFrame, path: str, order: str, mode: str = "overwrite") -> None:
    """Files whose names follow the order, each a range of it."""
    names = [c for c in records.columns if c != order]
    records.repartitionByRange(order).sortWithinPartitions(order).select(json_line(*names).alias("value")).write.mode(mode).text(path)
