"""Folders that fill up over time, as streams that take what is new and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from skein.operators import parse, records, split
from skein.operators.sections import section_rows
from skein.plans.prepare import merge_records
from skein.schemas import Config
from skein.sources.files import file_name, numbered, refuse_hidden


def follow_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the lines of new ``*.jsonl`` files, with their file's name. Names that Spark skips are refused when the
    stream starts; a line that isn't UTF-8 fails it."""
    refuse_hidden(spark, folder, ".jsonl")
    rows = spark.readStream.option("pathGlobFilter", "*.jsonl").text(folder)
    return rows.select(F.validate_utf8("value").alias("value"), file_name(), F.col("_metadata.file_block_start").alias("block"))


def follow_records(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the good records of files that have come since the last run; bad lines are dropped."""
    rows = parse.records(follow_lines(spark, folder)).drop("block")
    return rows.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_sections(sections: DataFrame, out: str, checkpoint: str, c: Config = Config()) -> StreamingQuery:
    """Split a stream of sections into chunks and append those that pass the filters; each row stands for itself."""
    saved = records.verdicts(split.token_split(sections, c.max_tokens, c.overlap, c.counter), c).filter("verdict = 'saved'")
    return saved.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_documents(spark: SparkSession, folder: str, out: str, checkpoint: str, c: Config = Config()) -> StreamingQuery:
    """Markdown files that have come since the last run to their saved chunks, appended: sections, split, filters."""
    refuse_hidden(spark, folder, ".md")
    docs = spark.readStream.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    docs = docs.select(file_name(), F.col("value").alias("md"))
    return follow_sections(section_rows(docs), out, checkpoint, c)


def follow_packing(spark: SparkSession, folder: str, out: str, checkpoint: str, c: Config = Config()) -> StreamingQuery:
    """Pack the files of each batch; a file must have come as a whole, since packing runs through it in order."""

    def pack(batch: DataFrame, n: int) -> None:
        lines = numbered(batch.withColumn("at", F.monotonically_increasing_id())).drop("block", "at")
        merge_records(lines, c).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return follow_lines(spark, folder).writeStream.foreachBatch(pack).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
