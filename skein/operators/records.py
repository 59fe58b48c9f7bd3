"""Filters on chunks and the training records made of what they leave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import breadcrumb, is_toc, prefixed
from skein.functions.tokens import count_tokens
from skein.schemas import Config


def min_chars(content: Column, least: int = 800) -> Column:
    return F.length(content) >= least


def verdicts(chunks: DataFrame, c: Config = Config()) -> DataFrame:
    """``chunks`` with ``input`` (headers before the content) and ``verdict``: saved, short, toc or small.

    The order is that of the tests: a chunk's own length, then the table-of-contents markers in the whole input, then
    the length of the whole input."""
    out = chunks.withColumn("input", prefixed(breadcrumb(F.col("h1"), F.col("h2"), F.col("h3")), F.col("content"), c.prefix))
    verdict = F.when(~min_chars(F.col("content"), c.min_characters), "short").when(is_toc(F.col("input"), c.toc_markers), "toc").when(F.length("input") < c.min_input, "small")
    return out.withColumn("verdict", verdict.otherwise("saved"))


def sequential_ids(rows: DataFrame, file: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with id from 1 within a file, in order."""
    return rows.withColumn("id", F.row_number().over(Window.partitionBy(file).orderBy(*order)).cast("long"))


def training_records(judged: DataFrame, order: Sequence[str], c: Config = Config()) -> DataFrame:
    """source_file, id, instruction, input and an empty output, for each saved row of ``verdicts``."""
    saved = sequential_ids(judged.filter("verdict = 'saved'"), "source_file", order)
    return saved.select("source_file", "id", F.lit(c.instruction).alias("instruction"), "input", F.lit("").alias("output"))


def with_tokens(rows: DataFrame, budget: int = 6000, counter: str = "words") -> DataFrame:
    """``rows`` with n_tokens of the whole input and over_budget: the headers put before a chunk may take it over the budget
    that it was cut by. A null input has null for both."""
    return rows.withColumn("n_tokens", count_tokens(F.col("input"), counter)).withColumn("over_budget", F.col("n_tokens") > budget)


def run_report(judged: DataFrame) -> DataFrame:
    """Per file: all chunks, saved ones, and those dropped by each reason."""
    n = lambda v: F.count_if(F.col("verdict") == v)
    return judged.groupBy("source_file").agg(F.count("*").alias("n_chunks"), n("saved").alias("n_saved"), n("short").alias("n_short"), n("toc").alias("n_toc"), n("small").alias("n_small"))
