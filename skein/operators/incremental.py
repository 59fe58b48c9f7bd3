"""Skipping inputs that are done already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import stem


def skip_existing(inputs: DataFrame, done: DataFrame, skip: bool = True) -> DataFrame:
    """``inputs`` (with source_file) whose stem isn't among ``done`` (stem)."""
    if not skip:
        return inputs
    return inputs.join(done.select(F.col("stem").alias("_stem")), stem(F.col("source_file")) == F.col("_stem"), "left_anti")
