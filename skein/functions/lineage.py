"""Cutting a plan: a small or costly table is computed once and kept in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder if all of Spark runs on this machine;
    on a cluster that is an error, since executors and driver don't share local folders."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="skein-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared)
    return shared


def keep(df: DataFrame) -> DataFrame:
    """``df`` computed once; a lost executor costs a re-read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
