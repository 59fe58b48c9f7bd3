"""Shared helpers: scratch space, checkpoints, word splitting."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space and U+0009-U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """The folder the cluster shares (``spark.checkpoint.dir``). Where that is unset, a temporary one if all of Spark runs
    on this machine; on a cluster that is an error, since executors and driver don't share local folders."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="skein-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so a lost executor costs a re-read, not a re-run."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


_GAP = re.compile(rb"[\x20\x09-\x0D]")


def stretches(text: str | None, size: int = 1 << 20) -> Iterator[bytes]:
    """A text's bytes, cut between words into pieces of about ``size``, so that no list of all words of a very long text
    is made. ``bytes.split()`` knows exactly the separators of ``SPACE``."""
    raw, at = (text or "").encode("utf-8", "surrogatepass"), 0
    while at < len(raw):
        m = _GAP.search(raw, at + size) if at + size < len(raw) else None
        end = m.start() if m else len(raw)
        yield raw[at:end]
        at = end


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def boxed(df: DataFrame, *but: str) -> Column:
    """All columns of ``df`` but some, as one struct: so no helper column can clash with them."""
    low = {b.lower() for b in but}
    return F.struct(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in low))


#: Ids up to this number are broadcast (some 20 MB in Spark's memory); more are joined by a shuffle.
BROADCAST_IDS = 250_000


def only(rows: DataFrame, ids: DataFrame, column: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """The rows whose id is among ``ids`` (one column of that name, counted first). Few ids go to the rows, so that
    whole texts aren't shuffled to find some of them; many are met by a shuffle."""
    ids = ids.select(column).distinct()
    return rows.join(F.broadcast(ids) if ids.count() <= limit else ids, column, "left_semi")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
