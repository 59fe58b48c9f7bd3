"""The corpus pipeline: documents scored, cleaned of repeated lines and near copies, mixed, and packed.

Nulls are passed on: a null text is scored, mixed and packed like an empty one, and rows of null id are judged like
others, one of each group staying in near-dedup. Rows repeated in id and text count once from near-dedup on. Columns
beyond those of ``documents`` pass all stages but the last, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import line_dedup, minhash, mixing, packing, quality_classifier
from skein.llm.common import cut, table


def passing(stage: Callable[[DataFrame], DataFrame], docs: DataFrame, *names: str) -> DataFrame:
    """``stage`` of ``docs``, with the columns of ``docs`` alone. Those that have one of the ``names`` which the stage itself
    adds are called otherwise until it is done."""
    own, taken = {}, {c.lower() for c in docs.columns} | {n.lower() for n in names}
    for c in docs.columns:
        if c.lower() in names:
            own[c] = next(x for k in count() if (x := f"{c}_{k}").lower() not in taken)
            taken.add(own[c].lower())
    out = stage(docs.withColumnsRenamed(own))
    return out.select(*(F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned on them and the labels, predicts to be good."""
    labels = table(spark, sf_dir, "labels")
    return passing(lambda d: quality_classifier.classify(d, labels).filter("predicted = 1"), docs, "score", "predicted", "held_out")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; a document that was nothing else goes."""

    def clean(docs: DataFrame) -> DataFrame:
        out = line_dedup.dedup_lines(docs)
        left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
        return out.filter(left).withColumn("n_chars", F.length("text").cast("long"))

    return passing(clean, docs, "n_lines", "n_deleted")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by the same four words and 80 % as the operator's own query."""
    return minhash.keep_first(docs, minhash.Params(words=4))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources at their target weights; a document comes as often as it is drawn. Rows lie by shard, in
    each shard's own order."""
    return passing(mixing.mix, docs, "m_shard", "m_order")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: one row a piece."""
    return packing.best_fit(docs, packing.Params(packing.word_bpe()))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_copies),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL can express neither the learned scores nor the hashes; tests hold run() against the stages done by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
