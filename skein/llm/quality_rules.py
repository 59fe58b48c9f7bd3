"""Operator 4, quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

All character n-grams of every word of the whole text are hashed into buckets: from each character on, the next ``n`` of
its word, or what is left of it, so that short words and word ends count as well. Two multinomials over the buckets are
counted, one over the trusted documents and one over all, both smoothed; a document's verdict is the mean log ratio over
its n-grams against a fixed threshold. An n-gram is judged by the others: its own occurrence is taken out of the counts
(leave-one-out), of the trusted ones if its document is trusted. Else rare n-grams would tell apart the documents that
were trusted rather than what they are like.

Counts, look-ups and rules are DataFrame expressions. The multinomials are counted from distinct words, which are summed
up in the tasks first; to score, n-grams are exploded inside a task and summed there. So only word counts, bucket counts
and one row a document are shuffled. The bucket table has a fixed number of rows and is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import cut, table, words

#: Characters that count as symbols (fixed values).
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Params:
    #: Characters of an n-gram, and buckets.
    n: int = 3
    buckets: int = 1 << 16
    #: Added to each bucket's count in either multinomial.
    smooth: float = 1.0
    threshold: float = -0.5
    min_words: int = 10
    window: int = 5
    #: Per cent of words in repeated windows that fail a document.
    repeat_percent: int = 20
    #: Trusted ids up to here are broadcast (16 MB); beyond, documents and ids are shuffled.
    broadcast_ids: int = 2_000_000


def repeated(win: Column, width: int) -> Column:
    """Words covered by windows (their hashes in order) that occur twice or more."""
    tagged = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(tagged: Column) -> Column:
        at = lambda k: F.get(tagged, k)["h"]
        twice = F.filter(tagged, lambda x, k: F.coalesce(x["h"] == at(k - 1), F.lit(False)) | F.coalesce(x["h"] == at(k + 1), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda s, i: F.struct((s["n"] + i + width - F.greatest(i, s["end"])).alias("n"), (i + width).alias("end"))
        return F.aggregate(places, start, step, lambda s: s["n"])

    # a one-element array binds the sorted array to a name, so that it is made once
    return F.get(F.transform(F.array(tagged), covered), F.lit(0))


def base(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, mark and text with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", "mark", text.alias("text"), words(F.col("text")).alias("ws"))
    line = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(
        "doc_id",
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        line.alias("lines"),
        "mark",
        "text",
        F.transform("ws", lambda w: F.xxhash64(w)).alias("h"),
    )
    h, k = F.col("h"), p.window
    win = F.when(F.size("h") < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice("h", F.lit(1), F.size("h") - (k - 1)), lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k))))
    )
    out = out.select("*", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), win.alias("win")).drop("lines", "h")
    n = F.when(F.size(F.array_distinct("win")) < F.size("win"), repeated(F.col("win"), k)).otherwise(0)
    return out.withColumn("n_repeat_words", n.cast("long")).drop("win")


def grams(text: Column, p: Params) -> Column:
    """Buckets of the n-grams of the words of a text, one from each character."""
    found = F.regexp_extract_all(text, F.lit(rf"(?=([^\x20\x09-\x0D]{{1,{p.n}}}))"), F.lit(1))
    return F.transform(found, lambda g: F.pmod(F.xxhash64(g), F.lit(p.buckets)).cast("int"))


def marked(docs: DataFrame, trusted: DataFrame, p: Params) -> DataFrame:
    """``docs`` with mark: 1 if its id is trusted, else 0."""
    ids = trusted.select(F.col("doc_id").alias("t_id")).filter("t_id is not null").distinct()
    if ids.count() <= p.broadcast_ids:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id") == F.col("t_id"), "left").withColumn("mark", F.col("t_id").isNotNull().cast("long")).drop("t_id")


def ratios(docs: DataFrame, p: Params) -> DataFrame:
    """(bucket, mark, ratio) for every bucket that occurs, and n-grams of documents that are trusted (mark 1) or not: the
    log of its share in the trusted texts over that in all, without the n-gram itself. ``docs`` has text and mark."""
    # outer: a plain explode would make Spark test the array's size first, and so make it twice
    each = docs.select("mark", F.explode_outer(words(F.col("text"))).alias("word"))
    of = each.groupBy("word").agg(F.count("*").alias("raw"), F.sum("mark").alias("good")).filter("word is not null")
    each = of.select("raw", "good", F.explode_outer(grams(F.col("word"), p)).alias("bucket"))
    counts = cut(each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).filter("bucket is not null"))
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    both = counts.withColumn("mark", F.explode(F.array(F.lit(0), F.lit(1))))
    part = lambda n, own: (F.greatest(F.col(n) - own, F.lit(0)) + p.smooth) / (F.greatest(F.lit(total[n]) - own, F.lit(0)) + p.smooth * p.buckets)
    ratio = F.log(part("good", F.col("mark")) / part("raw", F.lit(1))) if total.good else F.lit(0.0)
    return both.select("bucket", "mark", ratio.alias("ratio"))


def judge(docs: DataFrame, trusted: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio (the mean log ratio) and
    kept, one row per row of ``docs``.

    Null text is empty; a text without words has ratio 0 and fails the base rules. Repeated rows count as often as they
    come; a null doc_id is never trusted. With no trusted row all ratios are 0, and the base rules decide alone. An
    empty table gives no rows; other columns are ignored."""
    docs = marked(docs.select("doc_id", "text"), trusted, p)
    table_ = ratios(docs, p)
    # both ratios of a bucket side by side; p.buckets rows at most, whatever the corpus
    table_ = F.broadcast(table_.groupBy("bucket").agg(F.max(F.when(F.col("mark") == 0, F.col("ratio"))).alias("r0"), F.max(F.when(F.col("mark") == 1, F.col("ratio"))).alias("r1")))
    stats = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = base(docs, p).withColumn("row", F.monotonically_increasing_id())
    each = rows.select("row", *stats, "mark", F.explode_outer(grams(F.col("text"), p)).alias("bucket"))
    own = F.when(F.col("mark") == 1, F.col("r1")).otherwise(F.col("r0"))
    out = each.join(table_, "bucket", "left").groupBy("row", *stats).agg(F.avg(own).alias("ratio"))
    out = out.withColumn("ratio", F.round(F.coalesce("ratio", F.lit(0.0)), 9))  # sums in any order give the same verdict
    failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    return out.select(*stats, failed.alias("base_failed"), "ratio", (~failed & (F.col("ratio") >= p.threshold)).alias("kept"))


def op4(spark, sf_dir: str) -> DataFrame:
    # the ids that the classifier holds out as well are never trusted, so that verdicts can be measured on them
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and crc32(cast(doc_id as string)) % 4 <> 2")
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
