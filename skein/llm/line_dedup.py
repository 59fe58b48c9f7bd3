"""Operator 7, line dedup: winnowing over line hashes.

A run of lines is full if it holds ``min_words`` words or ``max_lines`` lines with words. Blank lines are passed over
when runs are formed and compared; they belong to the run around them or, at an end of the text, beside them.

Winnowing: from every line a window goes over the shortest full run that begins there, or its first ``window`` lines, and
the line of least hash in it is a fingerprint. A full run that stands in two places holds such a window in both, so they
share the fingerprint: none is missed. Neighbouring windows mostly have one minimum, so few lines are fingerprints.

Positions are joined by fingerprint; where one stands alone, nothing around it is repeated, and it ends there. Each other
position is extended both ways, to the full runs around it: those of its windows that aren't full without their last
line, and their longer kin that aren't full without their first. A very common line has very many positions, so these
aren't compared pair by pair: the hash of each run is joined with the first place in the corpus (by doc_id, then line) of
the same run, and the later one is deleted. Longer matches are unions of such runs, each with a fingerprint of its own;
together they are deleted to the line. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import WORD, boxed, cut, table


@dataclass(frozen=True)
class Params:
    #: A repeated run counts if it holds so many words, or so many lines with words.
    min_words: int = 50
    max_lines: int = 5
    #: Most lines of a window, of which the least is a fingerprint; up to the shortest full run, whatever the number.
    window: int = 5


def line_hashes(lines: Column) -> Column:
    """Hashes of the lines as they are, but for white space at either end."""
    return F.transform(lines, lambda x: F.xxhash64(F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")))


def fingerprints(docs: DataFrame, p: Params) -> DataFrame:
    """row, f (the line hash of a fingerprint) and runs, an array of at, last (first and last line) and g (hash) of the full
    runs around it; a row a fingerprint."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    out = docs.select("row", lines.alias("lines"))
    out = out.select("row", "lines", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("w"))
    # pos: places of the lines with words; all else is about these lines alone
    out = out.withColumn("pos", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("w", i) > 0))
    some = lambda c: F.when(F.size("pos") < F.size("lines"), F.transform("pos", lambda i: F.get(c, i))).otherwise(F.col(c))
    out = out.select("row", "pos", F.size("lines").alias("n_lines"), line_hashes(some("lines")).alias("h"), some("w").alias("w"))
    h, w, k = F.col("h"), F.col("w"), p.max_lines
    least = F.lit(p.min_words)

    def size(i: Column) -> Column:
        """Lines of the shortest full run from line i; null if the text ends before it is full."""
        total, out = F.get(w, i), F.when(F.get(w, i) >= least, F.lit(1))
        for j in range(1, k):
            total = total + F.get(w, i + j)
            out = out.when((total >= least) | F.lit(j == k - 1) & total.isNotNull(), F.lit(j + 1))
        return out

    out = out.withColumn("m", F.transform("h", lambda _, i: size(i)))

    def least_line(m: Column, i: Column) -> Column:
        """The line of least hash in the window from line i, whose shortest full run has m lines."""
        best, at = F.get(h, i), i
        for j in range(1, min(k, p.window)):
            x = F.get(h, i + j)
            better = (m > j) & (x < best)
            best, at = F.when(better, x).otherwise(best), F.when(better, i + j).otherwise(at)
        return F.when(m.isNotNull(), at)

    out = out.withColumn("s", F.transform("m", least_line))
    # minima of windows one after the other never go back, so equal ones are neighbours
    first = F.filter(F.transform("s", lambda x, i: F.when((i == 0) | ~x.eqNullSafe(F.get("s", i - 1)), x)), lambda x: x.isNotNull())
    # outer: a plain explode would make Spark test the array's size first, and so make it twice
    out = out.select("row", "pos", "n_lines", "h", "m", "s", F.explode_outer(first).alias("at")).filter("at is not null")

    def runs(i: Column) -> Column:
        """The full runs from line i of which the fingerprint is told: the shortest one, and those up to the next line's."""
        m = F.get("m", i)
        most = F.least(F.coalesce(F.get("m", i + 1), F.lit(k)), F.lit(k), F.size("h") - i)

        def run(n: Column) -> Column:
            end = i + n
            low = F.when(i == 0, 0).otherwise(F.get("pos", i))
            last = F.when(end == F.size("h"), F.col("n_lines")).otherwise(F.get("pos", end - 1) + 1) - 1
            return F.struct(low.alias("at"), last.alias("last"), F.xxhash64(n, *(F.when(n > j, F.get(h, i + j)) for j in range(k))).alias("g"))

        return F.transform(F.sequence(m, F.greatest(m, most)), run)

    # windows that tell of a line begin at it or up to a window before it
    starts = F.filter(F.array(*(F.col("at") - j for j in range(min(k, p.window)))), lambda i: (i >= 0) & F.get("s", i).eqNullSafe(F.col("at")))
    return out.select("row", F.get("h", F.col("at")).alias("f"), F.flatten(F.transform(starts, runs)).alias("runs"))


def deletions(docs: DataFrame, p: Params) -> DataFrame:
    """(row, gone): the lines of each row to delete, numbered from 0. ``docs`` has row and text."""
    prints = cut(fingerprints(docs, p))
    # cut, so that they meet what they are joined with by a shuffle of its own, which can split a very common one
    common = cut(prints.groupBy("f").count().filter("count > 1").select("f"))
    marks = cut(prints.join(common, "f", "left_semi").select("row", F.inline("runs")))
    first = cut(marks.groupBy("g").agg(F.min(F.struct("row", "at", "last")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("g", "first"))
    found = marks.join(first, "g").filter(~(F.col("row") == F.col("first.row")) | ~(F.col("at") == F.col("first.at")))
    # within a document, the first occurrence stays as it is: a run that overlaps it begins behind it
    low = F.when(F.col("row") == F.col("first.row"), F.greatest("at", F.col("first.last") + 1)).otherwise(F.col("at"))
    spans = found.select("row", low.alias("low"), "last").distinct()
    gone = F.flatten(F.collect_list(F.sequence("low", "last")))
    return spans.groupBy("row").agg(F.array_distinct(gone).alias("gone"))


def dedup_lines(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with later repeated runs of lines cut out of ``text``, and n_lines and n_deleted besides.

    First is the occurrence of least doc_id (null before all), then text hash, then line. Null texts stay null and empty
    ones empty; a text all of whose lines are repeated becomes empty. Runs below both limits stay. Rows alike in id and
    text are one document and stay alike. An empty table gives no rows; other columns pass through, but for two named
    n_lines and n_deleted, which are replaced."""
    # a key that any second reading of the rows gives again; a struct, in which nulls equal each other
    row = F.struct("doc_id", F.xxhash64("text").alias("h"))
    rows = docs.select(boxed(docs, "n_lines", "n_deleted").alias("r"), "doc_id", "text", row.alias("row"))
    gone = deletions(rows.select("row", "text"), p)
    out = rows.join(gone, "row", "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    n_lines = F.when(F.col("text").isNotNull(), F.size(lines)).otherwise(0).cast("long")
    n_deleted = F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).cast("long")
    return out.select(F.col("r").withField("text", text).alias("r"), n_lines.alias("n_lines"), n_deleted.alias("n_deleted")).select("r.*", "n_lines", "n_deleted")


def op7(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_deleted, n_chars and md5 of what is left of each text."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))
