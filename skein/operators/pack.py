"""Greedy next-fit packing of consecutive rows of a file up to a token budget.

Where a bin ends depends on where it began, so a plain fold goes through a file in one task. Here a file is cut into
blocks of neighbouring rows, and a block is summed up as a function: from what the open bin holds when the block begins
to what it holds when the block ends, and how many bins open in between. All that the entry decides is the first row
to open a bin; from there on everything in the block is known. So the function is a list of the rows that can be that
first one (those within one budget of the block's start), each with its outcome. Such functions compose to functions
of the same size, level by level, and the entries of the blocks follow from the top down. Then every block places its
own rows. A file of any length is thus packed by many tasks, in time linear in its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.lineage import keep

#: Positions of a block, and blocks of a group of the next level, as powers of two.
BLOCK, FAN = 13, 8


@dataclass(frozen=True)
class Summary:
    """What a run of rows does to the open bin. ``reach`` (ascending, distinct) are sums of the rows up to each one that
    can be the first to open a bin, ``total`` and ``opened`` what is open at the end in that case, and the bins opened
    after it. ``whole`` is the sum of all rows. ``fresh`` is the outcome if the first row opens the file's first bin."""

    reach: np.ndarray
    total: np.ndarray
    opened: np.ndarray
    whole: int
    fresh: tuple[int, int]

    def __call__(self, held: int, budget: int) -> tuple[int, int]:
        """What is open at the end, and how many bins were opened, if ``held`` is open at the start."""
        k = int(np.searchsorted(self.reach, budget - held, "right"))
        if k == len(self.reach):
            return held + self.whole, 0
        return int(self.total[k]), 1 + int(self.opened[k])

    def then(self, other: Summary, budget: int) -> Summary:
        ends = [other(int(t), budget) for t in self.total]
        total, opened = [t for t, _ in ends], [n + m for n, (_, m) in zip(self.opened.tolist(), ends)]
        later = self.whole + other.reach
        if len(self.reach):  # rows of equal sums, and those beyond one that no bin can pass, are never first
            later = later[(later > self.reach[-1]) & (self.reach[-1] <= budget)]
        skip = len(other.reach) - len(later) if len(later) else 0
        held, more = other(self.fresh[0], budget)
        return Summary(
            np.concatenate([self.reach, later]),
            np.array([*total, *other.total[skip : skip + len(later)].tolist()], np.int64),
            np.array([*opened, *other.opened[skip : skip + len(later)].tolist()], np.int64),
            self.whole + other.whole,
            (held, self.fresh[1] + more),
        )


def starts(sums: np.ndarray, budget: int) -> np.ndarray:
    """For each row, taken as the first of a bin, the row that opens the next one; the number of rows if none does.
    ``sums`` are running sums."""
    before = np.r_[0, sums[:-1]]
    return np.maximum(np.searchsorted(sums, before + budget, "right"), np.arange(1, len(sums) + 1))


def summary(n: np.ndarray, budget: int) -> Summary:
    """Of the token counts of a block."""
    sums = np.cumsum(n)
    after, before = starts(sums, budget).tolist(), np.r_[0, sums[:-1]].tolist()
    total, opened, whole = [0] * len(n), [0] * len(n), int(sums[-1])
    for j in range(len(n) - 1, -1, -1):
        k = after[j]
        total[j], opened[j] = (whole - before[j], 0) if k == len(n) else (total[k], opened[k] + 1)
    # a row of no tokens is never the first to open a bin but where too much is open already
    at = np.flatnonzero(np.r_[True, sums[1:] > sums[:-1]])
    at = at[: int(np.searchsorted(sums[at], budget, "right")) + 1]
    return Summary(sums[at], np.array(total, np.int64)[at], np.array(opened, np.int64)[at], whole, (total[0], opened[0]))


def bins(n: np.ndarray, budget: int, held: int | None, bin_: int) -> np.ndarray:
    """The bin of each row of a block, if ``held`` is open in bin ``bin_`` when it begins; none at all if null."""
    sums = np.cumsum(n)
    after = starts(sums, budget).tolist()
    opens = np.zeros(len(n), np.int64)
    at = 0 if held is None else int(np.searchsorted(sums, budget - held, "right"))
    while at < len(n):
        opens[at] = 1
        at = after[at]
    if held is None:
        opens[0] = 0
    return bin_ + np.cumsum(opens)


SUMMARY = "block long, reach array<long>, total array<long>, opened array<long>, whole long, fresh_total long, fresh_opened long"


def _row(s: Summary) -> dict:
    return {"reach": s.reach, "total": s.total, "opened": s.opened, "whole": s.whole, "fresh_total": s.fresh[0], "fresh_opened": s.fresh[1]}


def _of(rows: pd.DataFrame) -> list[Summary]:
    arrays = (np.asarray(a, np.int64) for c in ("reach", "total", "opened") for a in rows[c])
    arrays = list(arrays)
    k = len(rows)
    return [Summary(arrays[i], arrays[k + i], arrays[2 * k + i], int(w), (int(t), int(o))) for i, (w, t, o) in enumerate(zip(rows["whole"], rows["fresh_total"], rows["fresh_opened"]))]


def placed(rows: DataFrame, budget: int, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(source_file, pos, n) -> source_file, pos, n and bin, from 1 within a file. ``pos`` is distinct within a file."""
    kind = dict(rows.dtypes)["source_file"]
    file = F.coalesce(F.concat(F.lit("="), F.col("source_file").cast("string")), F.lit("")).alias("file")  # never null
    narrow = keep(rows.select(file, F.col("pos").cast("long").alias("pos"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))
    low, high = narrow.agg(F.min("pos"), F.max("pos")).first()
    narrow = narrow.withColumn("block", F.shiftright(F.col("pos") - F.lit(low or 0), block).cast("long"))
    keyed = "file string, "

    def sum_up(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        out = _row(summary(b.sort_values("pos")["n"].to_numpy(np.int64), budget))
        return pd.DataFrame([{"file": key[0], "block": key[1], **out}])

    def compose(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        first, *rest = _of(b.sort_values("block"))
        for s in rest:
            first = first.then(s, budget)
        return pd.DataFrame([{"file": key[0], "block": key[1], **_row(first)}])

    def enter(key: tuple, own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        """Entries of the blocks of a group from that of the group."""
        own, out = own.sort_values("block"), []
        held, bin_ = (None, 1) if above["held"].isna().iloc[0] else (int(above["held"].iloc[0]), int(above["bin"].iloc[0]))
        for block_, s in zip(own["block"], _of(own)):
            out.append((key[0], block_, held, bin_))
            held, more = s.fresh if held is None else s(held, budget)
            bin_ += more
        return pd.DataFrame(out, columns=["file", "block", "held", "bin"]).astype({"held": "Int64"})

    def place(key: tuple, b: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("pos")
        held = None if entry["held"].isna().iloc[0] else int(entry["held"].iloc[0])
        return b[["file", "pos", "n"]].assign(bin=bins(b["n"].to_numpy(np.int64), budget, held, int(entry["bin"].iloc[0])))

    levels, span = [keep(narrow.groupBy("file", "block").applyInPandas(sum_up, keyed + SUMMARY))], (high - low if high is not None else 0) >> block
    while span >> fan:
        span >>= fan
        levels.append(keep(levels[-1].groupBy("file", F.shiftright("block", fan).alias("group")).applyInPandas(compose, keyed + SUMMARY)))
    entries = levels[-1].select("file", F.lit(0).cast("long").alias("block"), F.lit(None).cast("long").alias("held"), F.lit(1).cast("long").alias("bin")).distinct()
    for level in reversed(levels):
        group = level.groupBy("file", F.shiftright("block", fan).alias("group"))
        entries = group.cogroup(entries.groupBy("file", "block")).applyInPandas(enter, keyed + "block long, held long, bin long")
    out = narrow.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInPandas(place, keyed + "pos long, n long, bin long")
    return out.select(F.when(F.col("file") != "", F.expr("substring(file, 2)")).cast(kind).alias("source_file"), "pos", "n", "bin")


def first_instruction(instruction: Column, pos: Column) -> Column:
    """Aggregate: the first instruction of a file that isn't null."""
    return F.min_by(instruction, F.when(instruction.isNotNull(), pos))


def next_fit_pack(rows: DataFrame, budget: int = 6000, separator: str = "\n\n", separator_tokens: int = 0) -> DataFrame:
    """(source_file, pos, n, instruction, input) -> source_file, id, instruction, input, output, n_tokens, n_parts.

    A row opens a bin if it overruns the budget of the one before and that one isn't empty; so equality fits, and an
    oversize row is alone. One row a bin; ids from 1 within a file; output is empty. ``separator_tokens`` are charged for
    each part but a bin's first, and counted in n_tokens; by default separators are left out of the total. A null count
    is 0, a null input an absent text; an empty table gives no rows."""
    # a separator before every part, of which the budget allows one more
    parts = placed(rows.select("source_file", "pos", (F.coalesce("n", F.lit(0)) + separator_tokens).alias("n")), budget + separator_tokens)
    texts = rows.select(F.col("source_file").alias("file"), F.col("pos").cast("long").alias("at"), "input")
    own = parts.join(texts, F.col("source_file").eqNullSafe(F.col("file")) & (F.col("pos") == F.col("at")))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "input")))
    out = own.groupBy("source_file", F.col("bin").alias("id")).agg(
        F.array_join(F.transform(ordered, lambda x: x["input"]), separator).alias("input"),
        (F.sum("n") - separator_tokens).alias("n_tokens"),
        F.count("*").alias("n_parts"),
    )
    heads = rows.groupBy(F.col("source_file").alias("file")).agg(first_instruction(F.col("instruction"), F.col("pos")).alias("instruction"))
    out = out.join(heads, F.col("source_file").eqNullSafe(F.col("file")))  # a row a file
    return out.select("source_file", "id", "instruction", "input", F.lit("").alias("output"), "n_tokens", "n_parts")
