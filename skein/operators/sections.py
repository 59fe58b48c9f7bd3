"""Header sectioning of Markdown: one row per section, tagged with the headers that are active in it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import printable, strip
from skein.schemas import SECTION


def fences(lines: Column) -> Column:
    """[start, end) of each code fence in an array of stripped lines. Only fence lines enter the fold."""
    mark = lambda x: F.when(x.startswith("```"), F.lit("```")).when(x.startswith("~~~"), F.lit("~~~"))
    once = lambda x: F.when(x.startswith("```"), F.regexp_count(x, F.lit("```")) == 1).otherwise(F.lit(True))
    events = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), mark(x).alias("mark"), once(x).alias("opens"))), lambda e: e["mark"].isNotNull())
    none = F.lit(None).cast("string")
    zero = F.struct(none.alias("open"), F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("done"))

    def step(s: Column, e: Column) -> Column:
        closes, opens = s["open"] == e["mark"], s["open"].isNull() & e["opens"]
        done = F.when(closes, F.concat(s["done"], F.array(F.struct(s["at"].alias("s"), e["i"].alias("e"))))).otherwise(s["done"])
        return F.struct(
            F.when(opens, e["mark"]).when(closes, none).otherwise(s["open"]).alias("open"),
            F.when(opens, e["i"]).otherwise(s["at"]).alias("at"),
            done.alias("done"),
        )

    last = lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(s["at"].alias("s"), F.lit(2147483647).alias("e")))))
    return F.aggregate(events, zero, step, last)


def header_sections(docs: DataFrame) -> DataFrame:
    """(source_file, md) -> (source_file, sec_pos, h1, h2, h3, content); sec_pos counts from 0.

    Lines are stripped; a header is one to three ``#`` followed by a space or nothing, and ends headers of its own and
    deeper levels. Lines of a block are joined by a newline, blocks of a section by two spaces and a newline. Adjacent
    sections of equal headers are one; a header without a body gives no section. Fenced lines are never headers."""
    x = F.transform(F.split("md", "\n", -1), lambda s: printable(strip(s)))
    rows = docs.select("source_file", x.alias("lines")).withColumn("fences", fences(F.col("lines")))
    # outer: a plain explode would make Spark test the array's size first, and so make it twice
    rows = rows.select("source_file", "fences", F.posexplode_outer("lines").alias("pos", "x")).filter("pos is not null")
    inside = F.exists("fences", lambda f: (F.col("pos") >= f["s"]) & (F.col("pos") < f["e"]))
    rows = rows.select("source_file", "pos", "x", inside.alias("fenced"))
    level = F.when(F.col("fenced"), 0).otherwise(F.length(F.regexp_extract("x", r"^(#{1,3})(?: |$)", 1)))
    rows = rows.withColumn("lv", level).withColumn("t", strip(F.expr("substring(x, lv + 1)")))
    w = Window.partitionBy("source_file").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    seen = {k: F.max(F.when(F.col("lv") == k, F.struct("pos", "t"))).over(so_far) for k in (1, 2, 3)}
    breaks = F.sum(((F.col("lv") > 0) | (F.col("x") == "") & ~F.col("fenced")).cast("int")).over(so_far)
    rows = rows.withColumns({"a": seen[1], "b": seen[2], "c": seen[3], "block": breaks})
    p1, p2 = F.coalesce("a.pos", F.lit(-1)), F.coalesce("b.pos", F.lit(-1))
    rows = rows.select("source_file", "pos", "x", "lv", "fenced", "block", F.col("a.t").alias("h1"), F.when(F.col("b.pos") > p1, F.col("b.t")).alias("h2"), F.when(F.col("c.pos") > F.greatest(p1, p2), F.col("c.t")).alias("h3"))
    rows = rows.filter((F.col("lv") == 0) & ((F.col("x") != "") | F.col("fenced")))
    heads = F.struct("h1", "h2", "h3")
    rows = rows.withColumns({"new": (~F.lag(heads).over(w).eqNullSafe(heads)).cast("int"), "same": F.coalesce(F.lag("block").over(w) == F.col("block"), F.lit(False))})
    rows = rows.withColumn("sec_pos", F.sum("new").over(so_far) - 1)
    piece = F.concat(F.when(F.col("same"), "\n").otherwise("  \n"), F.col("x"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", piece.alias("p")))), lambda s: s["p"]), "")
    # every first line of a section opens a block, so three characters come before it, unless headers changed within one
    joined = rows.groupBy("source_file", "sec_pos", "h1", "h2", "h3").agg(text.alias("content"))
    return joined.select("source_file", "sec_pos", "h1", "h2", "h3", F.regexp_replace("content", r"^(?:  )?\n", "").alias("content"))


_HEADER = re.compile(r"(#{1,3})(?: |$)").match


def _printable(line: str) -> str:
    return line if line.isprintable() else "".join(c for c in line if c == " " or unicodedata.category(c)[0] not in "CZ")


def sections_of(md: str) -> list[tuple]:
    """(sec_pos, h1, h2, h3, content) of one document, by the rules of ``header_sections``."""
    heads, fence, block = (None, None, None), None, 0
    out: list[tuple[tuple, list[str]]] = []  # headers and pieces of each section
    last = None  # headers and block of the line before
    for line in md.split("\n"):
        x = _printable(line.strip())
        mark = x[:3] if x.startswith(("```", "~~~")) else None
        if fence:
            fence = None if mark == fence else fence
        elif mark == "~~~" or mark and x.count(mark) == 1:
            fence = mark
        header = None if fence else _HEADER(x)
        if header:
            n = len(header[1])
            heads = (*heads[: n - 1], x[n:].strip(), *(None,) * (3 - n))
        if header or not x and not fence:
            block += 1
            continue
        if not last or last[0] != heads:
            out.append((heads, []))
        out[-1][1].append(("\n" if last and last[1] == block else "  \n") + x)
        last = heads, block
    return [(k, *h, re.sub(r"^(?:  )?\n", "", "".join(p))) for k, (h, p) in enumerate(out)]


def section_rows(docs: DataFrame) -> DataFrame:
    """``header_sections`` a document at a time, without windows: for streams, in which there are none. A document is a
    row, and its sections are made in one task."""
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                file, md = b.column("source_file")[k].as_py(), b.column("md")[k].as_py()
                rows = [(file, *s) for s in sections_of(md)] if md is not None else []
                columns = zip(*rows) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["source_file", "sec_pos", "h1", "h2", "h3", "content"])

    return docs.select("source_file", "md").mapInArrow(run, SECTION)
