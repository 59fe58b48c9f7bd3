"""Folders of files as tables: JSON lines, Markdown, PDF; all with the file's name."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.lineage import keep
from skein.schemas import DOCUMENT, FINAL

#: Splits whose offsets are broadcast (some 100 MB).
SPLITS = 1_000_000
LINES = "value string, source_file string, pos long"
#: Spark's readers pass over such names without a word.
HIDDEN = re.compile(r"^[._]")


class HiddenFiles(ValueError):
    """A folder holds input files whose names Spark's readers skip."""


def names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Names in a folder, not below it, that end in ``suffix``, case as written; hidden ones too. None for no folder."""
    fs_ = spark._jvm.org.apache.hadoop.fs
    path = fs_.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(n for f in fs.listStatus(path) if f.isFile() and (n := f.getPath().getName()).endswith(suffix))


def file_name() -> Column:
    """source_file: the name of a row's file as it is. Spark gives it as part of a URI, where a space is ``%20``."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("source_file")


def refuse_hidden(spark: SparkSession, folder: str, suffix: str, dotfiles: bool = True) -> None:
    """Raise if input files would be skipped; ``dotfiles`` says whether names with a dot count as input."""
    found = [n for n in names(spark, folder, suffix) if HIDDEN.match(n) and (dotfiles or not n.startswith("."))]
    if found:
        raise HiddenFiles(f"{folder}: rename {', '.join(found[:5])}, which Spark's readers skip")


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` (value, source_file, block, the place of its split in the file, and at, which grows along a split) with pos,
    the line's number in its file from 1.

    Lines are counted in each split first; sums over the splits of a file give the offset of each, and a line's number is
    that offset and its place in the split. No file is sorted, and none is in one task."""
    counts = lines.groupBy("source_file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    offsets = keep(counts.select("source_file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    # a row a split: some 100 TB come to as many rows as here are allowed; more are met by a shuffle
    few = offsets.count() <= SPLITS
    out = lines.join(F.broadcast(offsets) if few else offsets, ["source_file", "block"])
    return out.withColumn("pos", (F.col("offset") + F.col("at") - F.col("first") + 1).cast("long")).drop("first", "offset")


def jsonl_lines(spark: SparkSession, folder: str, dotfiles: bool = False) -> DataFrame:
    """value, source_file and pos (line number within a file, from 1) of every line of the folder's ``*.jsonl``.

    A folder without such files, or none at all, gives no rows. Lines end at a newline, a carriage return or both. A line
    that isn't UTF-8 fails the query. Files are read twice, once for the number of lines alone."""
    refuse_hidden(spark, folder, ".jsonl", dotfiles)
    if not names(spark, folder, ".jsonl"):
        return spark.createDataFrame([], LINES)
    lines = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "false").text(folder)
    # a task reads the lines of a split one after the other, and its splits one after the other
    lines = lines.select("value", file_name(), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return numbered(lines).select(F.validate_utf8("value").alias("value"), "source_file", "pos")


def final_records(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """A written dataset, by its declared columns, as strings or, ``typed``, as variants; a malformed line fails the query."""
    kind = "variant" if typed else "string"
    return spark.read.schema(", ".join(f"{k} {kind}" for k in FINAL)).option("mode", "FAILFAST").json(path)


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """source_file and md, one row a ``*.md`` file; none for no folder."""
    refuse_hidden(spark, folder, ".md")
    if not names(spark, folder, ".md"):
        return spark.createDataFrame([], DOCUMENT)
    rows = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return rows.select(file_name(), F.col("value").alias("md"))


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """source_file of each file of a folder that fits a pattern; none for no folder. Contents aren't read."""
    if not names(spark, folder, pattern.lstrip("*")):
        return spark.createDataFrame([], "source_file string")
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return rows.select(file_name())


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, length and content of each ``*.pdf``, case as written, not below the folder; none for no folder."""
    refuse_hidden(spark, folder, ".pdf")
    if not names(spark, folder, ".pdf"):
        return spark.createDataFrame([], "source_file string, length long, content binary")
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return rows.select(file_name(), "length", "content")


def pymupdf_markdown(content: bytes) -> str:
    """Markdown of a PDF by the optional library pymupdf4llm."""
    try:
        import pymupdf
        import pymupdf4llm
    except ImportError as e:
        raise RuntimeError("PDF conversion needs pymupdf4llm; install it on the executors, or pass another converter") from e
    return pymupdf4llm.to_markdown(pymupdf.open(stream=content, filetype="pdf"))


def to_markdown(pdfs: DataFrame, convert: Callable[[bytes], str] = pymupdf_markdown) -> DataFrame:
    """source_file, md and error of PDF bytes, converted on the executors one by one.

    A file that the converter fails on has null md, and the reason as error; the others go on. A missing converter
    (RuntimeError) isn't a file's fault and fails the query. Null bytes are an error."""

    def one(content: bytes | None) -> tuple[str | None, str | None]:
        try:
            if content is None:
                raise ValueError("no content")
            return convert(content), None
        except RuntimeError as e:
            if isinstance(e.__cause__, ImportError):
                raise
            return None, f"{type(e).__name__}: {e}"
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):  # a document at a time, so that no batch of converted ones is held
                md, error = one(b.column("content")[k].as_py())
                yield pa.RecordBatch.from_arrays([b.column("source_file").slice(k, 1), pa.array([md], pa.string()), pa.array([error], pa.string())], names=["source_file", "md", "error"])

    return pdfs.select("source_file", "content").mapInArrow(run, "source_file string, md string, error string")


def finished(spark: SparkSession, folder: str, suffix: str = ".jsonl") -> DataFrame:
    """stem of each output that holds something: ``<stem>.jsonl`` files, or ``source_file=<stem>`` folders of one."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).filter("length > 0").select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "stem string")
    part = F.url_decode(F.regexp_extract("path", r"/source_file=([^/]*)/", 1))
    file = F.regexp_extract("path", rf"/([^/]*){re.escape(suffix)}$", 1)
    name = F.when(part != "", F.regexp_replace(part, r"\.[^.]*$", "")).when(~F.col("path").contains("/source_file="), file)
    return found.select(name.alias("stem")).filter("stem <> ''").distinct()
