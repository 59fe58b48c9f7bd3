"""The three runs of a preparation: documents to chunk records, chunk records to packed ones, annotated records to the
final set and its prompts."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.lineage import keep
from skein.functions.text import merged_name, stem
from skein.functions.tokens import count_tokens
from skein.operators import dataset, pack, parse, prompt, records, sections, split
from skein.operators.incremental import skip_existing
from skein.schemas import RECORD, Config
from skein.sources import files, named, sinks

log = logging.getLogger(__name__)


def judged_chunks(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """(source_file, md) -> every chunk with its headers, input and verdict."""
    chunks = split.token_split(sections.header_sections(docs), c.max_tokens, c.overlap, c.counter)
    return records.verdicts(chunks, c)


def chunk_records(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """(source_file, md) -> source_file, id, instruction, input, output."""
    return records.training_records(judged_chunks(docs, c), ["sec_pos", "chunk_pos"], c)


def chunk_lines(docs: DataFrame, found: DataFrame, c: Config = Config()) -> DataFrame:
    """Every chunk as a row for ``named.write``: (name, verdict, value, at), the value being a saved record's line and null
    for others; besides, a row for each of ``found`` (source_file), so that an input without chunks has its file, and one of
    verdict ``failed`` for each of ``docs`` with an error, if it has such a column."""
    name = F.concat(stem(F.col("source_file")), F.lit(".jsonl")).alias("name")
    judged = judged_chunks(docs.filter("md is not null"), c)
    saved = F.col("verdict") == "saved"
    order = Window.partitionBy("source_file").orderBy("sec_pos", "chunk_pos")
    judged = judged.select("source_file", "sec_pos", "chunk_pos", "verdict", F.when(saved, F.col("input")).alias("input"))
    rows = judged.withColumns({"id": F.sum(saved.cast("long")).over(order), "at": F.row_number().over(order), "instruction": F.lit(c.instruction), "output": F.lit("")})
    rows = rows.select(name, "verdict", F.when(saved, sinks.json_line(*RECORD)).alias("value"), "at")
    none = F.lit(None).cast("string")
    rows = rows.unionByName(found.select(name, none.alias("verdict"), none.alias("value"), F.lit(0).alias("at")))
    if "error" in docs.columns:
        failed = docs.filter("error is not null").select(name, F.lit(named.FAILED).alias("verdict"), F.col("error").alias("value"), F.lit(0).alias("at"))
        rows = rows.unionByName(failed)
    return rows


REPORT = "name string, error string, saved long, short long, toc long, small long"


def written_report(spark: SparkSession, folder: str) -> DataFrame:
    """source_file (the output's stem), error, and the counts of chunks of the last run that wrote to a folder."""
    rows = spark.read.schema(REPORT).json(f"{folder.rstrip('/')}/{named.REPORT}")
    n = {k: F.coalesce(k, F.lit(0)) for k in ("saved", "short", "toc", "small")}
    return rows.select(stem(F.col("name")).alias("source_file"), "error", sum(n.values(), F.lit(0)).alias("n_chunks"), *(v.alias(f"n_{k}") for k, v in n.items()))


def documents_to_chunks(spark: SparkSession, folder: str, out: str, c: Config = Config(), convert: Callable[[bytes], str] | None = None) -> DataFrame:
    """Markdown files of ``folder``, or its PDFs if a converter is given, to ``<stem>.jsonl`` files in ``out``; returns the
    report, a row a file.

    Inputs whose output holds something are skipped before they are converted. All others' outputs are replaced, by an
    empty file if nothing of an input is left. A PDF that can't be converted has its reason in the report and no output,
    so the next run tries it again. One job converts, splits, writes and counts."""
    found = files.pdf_files(spark, folder) if convert else files.markdown_files(spark, folder)
    found = skip_existing(found, files.finished(spark, out), c.skip_existing)
    docs = files.to_markdown(found, convert) if convert else found
    if convert:
        docs = keep(docs)  # converted once, for its texts and its errors
    log.info("%s: writing chunks of what isn't done yet to %s", folder, out)
    named.write(chunk_lines(docs, found, c), out, "at", report=True)
    log.info("%s: done, counts by file in %s", folder, named.REPORT)
    return written_report(spark, out)


def merge_records(lines: DataFrame, c: Config = Config(), separator_tokens: int = 0) -> DataFrame:
    """(source_file, pos, value) JSON lines -> packed records, with the name of each merged file."""
    rows = parse.strict(lines)
    rows = rows.withColumn("n", count_tokens(F.col("input"), c.counter))
    packed = pack.next_fit_pack(rows, c.max_tokens, separator_tokens=separator_tokens)
    return packed.withColumn("merged_file", merged_name(F.col("source_file")))


def merge_folder(spark: SparkSession, folder: str, out: str | None = None, c: Config = Config(), separator_tokens: int = 0) -> None:
    """Every ``*.jsonl`` of ``folder`` packed into a ``*-merged.jsonl`` in ``merged_output``, which is replaced. An input
    without rows has an empty output."""
    out = out or f"{folder.rstrip('/')}/merged_output"
    none = F.lit(None).cast("string")
    rows = merge_records(files.jsonl_lines(spark, folder, dotfiles=True), c, separator_tokens)
    rows = rows.select(F.col("merged_file").alias("name"), none.alias("verdict"), sinks.json_line(*RECORD).alias("value"), F.col("id").alias("at"))
    every = files.listed(spark, folder, "*.jsonl").select(merged_name(F.col("source_file")).alias("name"), none.alias("verdict"), none.alias("value"), F.lit(0).cast("long").alias("at"))
    log.info("%s: packing to %d tokens into %s", folder, c.max_tokens, out)
    named.write(rows.unionByName(every), out, "at")


def attach_outputs(rows: DataFrame, annotations: DataFrame) -> DataFrame:
    """Records with ``output`` taken from (source_file, id, output) annotations where there are some."""
    notes = annotations.select("source_file", "id", F.col("output").alias("_output"))
    return rows.join(notes, ["source_file", "id"], "left").withColumn("output", F.coalesce("_output", "output")).drop("_output")


def final_set(lines: DataFrame, c: Config = Config()) -> DataFrame:
    """Annotated JSON lines -> instruction, input, output and pos, in seeded order.

    Values keep their JSON type as variants: numbers, truth values, nulls, arrays and objects go through as they came."""
    ok = parse.lenient(lines, typed=True).filter("ok")
    return dataset.hash_shuffle(ok, "source_file", "pos_in_file", seed=c.seed).select("instruction", "input", "output", "pos")


def prepare_dataset(spark: SparkSession, folder: str, out: str, c: Config = Config()) -> bool:
    """All ``*.jsonl`` of ``folder``, shuffled, to the file ``out`` if its name ends in ``.jsonl``, and else to a folder of
    files, each a range of the order. Without such inputs nothing is written: False."""
    if not files.names(spark, folder, ".jsonl"):
        log.warning("%s: no files, nothing is written", folder)
        return False
    rows = final_set(files.jsonl_lines(spark, folder).withColumnRenamed("pos", "pos_in_file"), c)
    if out.endswith(".jsonl"):
        sinks.write_single(rows, out, "pos")
    else:
        sinks.write_ordered(rows, out, "pos")
    log.info("%s: set written to %s", folder, out)
    return True


def prompts(rows: DataFrame, c: Config = Config()) -> DataFrame:
    """Records with prompt text, response span, and the flag of those over the sequence limit."""
    out = prompt.response_span(prompt.with_prompt(rows, c.eos))
    return out.withColumn("n_tokens", count_tokens(F.col("text"), c.counter)).withColumn("over_cap", prompt.over_cap(F.col("n_tokens"), c.max_seq_length))
