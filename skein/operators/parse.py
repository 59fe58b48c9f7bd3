"""JSON lines to records, strictly or leniently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import is_blank
from skein.schemas import FINAL as KEYS


def _rules(lines: DataFrame) -> None:
    """Sets an option of the session, which parsing reads when the query runs; it concerns variants alone."""
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # the last of equal keys wins


def single(line: Column) -> Column:
    """The line as a variant if it is one JSON value and nothing else; else null. In brackets, trailing text is an error
    and a second value a second element."""
    # a null line, or one of two values, has no single element
    every = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]"))).try_cast("array<variant>")
    return F.when(F.size(every) == 1, F.get(every, F.lit(0)))


def has(v: Column, key: str) -> Column:
    """Whether an object has the key; a JSON null counts."""
    return F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


def lenient(lines: DataFrame, typed: bool = False) -> DataFrame:
    """``lines`` (with ``value``) plus ``ok`` and the three fields, which are null where ``ok`` is false.

    A line is good if it is one JSON object with all three keys; null values pass. Fields are strings, or variants with
    ``typed``, which keeps numbers, truth values, arrays and objects as they are."""
    _rules(lines)
    rows = lines.withColumn("_v", single(F.col("value")))
    ok = F.lit(True)
    for k in KEYS:
        ok = ok & has(F.col("_v"), k)
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    kind = "variant" if typed else "string"
    return rows.withColumns({k: F.when(F.col("ok"), F.try_variant_get("_v", f"$.{k}", kind)) for k in KEYS}).drop("_v")


def records(lines: DataFrame, typed: bool = False) -> DataFrame:
    """The good lines of ``lenient``."""
    return lenient(lines, typed).filter("ok").drop("ok", "value")


def rejects(lines: DataFrame) -> DataFrame:
    """The lines that ``records`` leaves out."""
    return lenient(lines).filter("not ok").drop("ok", *KEYS)


def strict(lines: DataFrame) -> DataFrame:
    """``lines`` without blank ones, with instruction and input; a malformed line, or one without ``input``, fails the
    query. A missing instruction is empty, a null one null."""
    _rules(lines)
    rows = lines.filter(~is_blank(F.col("value"))).withColumn("_v", single(F.col("value")))
    bad = ~F.coalesce(has(F.col("_v"), "input"), F.lit(False))
    text = F.when(bad, F.raise_error(F.concat(F.lit("not a record: "), F.col("value")))).otherwise(F.try_variant_get("_v", "$.input", "string"))
    instruction = F.when(has(F.col("_v"), "instruction"), F.try_variant_get("_v", "$.instruction", "string")).otherwise("")
    return rows.withColumns({"instruction": instruction, "input": text}).drop("_v", "value")
