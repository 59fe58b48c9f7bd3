"""Prompt texts, response spans and token labels for fine-tuning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.tokens import encoding, slabs
from skein.schemas import INPUT_MARK, INSTRUCTION_MARK, OUTPUT_MARK


def prompt_text(instruction: Column, input_: Column, output: Column, eos: str) -> Column:
    """The three fields behind their marks. Null, JSON's too, shows as ``None``; a variant that is no string as its JSON
    text, so ``true`` and ``[1,2]``."""
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(F.lit(INSTRUCTION_MARK), shown(instruction), F.lit("\n\n" + INPUT_MARK), shown(input_), F.lit("\n\n" + OUTPUT_MARK), shown(output), F.lit(eos))


def with_prompt(rows: DataFrame, eos: str) -> DataFrame:
    return rows.withColumn("text", prompt_text(F.col("instruction"), F.col("input"), F.col("output"), eos))


def response_span(rows: DataFrame, mark: str = OUTPUT_MARK) -> DataFrame:
    """``rows`` with resp_start (1-based place behind the first mark; 0 if there is none), prompt and response."""
    at = F.instr("text", mark)
    out = rows.withColumn("resp_start", F.when(at > 0, at + len(mark)).otherwise(0).cast("long"))
    return out.withColumns({
        "prompt": F.when(F.col("resp_start") > 0, F.expr("substring(text, 1, int(resp_start) - 1)")).otherwise(F.col("text")),
        "response": F.when(F.col("resp_start") > 0, F.expr("substring(text, int(resp_start))")).otherwise(""),
    })


def spans(text: str, start: str, end: str) -> list[tuple[int, int]]:
    """Every stretch behind an output mark, up to the next instruction mark or the end."""
    out, at = [], text.find(start)
    while at >= 0:
        low = at + len(start)
        high = text.find(end, low)
        out.append((low, high if high >= 0 else len(text)))
        at = text.find(start, high) if high >= 0 else -1
    return out


def labels_of(text: str, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The tokens that begin in a response, -100 for all others. ``sizes`` are the tokens' lengths in bytes.

    So a token that holds the end of a mark and the first characters of a response isn't learned, and one that runs from
    a response into the next mark is."""
    out, start = np.full(len(tokens), -100, np.int32), np.cumsum(sizes) - sizes
    at, byte = 0, 0  # both count along the text, so that it is encoded once
    for low, high in spans(text, OUTPUT_MARK, INSTRUCTION_MARK):
        first = byte + len(text[at:low].encode())
        at, byte = high, first + len(text[low:high].encode())
        mine = slice(*np.searchsorted(start, [first, byte]))
        out[mine] = tokens[mine]
    return out


def token_labels(rows: DataFrame, counter: str = "bpe_multi50k", cap: int = 8192) -> DataFrame:
    """``rows`` with tokens, labels (tokens of responses, else -100), both cut at ``cap``, and n_tokens before the cut.

    Tokens are those of the whole text in one encoding, as a trainer makes them; labels follow from the place of each
    token in the text. A null text is an empty one."""

    @F.arrow_udf("struct<tokens:array<int>,labels:array<int>,n_tokens:bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct({"tokens": pa.list_(pa.int32()), "labels": pa.list_(pa.int32()), "n_tokens": pa.int64()})
        own = encoding(counter)
        size = np.zeros(own.n_vocab, np.int64)
        for t in own.token_byte_values():
            size[own.encode_single_token(t)] = len(t)
        for texts in (part for b in batches for part in slabs(b)):
            out = []
            for text in texts.to_pylist():
                tokens = np.array(own.encode_ordinary(text or ""), np.int32)
                out.append((tokens[:cap], labels_of(text or "", tokens, size[tokens])[:cap], len(tokens)))
            yield pa.StructArray.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*out), kind)], fields=list(kind))

    return rows.withColumn("_t", run("text")).select("*", "_t.*").drop("_t")


def over_cap(n_tokens: Column, cap: int = 8192) -> Column:
    return n_tokens > cap
