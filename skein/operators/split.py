"""Recursive token splitting: sections into overlapping chunks of bounded token count."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skein.functions.tokens import measure, slabs

Measure = Callable[[list[str]], list[int]]
SEPARATORS = ("\n\n", "\n", " ", "")


def parts(text: str, separator: str) -> list[str]:
    """The text cut before each separator; into characters by the empty one."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [x for x in (head, *(separator + r for r in rest)) if x]


def windows(pieces: list[tuple[str, int]], size: int, overlap: int) -> Iterator[str]:
    """Greedy runs of pieces of at most ``size`` tokens; a run starts with the last pieces of the one before, up to
    ``overlap`` tokens. Stripped; empty ones are left out."""
    held, total = deque(), 0
    for text, n in pieces:
        if total + n > size and held:
            yield "".join(t for t, _ in held).strip()
            while total > overlap or (total > 0 and total + n > size):
                total -= held.popleft()[1]
        held.append((text, n))
        total += n
    yield "".join(t for t, _ in held).strip()


def split_text(text: str, size: int, overlap: int, count: Measure, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks in order. The first separator that occurs cuts the text; what is still too long is cut by later ones."""
    k = next(i for i, s in enumerate(separators) if not s or s in text)
    out, run = [], []

    def flush() -> None:
        if run:
            out.extend(c for c in windows(run, size, overlap) if c)
            run.clear()

    pieces = parts(text, separators[k])
    for piece, n in zip(pieces, count(pieces)):
        if n < size:
            run.append((piece, n))
            continue
        flush()
        rest = separators[k + 1 :]
        out += split_text(piece, size, overlap, count, rest) if rest else [piece]
    flush()
    return out


def token_split(sections: DataFrame, size: int = 6000, overlap: int = 300, counter: str = "bpe_multi50k") -> DataFrame:
    """Rows of ``sections`` with ``content`` replaced by a chunk each, and chunk_pos from 0 within a section.

    All other columns are copied. A section of null or blank content gives no chunk."""
    schema = T.StructType([*sections.schema.fields, T.StructField("chunk_pos", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = measure(counter)
        for b in batches:
            k, at = b.schema.get_field_index("content"), 0
            for texts in slabs(b.column(k)):
                cut = [split_text(t, size, overlap, count) if t else [] for t in texts.to_pylist()]
                row = pa.array(at + np.repeat(np.arange(len(cut)), [len(c) for c in cut]))
                content, pos = pa.array([x for c in cut for x in c], texts.type), pa.array([n for c in cut for n in range(len(c))], pa.int64())
                columns = [content if i == k else column.take(row) for i, column in enumerate(b.columns)]
                yield pa.RecordBatch.from_arrays([*columns, pos], names=[*b.schema.names, "chunk_pos"])
                at += len(texts)

    return sections.mapInArrow(run, schema)
