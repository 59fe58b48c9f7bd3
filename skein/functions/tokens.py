"""Token counting by name: a native word counter, and byte-pair vocabularies in Arrow batches."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: name -> file of the public_tokenizers package
VOCABULARIES = {"bpe50k": "byte_bpe_50k.tiktoken", "bpe_multi50k": "byte_bpe_multi_50k.tiktoken"}
WORD = r"[^ \n\r\t]+"
#: Texts up to so many characters are mostly words, which come again: a worker remembers the counts of so many.
SHORT, SHORT_TEXTS = 32, 1 << 17
#: Bytes of a batch's texts that a worker has as strings at a time.
SLAB = 1 << 20


@cache
def encoding(name: str):
    """A tiktoken encoding, loaded once a worker. ``cl100k_base`` needs its rank file in tiktoken's cache."""
    import tiktoken

    if name not in VOCABULARIES:
        return tiktoken.get_encoding(name)
    import public_tokenizers as files

    with open(files.path(VOCABULARIES[name]), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})


def measure(name: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts, within a worker. Special-token strings are ordinary text."""
    if name == "words":
        import re

        find = re.compile(WORD).findall
        return lambda texts: [len(find(t)) for t in texts]
    encode = encoding(name).encode_ordinary
    known = lru_cache(SHORT_TEXTS)(lambda text: len(encode(text)))
    return lambda texts: [known(t) if len(t) <= SHORT else len(encode(t)) for t in texts]


def slabs(texts: pa.Array, size: int = SLAB) -> Iterator[pa.Array]:
    """A batch cut into runs of rows of at most ``size`` bytes of text, or one row. Batches are bounded by rows: made strings
    as a whole, they take as much as the texts are long, and a worker doesn't give it back."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, to - at)
        at = to


def counts(texts: pa.Array, name: str) -> pa.Array:
    """Token counts of a batch, null for null."""
    own, out = measure(name), np.zeros(len(texts), np.int64)
    at = 0
    for run in slabs(texts):
        there = run.is_valid().to_numpy(zero_copy_only=False)
        out[at : at + len(run)][there] = own(run.drop_null().to_pylist())
        at += len(run)
    return pa.array(out, mask=texts.is_null().to_numpy(zero_copy_only=False))


def count_tokens(c: Column, name: str = "words") -> Column:
    """Number of tokens as a long; null for null."""
    if name == "words":
        return F.regexp_count(c, F.lit(WORD)).cast("long")

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return counts(texts, name)

    return count(c)
