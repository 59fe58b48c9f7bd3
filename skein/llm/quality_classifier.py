"""Operator 2, quality classifier: supervised subword embeddings.

Every whitespace word contributes its own hashed vector and those of its character n-grams, and every pair of
neighbouring words a hashed vector of theirs; a document is the average of all of them, a softmax layer maps the average
to two classes. Vectors and layer are learned together by stochastic gradient descent in numpy, inside one Spark task,
from a bounded sample of labelled documents. Scoring reads every whole text on the executors.

Because the layer is linear, a feature's share of the score is one number, and a word's is the sum of those of its
features, which a worker computes once per distinct word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import stretches, table

#: Words a worker remembers before it starts afresh; documents and characters it splits at once.
CACHE_WORDS, DOCS_AT_ONCE, CHARS_AT_ONCE = 1 << 17, 64, 1 << 21


@dataclass(frozen=True)
class Params:
    #: Of words and character n-grams; as many are of word pairs.
    buckets: int = 1 << 17
    dim: int = 12
    min_n: int = 2
    max_n: int = 4
    epochs: int = 6
    #: Few documents are gone through more often, for so many steps at least.
    steps: int = 16_384
    rate: float = 0.05
    seed: int = 17
    #: Bounds on the labelled documents that the model is fitted on, drawn by a hash of the id, and on their characters.
    max_train: int = 4096
    max_chars: int = 64_000_000
    threshold: float = 0.7


def features(words: list[bytes], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``words``, bucket) of each word and of each of its character n-grams, boundaries marked."""
    marked = [f"<{w.decode('utf-8', 'surrogatepass')}>" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(words)), np.fromiter(map(len, marked), np.int64, len(words)))
    places, buckets, h = [np.arange(len(words))], [np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % p.buckets], chars
    for n in range(2, p.max_n + 1):
        h = h[:-1] * np.uint32(0x9E3779B1) + chars[n - 1 :]  # of the n characters from here on
        if n >= p.min_n:
            inside = of[: len(h)] == of[n - 1 :]
            x = h[inside] ^ np.uint32(n)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            places.append(of[: len(h)][inside])
            buckets.append(((x ^ (x >> np.uint32(13))) % np.uint32(p.buckets)).astype(np.int64))
    return np.concatenate(places), np.concatenate(buckets)


def pairs(hashes: np.ndarray, p: Params) -> np.ndarray:
    """Bucket of each pair of neighbouring words, from the words' hashes."""
    x = hashes[:-1] * np.uint32(0x9E3779B1) + hashes[1:]
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return p.buckets + ((x ^ (x >> np.uint32(13))) % np.uint32(p.buckets)).astype(np.int64)


class Vocabulary:
    """Numbers of the words met so far, with their hashes and, from ``values_of``, further columns by number."""

    def __init__(self, values_of):
        self.number: dict[bytes, int] = {}
        self.hashes, self.columns, self.values_of = np.empty(0, np.uint32), None, values_of

    def of(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        """The numbers of each document's words. They hold until the next call."""
        new = list(set().union(*docs) - self.number.keys())
        if len(self.number) + len(new) > CACHE_WORDS and self.number:
            self.number, self.hashes, self.columns = {}, self.hashes[:0], None
            return self.of(docs)
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(zlib.crc32, new), np.uint32, len(new))])
            more = self.values_of(new)
            self.columns = more if self.columns is None else [np.concatenate(x) for x in zip(self.columns, more)]
        return [np.fromiter(map(self.number.__getitem__, d), np.int64, len(d)) for d in docs]


def doc_words(texts: list[str | None]) -> list[list[bytes]]:
    return [[w for piece in stretches(t) for w in piece.split()] for t in texts]


def fit(texts: list[str | None], classes: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket vectors, layer and bias after ``epochs`` passes of SGD with a linearly falling rate.

    The classes weigh alike, however unequal their numbers."""
    docs = []
    for at in range(0, len(texts), DOCS_AT_ONCE):
        own = doc_words(texts[at : at + DOCS_AT_ONCE])
        known = sorted(set().union(*own))
        number = dict(zip(known, range(len(known))))
        place, bucket = features(known, p)
        order = np.argsort(place, kind="stable")
        each = np.split(bucket[order], np.searchsorted(place[order], np.arange(1, len(known)))) if known else []
        for ws in own:
            h = np.fromiter(map(zlib.crc32, ws), np.uint32, len(ws))
            ids = np.concatenate([np.empty(0, np.int64), *(each[number[w]] for w in ws), pairs(h, p) if len(h) else h.astype(np.int64)])
            b, n = np.unique(ids, return_counts=True)
            docs.append((b.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1 / p.dim, 1 / p.dim, (2 * p.buckets, p.dim)).astype(np.float32)
    layer, bias = np.zeros((2, p.dim), np.float32), np.zeros(2, np.float32)
    per = np.bincount(classes, minlength=2)
    weight = len(classes) / (2 * np.maximum(per, 1))
    epochs = max(p.epochs, -(-p.steps // max(1, len(docs))))
    steps, done = max(1, epochs * len(docs)), 0
    for _ in range(epochs if docs else 0):
        for i in rng.permutation(len(docs)):
            (at, share), c = docs[i], classes[i]
            mean = share @ vectors[at]
            z = layer @ mean + bias
            e = np.exp(z - z.max())
            g = e / e.sum()
            g[c] -= 1
            g *= p.rate * (1 - done / steps) * weight[c]
            back = g @ layer
            layer -= np.outer(g, mean)
            bias -= 0.1 * g
            # fastText's scale: every input gets the whole gradient of the average, so a share of it counts n times
            vectors[at] -= np.outer(share * min(len(at), 200), back)
            done += 1
    return vectors, layer, bias


def train(labelled: DataFrame, p: Params) -> tuple[np.ndarray, float]:
    """Fit on at most ``p.max_train`` rows of (doc_id, text, quality), of ``p.max_chars`` characters together. What
    returns is each bucket's share of the score and the bias, of a fixed size."""
    sample = labelled.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)")
    sample = sample.orderBy(F.xxhash64("doc_id", F.lit(p.seed)), "doc_id", "quality", F.xxhash64("text")).limit(p.max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, classes, chars = [], [], 0
        for b in batches:
            for t, q in zip(b.column("text"), b.column("quality")):
                text = t.as_py() or ""
                if chars + len(text) <= p.max_chars:  # one that is too long is left out alone
                    chars += len(text)
                    texts.append(text)
                    classes.append(q.as_py())
        vectors, layer, bias = fit(texts, np.array(classes, np.int64), p)
        pull = vectors.astype(np.float64) @ (layer[1] - layer[0]).astype(np.float64)
        yield pa.RecordBatch.from_pydict({"pull": [pull.tobytes()], "base": [float(bias[1] - bias[0])]})

    row = sample.coalesce(1).mapInArrow(run, "pull binary, base double").collect()
    return (np.frombuffer(row[0].pull, np.float64), row[0].base) if row else (np.zeros(2 * p.buckets), 0.0)


def scorer(df: DataFrame, model: tuple[np.ndarray, float], p: Params):
    """An Arrow UDF text -> probability of class 1."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # 16 bytes a bucket, whatever the corpus
    state: dict = {}

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        pull, base = sent.value
        if not state:

            def values(new: list[bytes]) -> list[np.ndarray]:
                place, at = features(new, p)
                return [np.bincount(place, pull[at], len(new)), np.bincount(place, None, len(new))]

            state["known"] = Vocabulary(values)
        known, out, held, chars = state["known"], [], [], 0

        def flush() -> None:
            for ids in known.of(doc_words(held)):
                z = base
                if len(ids):
                    total = known.columns[0][ids].sum() + pull[pairs(known.hashes[ids], p)].sum()
                    z += total / (known.columns[1][ids].sum() + len(ids) - 1)
                out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            held.clear()

        for t in texts:
            held.append(t.as_py())
            chars += len(held[-1] or "")
            if len(held) >= DOCS_AT_ONCE or chars >= CHARS_AT_ONCE:
                flush()
                chars = 0
        flush()
        return pa.array(out, pa.float64())

    return score


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` (its own columns kept, whatever else they are) with held_out, score and predicted.

    A null or empty text gets the score of the bias; a null doc_id is never a training row and is not held out. Labels
    that are null or other than 0 and 1 are passed over; of several labels of one document each counts. With no
    labelled row the score is 0.5. Columns of these three names are replaced. Only ``text`` decides a score."""
    marks = labels.select("doc_id", "quality").filter(~held_out(F.col("doc_id"))).filter("quality in (0, 1)")
    there = marks.join(docs.select("doc_id"), "doc_id", "left_semi")  # labels without a document take no place in the sample
    chosen = there.orderBy(F.xxhash64("doc_id", F.lit(p.seed)), "doc_id", "quality").limit(p.max_train)
    model = train(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), p)  # max_train rows at most
    score = scorer(docs, model, p)
    out = docs.drop("score", "predicted", "held_out").withColumn("score", score(F.col("text")))
    return out.withColumns({"held_out": F.coalesce(held_out(F.col("doc_id")), F.lit(False)), "predicted": (F.col("score") >= p.threshold).cast("int")})


def op2(spark, sf_dir: str) -> DataFrame:
    out = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")
