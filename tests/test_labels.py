"""Token labels against plain Python, on random texts with marks anywhere."""

import random

import pytest

from skein.functions.tokens import encoding
from skein.operators import prompt
from skein.schemas import INSTRUCTION_MARK, OUTPUT_MARK


def plain(text, counter):
    """Label by label: is the character that a token begins in part of a response?"""
    inside, on, i = [], False, 0
    while i < len(text):
        mark = INSTRUCTION_MARK if on else OUTPUT_MARK
        if text.startswith(mark, i):
            inside += [False] * len(mark)
            i, on = i + len(mark), not on
        else:
            inside.append(on)
            i += 1
    own = encoding(counter)
    tokens = own.encode_ordinary(text)
    of = [k for k, c in enumerate(text) for _ in c.encode()]  # the character of each byte
    labels, at = [], 0
    for t in tokens:
        labels.append(t if inside[of[at]] else -100)
        at += len(own.decode_single_token_bytes(t))
    return tokens, labels


def texts(n):
    r = random.Random(1)
    bits = [OUTPUT_MARK, INSTRUCTION_MARK, "### Output:", "###", " ", "\n", "\n\n", "word", " words", "é", "日本", "😀", "x1", ":\n", "O", "<|endoftext|>"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("counter", ["bpe50k", "bpe_multi50k"])
def test_equals_plain_labels(spark, counter):
    rows = spark.createDataFrame([(t,) for t in [*texts(400), "", "a" + OUTPUT_MARK, OUTPUT_MARK + "\n\n x" + INSTRUCTION_MARK + OUTPUT_MARK]], "text string")
    some = 0
    for x in prompt.token_labels(rows, counter).collect():
        tokens, labels = plain(x.text, counter)
        assert (x.tokens, x.labels, x.n_tokens) == (tokens, labels, len(tokens)), x.text
        some += any(v >= 0 for v in labels)
    assert some > 100


def test_cap_and_null(spark):
    text = OUTPUT_MARK + "one two three " * 50
    long, none = prompt.token_labels(spark.createDataFrame([(text,), (None,)], "text string"), "bpe50k", 20).collect()
    tokens, labels = plain(text, "bpe50k")
    assert (long.tokens, long.labels, long.n_tokens) == (tokens[:20], labels[:20], len(tokens))
    assert (none.tokens, none.labels, none.n_tokens) == ([], [], 0)


def test_long_batches(spark):
    """A batch of more text than a run holds; every row has its own labels."""
    texts = [("w " * (k * 20_000) + OUTPUT_MARK + f"r{k}") if k % 3 else None for k in range(12)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").coalesce(1)
    for x in prompt.token_labels(rows, "bpe50k", 1 << 30).collect():
        own = encoding("bpe50k").encode_ordinary(texts[x.k] or "")
        assert (x.tokens, x.n_tokens, len(x.labels)) == (own, len(own), len(own))
        assert [t for t in x.labels if t >= 0] == encoding("bpe50k").encode_ordinary(OUTPUT_MARK + f"r{x.k}")[len(encoding("bpe50k").encode_ordinary(OUTPUT_MARK)) :] or not texts[x.k]
