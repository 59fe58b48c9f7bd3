"""Header sections against a plain fold over lines."""

import random

from skein.operators.sections import header_sections, section_rows
from skein.plans import prepare
from skein.schemas import Config
from skein.streaming import follow


def fold(md: str) -> list[tuple]:
    """Sections by reading one line after another."""
    heads, blocks, block, fence, out = {}, [], [], None, []

    def close():
        nonlocal block
        if block:
            blocks.append((tuple(heads.get(k) for k in (1, 2, 3)), "\n".join(block)))
        block = []

    for raw in md.split("\n"):
        x = "".join(c for c in raw.strip() if c.isprintable())
        if fence is None and ((x.startswith("```") and x.count("```") == 1) or x.startswith("~~~")):
            fence = x[:3]
        elif fence and x.startswith(fence):
            fence = None
        if fence:
            block.append(x)
            continue
        lv = next((k for k in (3, 2, 1) if x.startswith("#" * k) and (len(x) == k or x[k] == " ")), 0)
        if lv:
            close()
            heads = {k: v for k, v in heads.items() if k < lv} | {lv: x[lv:].strip()}
        elif x:
            block.append(x)
        else:
            close()
    close()
    for h, text in blocks:
        if out and out[-1][0] == h:
            out[-1] = (h, out[-1][1] + "  \n" + text)
        else:
            out.append((h, text))
    return [(i, *h, text) for i, (h, text) in enumerate(out)]


def run(spark, texts: dict[str, str]) -> dict[str, list[tuple]]:
    rows = header_sections(spark.createDataFrame(list(texts.items()), "source_file string, md string")).collect()
    out = {k: [] for k in texts}
    for r in sorted(rows, key=lambda r: r.sec_pos):
        out[r.source_file].append((r.sec_pos, r.h1, r.h2, r.h3, r.content))
    return out


def test_edges(spark):
    texts = {
        "plain": "before\n# A\nbody",
        "skipped level": "# A\n### C\nx\n## B\ny\n# D\nz",
        "deeper": "# A\n#### no\n#no\n#",
        "empty header": "###\nx\n## \ny",
        "adjacent equal": "## B\nx\n\ny\n## B\nz",
        "fence": "# A\n```py\n# no\n\n  code\n```\n## B\nx",
        "tilde": "~~~\n# no\n```\n~~~\n# Yes\nx",
        "one line fence": "```a```\n# H\nx",
        "open fence": "# A\n```\n# no",
        "white": " # A\t\nx\ty​ \n \nz",
        "nothing": "# A\n\n## B",
        "blank": "",
    }
    got = run(spark, texts)
    assert got == {k: fold(v) for k, v in texts.items()}


def test_random_documents(spark):
    rng = random.Random(7)
    line = lambda: rng.choice(["# A", "## B", "### C", "# B", "## ", "###", "#### D", "x", "y z", "", "", "  ", "```", "~~~", "```py", "#no"])
    texts = {str(i): "\n".join(line() for _ in range(rng.randint(0, 14))) for i in range(300)}
    assert run(spark, texts) == {k: fold(v) for k, v in texts.items()}


def test_document_at_a_time_equals_windows(spark):
    r = random.Random(5)
    bits = ["# A", "## B", "### C", "#", "##", "#### d", "text", " x\ty ", "", "\x1c", "```", "~~~", "```py", "``` a ```", "﻿z", "# A b\x07c"]
    texts = {f"f{i}": "\n".join(r.choice(bits) for _ in range(r.randint(0, 25))) for i in range(300)}
    docs = spark.createDataFrame([*texts.items(), ("none", None)], "source_file string, md string")
    want = run(spark, texts)
    assert sum(map(len, want.values())) > 500
    got = {k: [] for k in texts}
    for x in section_rows(docs).orderBy("sec_pos").collect():
        got[x.source_file].append((x.sec_pos, x.h1, x.h2, x.h3, x.content))
    assert got == want


def test_documents_in_a_stream(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    src.mkdir()
    c = Config(max_tokens=30, overlap=5, min_characters=20, counter="words", min_input=10)
    texts = {}
    for n in range(2):
        texts[f"f{n}.md"] = "\n".join(f"# H{i}\n## S\n" + f"word{n} " * 20 * i for i in range(5))
        (src / f"f{n}.md").write_text(texts[f"f{n}.md"])
        follow.follow_documents(spark, str(src), out, cp, c).awaitTermination()
        docs = spark.createDataFrame(list(texts.items()), "source_file string, md string")
        cols = ["source_file", "sec_pos", "chunk_pos", "input"]
        want = prepare.judged_chunks(docs, c).filter("verdict = 'saved'").select(cols).collect()
        assert sorted(map(tuple, spark.read.parquet(out).select(cols).collect())) == sorted(map(tuple, want)) != []
