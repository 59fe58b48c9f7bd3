"""Sources, sinks, the three runs end to end, and the streams."""

import json

import pytest
from pyspark.sql import functions as F

from skein.operators import parse, prompt, records
from skein.plans import prepare
from skein.schemas import Config
from skein.sources import files, sinks
from skein.streaming import follow

GOOD = '{"instruction": "i", "input": "x", "output": "o"}'
LINES = {
    GOOD: ("i", "x", "o"),
    f"  {GOOD}  ": ("i", "x", "o"),
    '{"id": 3, "instruction": "i", "input": null, "output": "o"}': ("i", None, "o"),
    '{"instruction": 1, "input": 2.50, "output": true}': ("1", "2.5", "true"),
    '{"instruction": {"a": 1}, "input": [1, 2], "output": ""}': ('{"a":1}', "[1,2]", ""),
    '{"instruction": "i", "input": "a", "input": "b", "output": "o"}': ("i", "b", "o"),
    '{"instruction": "\\u015b", "input": "\\ud83d\\ude00", "output": "o"}': ("ś", "😀", "o"),
    **dict.fromkeys(["{bad", "", "{'instruction': 'i'}", "﻿" + GOOD, '{"instruction": "a\tb", "input": "x", "output": "o"}', GOOD + " x", GOOD + GOOD, GOOD + "," + GOOD, '{"instruction": "i", "input": "x"}', '{"Instruction": "i", "input": "x", "output": "o"}', "[1,2]", f"[{GOOD}]", '"abc"', "5", "null"]),
}


def test_lenient_lines(spark):
    rows = spark.createDataFrame([(k,) for k in LINES], "value string")
    got = {r.value: (r.instruction, r.input, r.output) if r.ok else None for r in parse.lenient(rows).collect()}
    assert got == LINES
    assert parse.records(rows).count() + parse.rejects(rows).count() == len(LINES)
    typed = parse.records(rows, typed=True).select(F.to_json(F.struct("*")).alias("j")).collect()
    assert {"instruction": 1, "input": 2.5, "output": True} in [json.loads(r.j) for r in typed]


def test_strict_lines(spark):
    ok = spark.createDataFrame([(" \x1c ",), ('{"input": "a"}',), ('{"instruction": null, "input": "b"}',)], "value string")
    assert sorted(map(tuple, parse.strict(ok).collect()), key=str) == [("", "a"), (None, "b")]
    for bad in ("{", '{"instruction": "i"}', "[]"):
        with pytest.raises(Exception, match="not a record"):
            parse.strict(spark.createDataFrame([(bad,)], "value string")).collect()


def test_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes("1\r\n2\r3\n x\n".encode())
    (tmp_path / "b.JSONL").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/c.jsonl").write_text("no")
    rows = files.jsonl_lines(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.source_file, r.pos, r.value) for r in rows] == [("a.jsonl", 1, "1"), ("a.jsonl", 2, "2"), ("a.jsonl", 3, "3"), ("a.jsonl", 4, " x")]
    assert files.jsonl_lines(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "_x.jsonl").write_text("1")
    with pytest.raises(files.HiddenFiles):
        files.jsonl_lines(spark, str(tmp_path))


def test_verdicts(spark):
    rows = [("a" * 799, None), ("a" * 800, None), ("😀" * 801, None), ("a" * 800 + "......", None), ("a" * 800 + ".......", None), ("SPIS TREŚCI" + "a" * 800, None), ("a" * 800, "Contents")]
    df = spark.createDataFrame([(c, h, None, None) for c, h in rows], "content string, h1 string, h2 string, h3 string")
    assert [r.verdict for r in records.verdicts(df).collect()] == ["short", "saved", "saved", "saved", "toc", "toc", "toc"]
    n = 200 - len("DOKUMENT SEKCJA: \n\n")
    df = spark.createDataFrame([("a" * (n - 1), None, None, None), ("a" * n, None, None, None)], "content string, h1 string, h2 string, h3 string")
    assert [r.verdict for r in records.verdicts(df, Config(min_characters=0)).collect()] == ["small", "saved"]


def test_documents_to_final_set(spark, tmp_path):
    src, out, final = tmp_path / "md", tmp_path / "out", tmp_path / "final.jsonl"
    src.mkdir()
    for n in ("one", "two"):
        (src / f"{n}.md").write_text("\n".join(f"# H{i}\n" + f"{n} word{i} " * 120 for i in range(4)) + "\n# Contents\n" + "x y " * 300)
    c = Config(max_tokens=400, overlap=20, counter="bpe50k", min_characters=300)
    report = {r.source_file: r for r in prepare.documents_to_chunks(spark, str(src), str(out), c).collect()}
    assert report["one"].n_saved > 0 and report["one"].n_toc > 0
    assert sorted(p.name for p in out.iterdir()) == ["one.jsonl", "run-report.json", "two.jsonl"]
    lines = [json.loads(x) for x in (out / "one.jsonl").read_text().splitlines()]
    assert [x["id"] for x in lines] == list(range(1, len(lines) + 1)) and list(lines[0]) == ["id", "instruction", "input", "output"]
    assert prepare.documents_to_chunks(spark, str(src), str(out), c).count() == 0  # all done
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "one.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n\nbad\n")
    with pytest.raises(Exception, match="not a record"):
        prepare.merge_folder(spark, str(flat), str(tmp_path / "m"), c)
    (flat / "one.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n\n")
    prepare.merge_folder(spark, str(flat), str(tmp_path / "m"), c)
    merged = [json.loads(x) for x in (tmp_path / "m/one-merged.jsonl").read_text().splitlines()]
    assert "\n\n".join(x["input"] for x in merged) == "\n\n".join(x["input"] for x in lines)
    assert prepare.prepare_dataset(spark, str(flat), str(final), c)
    rows = files.final_records(spark, str(final))
    assert sorted(r.input for r in rows.collect()) == sorted(x["input"] for x in lines) and final.is_file()
    assert not prepare.prepare_dataset(spark, str(tmp_path / "nowhere"), str(tmp_path / "f2"), c) and not (tmp_path / "f2").exists()
    shown = prepare.prompts(rows, c).first()
    assert shown.text.startswith("### Instruction:\n") and shown.response == c.eos and not shown.over_cap
    sinks.write_ordered(rows.withColumn("pos", F.monotonically_increasing_id()), str(tmp_path / "o"), "pos")
    assert spark.read.text(str(tmp_path / "o")).count() == rows.count()


def test_pdf_hook(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"pdf one")
    (tmp_path / "y.PDF").write_bytes(b"no")
    pdfs = files.pdf_files(spark, str(tmp_path))
    assert [tuple(r) for r in files.to_markdown(pdfs, lambda b: b.decode().upper()).collect()] == [("x.pdf", "PDF ONE", None)]
    with pytest.raises(Exception, match="pymupdf4llm"):
        files.to_markdown(pdfs).collect()


def test_finished_outputs(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("x")
    (tmp_path / "b.jsonl").write_text("")
    assert [r.stem for r in files.finished(spark, str(tmp_path)).collect()] == ["a"]
    assert files.finished(spark, str(tmp_path / "none")).count() == 0


def test_labels_of_repeated_marks(spark):
    text = "### Instruction:\na\n\n### Input:\nb\n\n### Output:\nc d### Instruction:\ne\n\n### Output:\nf"
    row = prompt.token_labels(spark.createDataFrame([(text,), (None,)], "text string"), "bpe50k").collect()[0]
    from skein.functions.tokens import encoding

    assert encoding("bpe50k").decode([x for x in row.labels if x >= 0]) == "c df"
    assert encoding("bpe50k").decode(row.tokens) == text and len(row.tokens) == row.n_tokens


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(2):
        (src / f"f{i}.jsonl").write_text(GOOD + "\nbad\n")
        follow.follow_records(spark, str(src), out, cp).awaitTermination()
        assert files.final_records(spark, out).count() == i + 1
    (src / "f0.jsonl").unlink()
    (src / "f1.jsonl").write_text("\n".join(json.dumps({"input": f"w{i}"}) for i in range(5)))
    follow.follow_packing(spark, str(src), str(tmp_path / "p"), str(tmp_path / "cp2"), Config(max_tokens=2, counter="words")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "p")).orderBy("id").collect()
    assert [r.input for r in got] == ["w0\n\nw1", "w2\n\nw3", "w4"]


def test_outputs_are_replaced_and_empty_ones_written(spark, tmp_path):
    from skein.schemas import Config

    src, out = tmp_path / "md", str(tmp_path / "out")
    src.mkdir()
    (src / "a.md").write_text("# H\n" + "word " * 400)
    (src / "b.md").write_text("short")
    c = Config(skip_existing=False, counter="words")
    for _ in range(2):
        prepare.documents_to_chunks(spark, str(src), out, c)
        rows = spark.read.text(f"{out}/*.jsonl").collect()
        assert [json.loads(r.value)["id"] for r in rows] == [1]
    assert (tmp_path / "out" / "b.jsonl").read_text() == ""
    (src / "a.md").write_text("now short")
    prepare.documents_to_chunks(spark, str(src), out, c)
    assert spark.read.text(f"{out}/*.jsonl").count() == 0


def test_merged_output_of_an_input_without_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"instruction": "i", "input": "x y", "output": ""}\n')
    (tmp_path / "b c.jsonl").write_text("\n")
    prepare.merge_folder(spark, str(tmp_path), str(tmp_path / "m"))
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == ["a-merged.jsonl", "b c-merged.jsonl"]
    assert spark.read.text(str(tmp_path / "m")).count() == 1


def test_bad_bytes_lines_and_missing_folders(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"input": "\xff"}\n')
    with pytest.raises(Exception, match="UTF"):
        files.jsonl_lines(spark, str(tmp_path)).collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.json").write_text('{"instruction": "i", "input": "x", "output": "o"}\nbad\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.final_records(spark, str(tmp_path / "d")).collect()
    assert files.markdown_files(spark, str(tmp_path / "none")).count() == files.pdf_files(spark, str(tmp_path / "none")).count() == 0


def test_names_are_as_written(spark, tmp_path):
    odd = ["a b.jsonl", "a+b.jsonl", "50%.jsonl", "ż%20.jsonl", "x=1&y.jsonl"]
    for n in odd:
        (tmp_path / n).write_text('{"input": "x"}\n')
        (tmp_path / n.replace(".jsonl", ".md")).write_text("x")
    assert sorted(r.source_file for r in files.jsonl_lines(spark, str(tmp_path)).collect()) == sorted(odd)
    assert sorted(r.source_file for r in files.listed(spark, str(tmp_path), "*.jsonl").collect()) == sorted(odd)
    assert sorted(r.source_file for r in files.markdown_files(spark, str(tmp_path)).collect()) == sorted(n.replace(".jsonl", ".md") for n in odd)
    prepare.merge_folder(spark, str(tmp_path), str(tmp_path / "m"), Config(counter="words"))
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == sorted(n.replace(".jsonl", "-merged.jsonl") for n in odd)
    for n in odd:
        (tmp_path / "m" / n.replace(".jsonl", "-merged.jsonl")).rename(tmp_path / "m" / n)
    assert sorted(r.stem for r in files.finished(spark, str(tmp_path / "m")).collect()) == sorted(n[:-6] for n in odd)
