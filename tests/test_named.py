"""Named output files: written as a whole or not at all; failures of single inputs; counts from the writing pass."""

import json

import pytest
from pyspark.sql import functions as F

from skein.plans import prepare
from skein.schemas import Config
from skein.sources import files, named

ROWS = [("b c.jsonl", "saved", "1", 1), ("b c.jsonl", "short", None, 2), ("b c.jsonl", "saved", "ś ", 3), ("a.jsonl", None, None, 0), ("bad.jsonl", "failed", "why", 0), ("bad.jsonl", None, None, 0)]


def rows(spark, data=ROWS, parts=4):
    return spark.createDataFrame(data, "name string, verdict string, value string, at int").repartition(parts)


def names(path):
    return sorted(p.name for p in path.iterdir())


def test_files_and_report(spark, tmp_path):
    out = tmp_path / "x" / "y"
    named.write(rows(spark), str(out), "at", report=True)
    assert names(out) == ["a.jsonl", "b c.jsonl", "run-report.json"]
    assert (out / "b c.jsonl").read_bytes().decode() == "1\nś \n" and (out / "a.jsonl").read_bytes() == b""
    got = {r.source_file: r for r in prepare.written_report(spark, str(out)).collect()}
    assert (got["b c"].n_chunks, got["b c"].n_saved, got["b c"].n_short) == (3, 2, 1)
    assert got["bad"].error == "why" and got["a"].n_chunks == 0 and got["a"].error is None


def test_modes(spark, tmp_path):
    named.write(rows(spark), str(tmp_path), "at")
    named.write(rows(spark, [("a.jsonl", "saved", "new", 1)]), f"file:{tmp_path}", "at")
    assert (tmp_path / "a.jsonl").read_text() == "new\n" and (tmp_path / "b c.jsonl").exists()
    named.write(rows(spark, [("n.jsonl", "saved", "new", 1)]), f"file://{tmp_path}", "at", mode="overwrite")
    assert names(tmp_path) == ["n.jsonl"]
    named.write(rows(spark, []), str(tmp_path), "at")
    assert names(tmp_path) == ["n.jsonl"]


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("old\n")
    bad = rows(spark, [("a.jsonl", "saved", str(i), i) for i in range(50)] + [("z.jsonl", "saved", "1", 1)])
    bad = bad.withColumn("value", F.when(F.col("name") == "z.jsonl", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        named.write(bad, str(tmp_path), "at")
    assert names(tmp_path) == ["a.jsonl"] and (tmp_path / "a.jsonl").read_text() == "old\n"
    for wrong in ("x/y.jsonl", "", named.REPORT):
        with pytest.raises(Exception, match="file name"):
            named.write(rows(spark, [(wrong, None, None, 0)]), str(tmp_path), "at")
    assert names(tmp_path) == ["a.jsonl"]


def test_rows_of_a_name_in_two_tasks_are_refused(spark, tmp_path):
    spark.dataSource.register(named.NamedFiles)
    two = rows(spark, [("a.jsonl", "saved", "1", 1), ("a.jsonl", "saved", "2", 2)]).repartition(2).select("name", "verdict", "value")
    with pytest.raises(Exception, match="several tasks"):
        two.write.format("named-jsonl").mode("append").save(str(tmp_path))
    assert names(tmp_path) == []


def test_a_bad_pdf_does_not_stop_the_others(spark, tmp_path):
    src, out = tmp_path / "pdf", tmp_path / "out"
    src.mkdir()
    for i in range(100):
        (src / f"d{i}.pdf").write_bytes(b"broken" if i == 37 else f"# T{i}\n".encode() + b"some words " * 100)

    def convert(content):
        if content == b"broken":
            raise ValueError("no page tree")
        return content.decode()

    texts = files.to_markdown(files.pdf_files(spark, str(src)), convert)
    assert texts.filter("md is not null and error is null").count() == 99
    assert [tuple(r) for r in texts.filter("md is null").collect()] == [("d37.pdf", None, "ValueError: no page tree")]
    c = Config(counter="words")
    report = prepare.documents_to_chunks(spark, str(src), str(out), c, convert).collect()
    assert len(report) == 100 and [(r.source_file, r.error) for r in report if r.error] == [("d37", "ValueError: no page tree")]
    assert sum(r.n_saved for r in report) == 99 and not (out / "d37.jsonl").exists() and len(list(out.glob("*.jsonl"))) == 99
    assert json.loads((out / "d5.jsonl").read_text())["input"].startswith("DOKUMENT SEKCJA: T5\n\n")
    again = prepare.documents_to_chunks(spark, str(src), str(out), c, lambda b: "# H\n" + "fine now " * 200).collect()
    assert [(r.source_file, r.error, r.n_saved) for r in again] == [("d37", None, 1)]
