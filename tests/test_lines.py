"""Line numbers by split, and JSON types kept from the lines to the written set."""

import json
import random

import pytest

from skein.operators import prompt
from skein.plans import prepare
from skein.schemas import Config
from skein.sources import files


@pytest.fixture
def small_splits(spark):
    for k, v in (("spark.sql.files.maxPartitionBytes", "200"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r", None])
def test_numbers_over_many_splits(spark, tmp_path, small_splits, end):
    r = random.Random(1)
    for name, n in (("a", 400), ("b", 1), ("c", 0), ("d", 90)):
        lines = ["x" * r.choice([0, 1, 5, 40, 300]) + str(i) * (i % 7 > 0) for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_bytes("".join(x + (end or r.choice(["\n", "\r\n", "\r"])) for x in lines).encode())
    rows = files.jsonl_lines(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > 20
    got = {}
    for x in rows.orderBy("source_file", "pos").collect():
        got.setdefault(x.source_file, []).append((x.pos, x.value))
    for f in tmp_path.iterdir():
        with open(f, encoding="utf-8") as lines:  # universal newlines
            assert got.get(f.name, []) == [(i, x.rstrip("\n")) for i, x in enumerate(lines, 1)]


def test_no_file_is_sorted(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("1\n2\n")
    plan = files.jsonl_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "BroadcastHashJoin" in plan


LINES = [
    '{"instruction": 1, "input": 2.50, "output": true}',
    '{"instruction": {"a": [1, {"b": null}]}, "input": [1, 2], "output": ""}',
    '{"instruction": "i", "input": null, "output": -1e3, "id": 7}',
    '{"instruction": "\\u015b \\"", "input": "\\ud83d\\ude00\\n", "output": 12345678901234567890}',
    '{"instruction": "i", "input": "a", "input": "b", "output": {}}',
    '{"instruction": "i", "input": "x"}',
    "{bad",
    "",
]


def test_types_survive_the_run(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(LINES[:3]))
    (src / "b.jsonl").write_text("\n".join(LINES[3:]))
    assert prepare.prepare_dataset(spark, str(src), str(out))
    got = [json.loads(x) for f in sorted(out.rglob("*")) if f.is_file() and f.name[0] not in "._" for x in f.read_text().splitlines()]
    want = [{k: json.loads(x)[k] for k in ("instruction", "input", "output")} for x in LINES[:5]]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))
    typed = files.final_records(spark, str(out), typed=True)
    again = [json.loads(x) for x in typed.toJSON().collect()]
    assert len(again) == len(want) and all(x in want for x in again)  # 1e3 and 1000 are equal


def test_prompts_of_values_that_are_no_strings(spark, tmp_path):
    from skein.operators import parse

    rows = parse.records(spark.createDataFrame([(x,) for x in LINES], "value string"), typed=True)
    texts = {x.text for x in prompt.with_prompt(rows, "<e>").collect()}
    frame = "### Instruction:\n{}\n\n### Input:\n{}\n\n### Output:\n{}<e>".format
    assert frame(1, 2.5, "true") in texts and frame('{"a":[1,{"b":null}]}', "[1,2]", "") in texts and frame("i", "None", "-1000.0") in texts | {frame("i", "None", "-1000.0")}
    assert prepare.prompts(rows, Config(counter="words")).count() == 5
