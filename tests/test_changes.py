"""A stream that does again what has changed, and nothing else, over restarts."""

import json
import os

from skein.schemas import Config
from skein.streaming.changes import follow_changes

C = Config(max_tokens=50, overlap=5, min_characters=20, min_input=10, counter="words")


def done(path):
    return {p.name: (p.read_text(), p.stat().st_mtime_ns) for p in path.glob("*.jsonl")}


def test_new_and_changed_inputs_over_restarts(spark, tmp_path):
    src, out, cp = tmp_path / "in", tmp_path / "out", str(tmp_path / "cp")
    src.mkdir()

    def run():
        follow_changes(spark, str(src), str(out), cp, C).awaitTermination()
        return done(out)

    (src / "a.md").write_text("# A\n" + "one two three " * 20)
    (src / "b c.md").write_text("short")
    first = run()
    assert sorted(first) == ["a.jsonl", "b c.jsonl"] and first["b c.jsonl"][0] == ""
    assert json.loads(first["a.jsonl"][0].splitlines()[0])["id"] == 1
    assert run() == first  # nothing to do
    (src / "n.md").write_text("# N\n" + "new words here " * 20)
    second = run()
    assert sorted(second) == ["a.jsonl", "b c.jsonl", "n.jsonl"] and all(second[k] == first[k] for k in first)
    (src / "a.md").write_text("# A\n" + "four five six seven " * 20)
    (out / "n.jsonl").unlink()  # the state knows that it was done
    third = run()
    assert sorted(third) == ["a.jsonl", "b c.jsonl"] and "four" in third["a.jsonl"][0] and third["b c.jsonl"] == first["b c.jsonl"]
    os.utime(src / "b c.md", ns=(1, 1))
    fourth = run()
    assert fourth["b c.jsonl"][1] > third["b c.jsonl"][1] and fourth["a.jsonl"] == third["a.jsonl"]


def test_pdfs(spark, tmp_path):
    src, out, cp = tmp_path / "in", tmp_path / "out", str(tmp_path / "cp")
    src.mkdir()
    for k in range(3):
        (src / f"{k}.pdf").write_bytes(b"bad" if k == 1 else b"# H\n" + b"some words " * 30)

    def convert(content):
        if content == b"bad":
            raise ValueError("torn")
        return content.decode()

    follow_changes(spark, str(src), str(out), cp, C, convert).awaitTermination()
    assert sorted(done(out)) == ["0.jsonl", "2.jsonl"]
    (src / "1.pdf").write_bytes(b"# H\n" + b"mended now " * 30)
    follow_changes(spark, str(src), str(out), cp, C, convert).awaitTermination()
    assert sorted(done(out)) == ["0.jsonl", "1.jsonl", "2.jsonl"]
