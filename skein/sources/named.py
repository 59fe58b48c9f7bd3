"""Named JSON-lines files, as a Spark data source: one file a name, however many or few rows that name has.

    spark.dataSource.register(NamedFiles)
    rows.write.format("named-jsonl").mode("append").save(folder)

Spark's own writers make a folder of part files of each source. This one writes ``<folder>/<name>`` itself. Tasks write
to a folder of their attempt beside the results; the job's commit moves what the successful attempts wrote into place,
each file as a whole, and an abort takes it all away. So a lost executor or a failed job leaves files as they were.

Rows are (name, verdict, value) and lie by name: all of one in one task, in order (``arranged``). A row with a value is a
line; any row makes its name's file, if only an empty one, unless the name has a row of verdict ``failed``. Verdicts are
counted by name while the lines are written, and the commit adds ``run-report.json``: no second pass counts them.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

REPORT = "run-report.json"
#: Verdict of a row that says why its name has no output.
FAILED = "failed"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it: local paths, and URIs that pyarrow knows (file, s3, gs, hdfs)."""
    if re.match(r"^file:/(?!/)", path):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path if re.match(r"^\w[\w+.-]+://", path) else os.path.abspath(path))


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its folder, and by name the counts of verdicts and why there is no file."""

    folder: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, report: bool, overwrite: bool):
        self.path, self.report, self.overwrite = path.rstrip("/"), report, overwrite
        self.staging = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.path)
        out = Written(f"{self.staging}/{uuid.uuid4().hex}")
        folder = f"{root}/{out.folder}"
        store.create_dir(folder, recursive=True)
        name, file = None, None
        try:
            for b in iterator:
                for key, verdict, value in zip(*(b.column(c).to_pylist() for c in ("name", "verdict", "value"))):
                    if key != name:
                        if file:
                            file.close()
                        if key in out.counts or not key or "/" in key or key == REPORT:
                            raise ValueError(f"{key!r} is no file name, or its rows don't lie together")
                        name, file = key, store.open_output_stream(f"{folder}/{key}")
                        counts = out.counts[key] = Counter()
                    if verdict is not None:
                        counts[verdict] += 1
                    if verdict == FAILED:
                        out.failed[key] = value or ""
                    elif value is not None:
                        file.write(value.encode("utf-8", "surrogatepass") + b"\n")
        finally:
            if file:
                file.close()
        return out

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        messages = [m for m in messages if m is not None]
        counts = [n for m in messages for n in m.counts]
        if len(set(counts)) < len(counts):
            self.abort(messages)
            raise ValueError("rows of one name came to several tasks")
        done = {n for m in messages for n in m.counts if n not in m.failed}
        if self.overwrite:
            old = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
            for f in old:
                if f.type == fs.FileType.File and f.base_name.endswith(".jsonl") and f.base_name not in done:
                    store.delete_file(f.path)
        for m in messages:
            for n in m.counts:
                if n in done:
                    store.move(f"{root}/{m.folder}/{n}", f"{root}/{n}")
        if self.report:
            with store.open_output_stream(f"{root}/{self.staging}/{REPORT}") as f:
                for m in messages:
                    for n, c in m.counts.items():
                        f.write(json.dumps({"name": n, "error": m.failed.get(n), **c}, ensure_ascii=False).encode() + b"\n")
            store.move(f"{root}/{self.staging}/{REPORT}", f"{root}/{REPORT}")
        store.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        if store.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staging}")


class NamedFiles(DataSource):
    """Options: the path, and ``report`` (true or false, the default). Mode ``append`` replaces the files that are written,
    ``overwrite`` takes away the folder's other ``*.jsonl`` too."""

    @classmethod
    def name(cls) -> str:
        return "named-jsonl"

    def schema(self) -> str:
        return "name string, verdict string, value string"

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("report", "false").lower() == "true", overwrite)


def arranged(rows: DataFrame, order: str) -> DataFrame:
    """(name, verdict, value) of ``rows``, all of a name in one task and in order."""
    return rows.repartition("name").sortWithinPartitions("name", order).select("name", "verdict", "value")


def write(rows: DataFrame, folder: str, order: str, mode: str = "append", report: bool = False) -> None:
    rows.sparkSession.dataSource.register(NamedFiles)
    arranged(rows, order).write.format("named-jsonl").mode(mode).option("report", str(report).lower()).save(folder)
