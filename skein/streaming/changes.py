"""Inputs that are new or have changed, told by keyed state instead of by a look at all outputs.

A streaming source lists a folder: names, lengths and times. State by name holds what each input was like when it was
last done; only those that differ go on. The state is kept with the query's checkpoint, so a run that starts again goes
on where the last one committed, and a batch that failed is done again as a whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from skein.plans.prepare import chunk_lines
from skein.schemas import Config
from skein.sources import files, named

LISTED = "source_file string, length long, modified long"


class Lister(SimpleDataSourceStreamReader):
    """All files of a folder that end in a suffix, whenever any of them is new or has changed."""

    def __init__(self, path: str, suffix: str):
        self.path, self.suffix = path, suffix

    def listing(self) -> list[tuple[str, int, int]]:
        store, root = named.opened(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted((f.base_name, f.size, f.mtime_ns or 0) for f in found if f.type == fs.FileType.File and f.base_name.endswith(self.suffix))

    def initialOffset(self) -> dict:
        return {"listing": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = self.listing()
        end = {"listing": hashlib.sha256(json.dumps(rows).encode()).hexdigest()}
        return (iter([]), start) if end == start or not rows else (iter(rows), end)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self.listing())  # what has been done meanwhile is known to the state


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder-listing"

    def schema(self) -> str:
        return LISTED

    def simpleStreamReader(self, schema) -> Lister:
        return Lister(self.options["path"], self.options["suffix"])


class Changed(StatefulProcessor):
    """Lets through a file whose length or time isn't that of the state, and remembers it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "length long, modified long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        length, modified = max((m, n) for b in rows for n, m in zip(b["length"].tolist(), b["modified"].tolist()))[::-1]
        if not self.seen.exists() or tuple(self.seen.get()) != (length, modified):
            self.seen.update((length, modified))
            yield pd.DataFrame({"source_file": [key[0]], "length": [length], "modified": [modified]})

    def close(self) -> None:
        pass


def changed(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """A stream of (source_file, length, modified) of files that are new or have changed."""
    files.refuse_hidden(spark, folder, suffix)
    spark.dataSource.register(Listing)
    rows = spark.readStream.format("folder-listing").option("suffix", suffix).load(folder)
    return rows.groupBy("source_file").transformWithStateInPandas(Changed(), LISTED, "Append", "None")


def follow_changes(spark: SparkSession, folder: str, out: str, checkpoint: str, c: Config = Config(), convert: Callable[[bytes], str] | None = None) -> StreamingQuery:
    """The Markdown files of a folder, or its PDFs if a converter is given, that are new or have changed since the last run
    to ``<stem>.jsonl`` files in ``out``, each replaced as a whole. Outputs of other inputs aren't looked at."""
    suffix = ".pdf" if convert else ".md"

    def write(batch: DataFrame, n: int) -> None:
        own = batch.sparkSession
        names = [r.source_file for r in batch.select("source_file").collect()]  # those to be done now
        if not names:
            return
        paths = [f"{folder.rstrip('/')}/{x}" for x in names]
        if convert:
            found = own.read.format("binaryFile").load(paths).select(files.file_name(), "content")
            docs = files.to_markdown(found, convert)
        else:
            found = own.read.text(paths, wholetext=True).select(files.file_name(), F.col("value").alias("md"))
            docs = found
        named.write(chunk_lines(docs, found, c), out, "at", report=True)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return changed(spark, folder, suffix).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)
