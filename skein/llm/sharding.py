"""Operator 3, sharding by size-tiered compaction.

Arrivals are appended as runs of small immutable Parquet shards. When enough runs of like size have come together they
are merged into one run of target-sized shards, so a row is rewritten once a tier and not once an arrival. What is live
is said by a manifest: a numbered JSON file that is written aside and renamed into place, which fails if another writer
was first. Readers see one version or the next, never a half of either. Files of replaced versions stay for an hour, so
that readers that have begun with one can end; then they are deleted. A rename that fails if its target exists is what
HDFS-like stores and local disks offer; plain object stores need a committer of their own.

Spark reads and writes all data; a merge reads its shards and coalesces them, without a shuffle. The driver handles
names and sizes of shards alone.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import scratch, table

ARRIVAL = "arrival_of_shard"


@dataclass(frozen=True)
class Params:
    #: Bytes of a merged shard.
    target: int = 128 << 20
    #: Runs of like size that are merged together.
    fanout: int = 4
    #: Like size: the larger is at most so many times the smaller.
    ratio: float = 2.0
    #: Runs below are of like size whatever they are.
    small: int = 1 << 20
    #: Versions whose files are kept, the current one included; and the seconds for which those of older ones stay.
    versions: int = 1
    keep_seconds: float = 3600
    compression: str = "zstd"


class Conflict(RuntimeError):
    """Another writer has committed the version that was to come next."""


class ShardStore:
    """A table of immutable shards under ``root``, which may be in any store that Hadoop's file systems reach."""

    def __init__(self, spark: SparkSession, root: str, p: Params = Params()):
        self.spark, self.root, self.p = spark, root.rstrip("/"), p
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._fs.Path(name)

    def _list(self, folder: str) -> list[tuple[str, int]]:
        path = self._path(folder)
        fs = path.getFileSystem(self._conf)
        return [(f.getPath().toString(), f.getLen()) for f in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, name: str) -> None:
        path = self._path(name)
        path.getFileSystem(self._conf).delete(path, True)

    # versions

    def versions(self) -> list[int]:
        names = (n.rsplit("/", 1)[-1] for n, _ in self._list(f"{self.root}/manifest"))
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, runs: [{id, shards: [[path, bytes], ...]}, ...]}; version 0 is the empty store."""
        known = self.versions()
        version = version if version is not None else known[-1] if known else 0
        if not version:
            return {"version": 0, "schema": None, "runs": []}
        path = self._path(f"{self.root}/manifest/v{version:09d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, before: dict, runs: list[dict], schema: str) -> dict:
        """The next version after ``before``, all or nothing."""
        after = {"version": before["version"] + 1, "schema": schema, "runs": runs}
        to = self._path(f"{self.root}/manifest/v{after['version']:09d}.json")
        aside = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}")
        fs = to.getFileSystem(self._conf)
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(after).encode()))
        stream.close()
        try:
            if fs.exists(to):
                raise Conflict(f"version {after['version']} exists")
            mode = self.spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 1)
            mode[0] = getattr(self._fs.Options.Rename, "NONE")
            self._fs.FileContext.getFileContext(aside.toUri(), self._conf).rename(fs.makeQualified(aside), fs.makeQualified(to), mode)
        except Exception as e:
            fs.delete(aside, False)
            if isinstance(e, Conflict) or "FileAlreadyExists" in str(e):
                raise Conflict(f"version {after['version']} exists") from e
            raise
        return after

    # data

    def _run(self, folder: str) -> dict:
        return {"id": folder.rsplit("/", 1)[-1], "shards": sorted([n, b] for n, b in self._list(folder) if n.endswith(".parquet"))}

    def append(self, arrival: DataFrame) -> dict:
        """One arrival, as it is partitioned; a shard a partition."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        arrival.write.option("compression", self.p.compression).parquet(folder)
        before = self.manifest()
        try:
            return self.commit(before, [*before["runs"], self._run(folder)], before["schema"] or arrival.schema.json())
        except Conflict:
            self._delete(folder)  # no version names it
            raise

    def append_each(self, rows: DataFrame, arrival: Column) -> list[dict]:
        """The arrivals that a column numbers, written by one job; a version for each, in order, compacted in between. A lost
        race leaves those that were committed, and takes the others' files away."""
        folder, out = f"{self.root}/data/{uuid.uuid4().hex}", []
        marked = rows.withColumn(ARRIVAL, arrival)
        marked.write.option("compression", self.p.compression).partitionBy(ARRIVAL).parquet(folder)
        parts = [n for n, _ in self._list(folder) if f"{ARRIVAL}=" in n]
        schema = rows.schema.json()
        if not parts:
            before = self.manifest()
            return [self.commit(before, before["runs"], before["schema"] or schema)]
        order = lambda n: (len(n), n)  # noqa: E731  numbers in order
        for part in sorted(parts, key=order):
            before = self.manifest()
            try:
                out.append(self.commit(before, [*before["runs"], self._run(part)], before["schema"] or schema))
            except Conflict:
                for n in sorted(parts, key=order)[len(out) :] if out else [folder]:
                    self._delete(n)  # no version names it
                raise
            self.compact()
        return out

    def due(self, runs: list[dict]) -> list[dict]:
        """Runs to merge: the smallest ``fanout`` or more of like size; none if there are none."""
        size = lambda r: max(self.p.small, sum(b for _, b in r["shards"]))
        order = sorted(runs, key=size)
        for i in range(len(order)):
            like = [r for r in order[i:] if size(r) <= self.p.ratio * size(order[i])]
            if len(like) >= self.p.fanout:
                return like
        return []

    def merge(self, runs: list[dict], schema: T.StructType) -> dict:
        """The rows of some runs as one run of target-sized shards."""
        shards = [s for r in runs for s in r["shards"]]
        folder, n = f"{self.root}/data/{uuid.uuid4().hex}", max(1, math.ceil(sum(b for _, b in shards) / self.p.target))
        rows = self.spark.read.schema(schema).parquet(*(n for n, _ in shards)) if shards else self.spark.createDataFrame([], schema)
        rows.coalesce(n).write.option("compression", self.p.compression).parquet(folder)
        return self._run(folder)

    def compact(self) -> int:
        """Merge whatever is due; returns the number of merges, each a version of its own."""
        n = 0
        while due := self.due((before := self.manifest())["runs"]):
            merged = self.merge(due, T.StructType.fromJson(json.loads(before["schema"])))
            gone = {r["id"] + str(r["shards"][:1]) for r in due}
            try:
                self.commit(before, [*(r for r in before["runs"] if r["id"] + str(r["shards"][:1]) not in gone), merged], before["schema"])
            except Conflict:
                self._delete(f"{self.root}/data/{merged['id']}")
                raise
            self.expire()
            n += 1
        return n

    def expire(self) -> None:
        """Delete manifests that were replaced ``keep_seconds`` ago or more, and the shards that they alone name."""
        known = self.versions()
        path = self._path(f"{self.root}/manifest")
        fs = path.getFileSystem(self._conf)
        written = {int(n[1:-5]): f.getModificationTime() / 1000 for f in fs.listStatus(path) if (n := f.getPath().getName()).startswith("v")} if known else {}
        # a version is replaced when the next one is written
        old = [v for v, after in zip(known, known[1:]) if v not in known[-self.p.versions :] and time.time() - written[after] >= self.p.keep_seconds]
        kept = {n for v in known if v not in old for r in self.manifest(v)["runs"] for n, _ in r["shards"]} if old else set()
        for v in old:
            for n in {n for r in self.manifest(v)["runs"] for n, _ in r["shards"]} - kept:
                self._delete(n)
            self._delete(f"{self.root}/manifest/v{v:09d}.json")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the current one by default."""
        m = self.manifest(version)
        if not m["schema"]:
            raise ValueError("the store has no version yet")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        names = [n for r in m["runs"] for n, _ in r["shards"]]
        return self.spark.read.schema(schema).parquet(*names) if names else self.spark.createDataFrame([], schema)


def shard(rows: DataFrame, arrival: Column, root: str, p: Params = Params()) -> ShardStore:
    """A store at ``root`` with the rows of each arrival appended in turn and compacted.

    Every row is in exactly one live shard, with all columns, nulls and repeated rows as they are. Rows of a null
    arrival are an arrival of their own. An empty table makes a version without rows. The column name
    ``arrival_of_shard`` is taken: a column of that name, in any case, raises an error before anything is written."""
    if ARRIVAL in (c.lower() for c in rows.columns):
        raise ValueError(f"column {ARRIVAL} is taken")
    store = ShardStore(rows.sparkSession, root, p)
    store.append_each(rows, arrival)
    return store


def arrival_of(doc_id: Column, n: int) -> Column:
    """The test tables have no arrival times: a number below ``n`` by the MD5 of the id."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 6), 16, 10).cast("int") % n


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = shard(docs, arrival_of(F.col("doc_id"), 8), f"{scratch(spark)}/shards-{uuid.uuid4().hex}")
    return store.read().select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), arrival_of(F.col("doc_id"), 8).alias("arrival"))


SQL = """
select doc_id, lang, source, n_chars, md5(text) text_md5, (('0x' || substr(md5(doc_id::varchar), 1, 6))::int % 8)::int arrival
from documents
"""
