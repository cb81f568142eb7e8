"""A table of hashed buckets under a log of versions: readers stay on theirs, of two writers one loses."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has committed since the version that a commit builds on."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    buckets: dict[int, str]
    facts: dict = field(default_factory=dict)


class Table:
    """Rows of one table, in `buckets` buckets by the hash of `key`.

    A commit writes the changed buckets' files first, in a folder of their own, then one log entry that names the folder
    of every bucket. The entry's name is its version; it is made whole under another name and then linked or renamed,
    which fails if the version is there already. So a reader sees all of a commit or nothing, files of a version never
    change, and what a killed writer leaves is in no entry. On stores other than local ones and those whose rename
    is atomic and refuses an existing target (HDFS) commits must be kept apart by other means.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _at(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path, fs = self._at(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_log") if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int) -> Version:
        text = self.spark.read.text(f"{self.path}/_log/{number:020d}.json", wholetext=True).first()[0]
        entry = json.loads(text)
        return Version(number, entry["schema"], {int(k): v for k, v in entry["buckets"].items()}, entry["facts"])

    def head(self) -> Version | None:
        numbers = self.versions()
        return self.version(numbers[-1]) if numbers else None

    def read(self, version: Version, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets: other buckets' files aren't opened."""
        folders = [f"{self.path}/data/{f}/bucket={b}" for b, f in sorted(version.buckets.items()) if buckets is None or b in buckets]
        schema = T.StructType.fromJson(json.loads(version.schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame) -> str:
        """Lands the rows' files; no reader sees them before commit() names their folder."""
        folder = uuid.uuid4().hex
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        return folder

    def commit(self, rows: DataFrame, base: Version | None, touched: list[int] | None = None, **facts) -> Version:
        """The version after base: the touched buckets (all, unless given) hold the rows, the others what they did.

        Columns keep the order and types of rows; facts go into the entry, base's others stay. Raises Conflict if base is no longer the last version.
        """
        folder = self.write(rows)
        kept = {} if base is None or touched is None else {b: f for b, f in base.buckets.items() if b not in set(touched)}
        written = {int(n[7:]): folder for n in self._names("data", folder) if n.startswith("bucket=")}
        if touched is not None and set(written) - set(touched):
            raise ValueError("rows lie in buckets that aren't touched")
        after = Version(base.number + 1 if base else 1, rows.schema.json(), kept | written, (base.facts if base else {}) | facts)
        self._publish(after)
        return after

    def _publish(self, after: Version) -> None:
        name = f"{after.number:020d}.json"
        target, fs = self._at("_log", name)
        part, _ = self._at("_log", f".{name}.{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(json.dumps({"schema": after.schema, "buckets": after.buckets, "facts": after.facts}).encode())
        out.close()
        try:
            if fs.getScheme() == "file":
                try:
                    os.link(part.toUri().getPath(), target.toUri().getPath())
                except FileExistsError:
                    raise Conflict(f"version {after.number} of {self.path} is there already") from None
            elif not fs.rename(part, target):
                raise Conflict(f"version {after.number} of {self.path} is there already")
        finally:
            fs.delete(part, False)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes what none of the last `keep` versions names. Not while a writer is between its files and its commit."""
        numbers = self.versions()
        last = [self.version(n) for n in numbers[-keep:]]
        used = {f for v in last for f in v.buckets.values()}
        for folder in set(self._names("data")) - used:
            path, fs = self._at("data", folder)
            fs.delete(path, True)
        for number in numbers[:-keep]:
            path, fs = self._at("_log", f"{number:020d}.json")
            fs.delete(path, False)
