"""Versions of a set of tables that become visible all at once.

Data files go to fresh folders first. A version exists from the moment its manifest does: one file, created by a
rename that fails if the name is taken. A job that dies before leaves the old version in place, a retry of a batch
that is already in finds its id in the manifest and adds nothing, and two writers cannot both take a number.
A table is a map from parts to folders, so a version may share the parts that it did not change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Parts = dict[str, str]


@dataclass(frozen=True)
class Version:
    """``tables``: folders of each table by part; ``schemas`` as JSON; ``batches``: ids of all batches that are in."""

    number: int = 0
    tables: Mapping[str, Parts] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)
    batches: tuple[str, ...] = ()


class Conflict(RuntimeError):
    """Another writer has published a version since this one was read."""


class Snapshots:
    """Reads and publishes versions below ``root``, on any file system that Spark can write."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_versions/{number:012d}.json"

    def latest(self) -> Version:
        """The newest version; number 0 without tables if there is none."""
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return Version()
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return Version()
        number = max(numbers)
        text = self.spark.read.text(self._manifest(number), wholetext=True).first()[0]
        found = json.loads(text)
        return Version(number, found["tables"], found["schemas"], tuple(found["batches"]))

    def folder(self) -> str:
        """A fresh folder for data files; nothing refers to it until a version does."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def holds(self, folder: str) -> bool:
        """Has a writer made ``folder``?"""
        return self._fs.exists(self._path(folder))

    def commit(self, after: Version, tables: Mapping[str, Parts], schemas: Mapping[str, str], batch: str | None = None) -> Version:
        """Make a version visible that follows ``after``."""
        batches = after.batches + ((batch,) if batch else ())
        new = Version(after.number + 1, {**after.tables, **tables}, {**after.schemas, **schemas}, batches)
        text = json.dumps({"tables": new.tables, "schemas": new.schemas, "batches": new.batches})
        draft = self._path(f"{self.root}/_drafts/{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self._path(self._manifest(new.number))
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Conflict(f"version {new.number} is taken")
        return new

    def publish(self, tables: Mapping[str, DataFrame], batch: str | None = None) -> Version:
        """Replace ``tables`` together; a batch id that is already in changes nothing."""
        before = self.latest()
        if batch in before.batches:
            return before
        parts, schemas = {}, {}
        for name, df in tables.items():
            path = self.folder()
            df.write.parquet(path)
            parts[name], schemas[name] = {"": path}, df.schema.json()
        return self.commit(before, parts, schemas, batch)

    def read(self, name: str, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
        """A table of a version (the newest), or some of its parts."""
        version = version or self.latest()
        schema = StructType.fromJson(json.loads(version.schemas[name]))
        folders = [p for k, p in version.tables[name].items() if parts is None or k in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def forget(self, keep: int = 1) -> None:
        """Remove manifests older than the newest ``keep`` and the folders that only they refer to; no writer may be at work."""
        folder, number = self._path(f"{self.root}/_versions"), self.latest().number
        for status in self._fs.listStatus(folder):
            name = status.getPath().getName()
            if name.endswith(".json") and int(name.removesuffix(".json")) <= number - keep:
                self._fs.delete(status.getPath(), False)
        used = set()
        for status in self._fs.listStatus(folder):
            if status.getPath().getName().endswith(".json"):
                found = json.loads(self.spark.read.text(status.getPath().toString(), wholetext=True).first()[0])
                used |= {p.removeprefix(f"{self.root}/data/").split("/")[0] for parts in found["tables"].values() for p in parts.values()}
        data = self._path(f"{self.root}/data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if status.getPath().getName() not in used:
                self._fs.delete(status.getPath(), True)
