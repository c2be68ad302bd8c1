"""A versioned result table: data files that are only ever added, and manifests that say which of them count.

Layout of a table::

    data/<commit id>/part-*.parquet     written first, never changed
    schema/columns.json                 the columns, if the table was made by ``open``
    manifests/<version>.json            the runs of a version, (name, level), oldest first, and its last commits

A commit writes its data, then the manifest of the next version by renaming a finished file to its final name, which fails if that
version exists (so the file system's rename must not replace a file; HDFS and local ones do as asked). Readers take the newest manifest, so they see a commit whole or not at all. A commit that is repeated, after a
failure or twice, finds its id in the newest manifest and does nothing; data that a failed commit left is written over.
A manifest remembers its last ``REMEMBERED`` commits, so a commit can be repeated as long as no more have followed it.

A run holds one row per key. Runs have levels: a commit is a run of level 0, and ``FAN`` neighbouring runs of a level are merged into one of the
next level, so a reader merges a number of runs that grows with the logarithm of the commits, and a row is rewritten once per level.
Only manifests, a few names each, pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.search import keep_last

#: Runs of one level that are merged into one of the next.
FAN = 8
#: Commit ids that a manifest names.
REMEMBERED = 1000


class Conflict(Exception):
    """Another writer made the version first."""


@dataclass(frozen=True)
class Run:
    commit: str
    level: int


@dataclass(frozen=True)
class Version:
    number: int
    runs: tuple[Run, ...] = ()
    done: tuple[str, ...] = ()


class ResultTable:
    """Rows by key; of rows with equal keys the one of the latest commit counts, within a commit the last by ``order_by``."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str] = ("repository", "path"),
        order_by: Sequence[str] = (), fan: int = FAN,
    ):
        self.spark, self.path, self.keys, self.order_by, self.fan = spark, path.rstrip("/"), tuple(keys), tuple(order_by), fan
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ("repository", "path"), **options) -> ResultTable:
        """The table at ``path`` with the columns it was made with; a new one has those of ``schema``."""
        table = cls(spark, path, schema, keys, **options)
        if table._names("schema"):
            table.schema = StructType.fromJson(json.loads(table._read("schema/columns.json")))
        else:
            table._create("schema/columns.json", table.schema.json())
        return table

    # files, in any file system

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, system = self._file(folder)
        return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []

    def _read(self, name: str) -> str:
        path, system = self._file(name)
        stream = system.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> None:
        """Make a file that did not exist, whole or not at all."""
        target, system = self._file(name)
        half, _ = self._file(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = system.create(half, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if system.exists(target) or not system.rename(half, target):
            system.delete(half, False)
            raise Conflict(name)

    # versions

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]

    def version(self, number: int | None = None) -> Version:
        """A version's manifest; the newest by default, version 0 for a table without commits."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Version(0)
        found = json.loads(self._read(f"manifests/{number:012d}.json"))
        return Version(number, tuple(Run(*r) for r in found["runs"]), tuple(found["done"]))

    def _publish(self, old: Version, runs: Sequence[Run], done: Sequence[str]) -> Version:
        new = Version(old.number + 1, tuple(runs), tuple(done[-REMEMBERED:]))
        text = json.dumps({"runs": [[r.commit, r.level] for r in new.runs], "done": list(new.done)})
        self._create(f"manifests/{new.number:012d}.json", text)
        return new

    def _rows(self, runs: Sequence[Run]) -> DataFrame:
        """The rows of some runs, later runs winning."""
        wide = self.spark.createDataFrame([], self.schema).withColumn("_run", F.lit(0))
        for n, run in enumerate(runs):
            part = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{run.commit}")
            wide = wide.unionByName(part.withColumn("_run", F.lit(n)))
        return keep_last(wide, self.keys, ("_run",)).drop("_run") if len(runs) > 1 else wide.drop("_run")

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version. Files of a version are never changed, so a reader keeps its rows while others commit."""
        return self._rows(self.version(number).runs)

    def write_data(self, rows: DataFrame, commit: str) -> None:
        """First half of a commit: files that no manifest names yet. Columns that are missing are null, others are left out."""
        have = set(rows.columns)
        cast = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        kept = keep_last(rows.select(*cast), self.keys, self.order_by or self.keys)
        kept.write.mode("overwrite").parquet(f"{self.path}/data/{commit}")

    def commit(self, rows: DataFrame, commit: str) -> Version:
        """Add rows under a name that is the writer's own, such as the number of its run. The same name again changes nothing."""
        now = self.version()
        if commit in now.done:
            return now
        self.write_data(rows, commit)
        while True:
            try:
                made = self._publish(now, [*now.runs, Run(commit, 0)], [*now.done, commit])
                break
            except Conflict:
                now = self.version()
                if commit in now.done:
                    return now
        return self.compact(made)

    def compact(self, now: Version | None = None) -> Version:
        """Merge neighbouring runs of one level as long as there are ``fan`` of them; nothing if another writer was faster."""
        now = now or self.version()
        while True:
            runs = list(now.runs)
            levels = [r.level for r in runs]
            at = next((i for i in range(len(runs) - self.fan + 1) if len(set(levels[i : i + self.fan])) == 1), None)
            if at is None:
                return now
            level = levels[at] + 1
            merged = Run(f"level{level}-{now.number:012d}-{uuid.uuid4().hex[:8]}", level)
            self._rows(runs[at : at + self.fan]).write.mode("overwrite").parquet(f"{self.path}/data/{merged.commit}")
            try:
                now = self._publish(now, [*runs[:at], merged, *runs[at + self.fan :]], now.done)
            except Conflict:
                return self.version()

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete data that none of the last ``keep`` versions names, and older manifests. Readers of older versions must have ended."""
        numbers = self.versions()[-keep:]
        named = {run.commit for n in numbers for run in self.version(n).runs}
        gone = [c for c in self._names("data") if c not in named]
        for name in [f"data/{c}" for c in gone] + [f"manifests/{n:012d}.json" for n in self.versions() if n not in numbers]:
            path, system = self._file(name)
            system.delete(path, True)
        return gone
