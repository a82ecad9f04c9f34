"""Sinks: append, keyed upsert, full rebuild and views, on partitioned Parquet tables.

A table is a folder of data folders and of numbered manifests. A manifest names the folders that make up
a version; it is written beside its place and put there by one rename that never replaces anything, and
the one of the highest number counts. So a run that dies at any point leaves the last version as it was. An
upsert of a table partitioned by day writes the days it touches anew; the others are carried over by name.
Versions that are no longer wanted are deleted by ``vacuum``.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._Path(f"{self.path}/{name}")

    def names(self, folder: str = "") -> list[str]:
        at = self.at(folder) if folder else self._Path(self.path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.at(name)):
            return None
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a file that is not there yet, whole or not at all; False if it is there."""
        new = self.at(f"_new-{uuid.uuid4().hex}")
        out = self.fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(self.at(name).getParent())
        if self.fs.exists(self.at(name)) or not self.fs.rename(new, self.at(name)):
            self.fs.delete(new, False)
            return False
        return True

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


class Table:
    """A Parquet table at ``path``, partitioned by the day of ``day_of`` if that is given."""

    def __init__(self, spark: SparkSession, path: str, schema: str, day_of: str | None = None):
        self.spark, self.path, self.schema, self.day_of = spark, path.rstrip("/"), schema, day_of
        self.files = Files(spark, path)

    def versions(self) -> list[int]:
        return [int(n) for n in self.files.names("_manifest") if n.isdigit()]

    def version(self) -> int | None:
        """The number of the current version, None before the first."""
        return max(self.versions(), default=None)

    def parts(self, version: int | None = None) -> list[str]:
        """The data folders of a version, by default the current one."""
        number = self.version() if version is None else version
        return [] if number is None else json.loads(self.files.read(f"_manifest/{number:012d}"))

    def _publish(self, parts: list[str]) -> None:
        number = self.version()
        if not self.files.put(f"_manifest/{0 if number is None else number + 1:012d}", json.dumps(parts)):
            raise OSError(f"{self.path}: another writer published a version meanwhile")

    def exists(self) -> bool:
        return self.version() is not None

    def restore(self, version: int | None) -> None:
        """Make a former version the current one by taking back those after it; None: all of them."""
        for n in reversed(self.versions()):
            if version is None or n > version:
                self.files.drop(f"_manifest/{n:012d}")

    def read(self, since: datetime.date | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version; of a table by days, only folders of ``since`` and later days and of no day are listed."""
        parts = self.parts(version)
        if since is not None and self.day_of:
            parts = [p for p in parts if p.rpartition("event_date=")[2] >= since.isoformat()]
        return self._rows(parts)

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in parts])

    def _write(self, df: DataFrame, label: str = "v") -> list[str]:
        """Rows in the declared types and order, in a new folder; a missing column is an error."""
        wanted = self.spark.createDataFrame([], self.schema).schema
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
        name = f"{label}-{uuid.uuid4().hex}"
        if not self.day_of:
            out.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
            return [name]
        by_day = out.withColumn("event_date", F.to_date(self.day_of))
        by_day.write.partitionBy("event_date").option("compression", "zstd").parquet(f"{self.path}/{name}")
        return [f"{name}/{n}" for n in self.files.names(name) if n.startswith("event_date=")]

    def rebuild(self, df: DataFrame) -> None:
        self._publish(self._write(df))

    def append(self, df: DataFrame, run_id: str) -> None:
        """Add the rows of a run; the same run again replaces what it added."""
        label = f"run-{run_id}"
        new = self._write(df, label)
        self._publish([p for p in self.parts() if p.split("/")[0].rpartition("-")[0] != label] + new)

    def upsert(self, batch: DataFrame, keys: list[str], order: list | None = None, unique: bool = False) -> None:
        """Replace the rows whose keys the batch has, add the others, as a new version.

        A batch with two rows of one key is an error, unless ``order`` says which one comes first.
        unique: the batch is known to have one row a key, which saves the look. Of a table by days,
        the days of the batch and of the rows it replaces are written anew.
        """
        if order is not None:
            from pyspark.sql import Window

            w = Window.partitionBy(*keys).orderBy(*order)
            batch = batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        elif not unique and batch.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"{self.path}: the batch has several rows of one key {keys}")
        parts = self.parts()
        wanted = self.spark.createDataFrame([], self.schema).schema
        batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
        if not self.day_of or not parts:
            self._publish(self._write(merged(self._rows(parts), batch, keys) if parts else batch))
            return
        day = F.to_date(self.day_of).alias("day")
        replaced = self._rows(parts).join(batch.select(*keys), keys, "left_semi").select(day)
        touched = {str(r.day) if r.day else "" for r in batch.select(day).union(replaced).distinct().collect()}  # one row a day
        of = lambda p: d if (d := p.rpartition("event_date=")[2])[:2] != "__" else ""
        old = [p for p in parts if of(p) in touched]
        self._publish([p for p in parts if of(p) not in touched] + self._write(merged(self._rows(old), batch, keys)))

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions, and data folders that none of those names."""
        numbers = self.versions()
        for n in numbers[:-keep]:
            self.files.drop(f"_manifest/{n:012d}")
        used = {p.split("/")[0] for n in numbers[-keep:] for p in self.parts(n)}
        for name in self.files.names():
            if not name.startswith("_") and name not in used:
                self.files.drop(name)


def merged(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``target`` without those whose keys ``batch`` has, and the batch."""
    return target.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).unionByName(batch)


def view(df: DataFrame, name: str) -> DataFrame:
    """A named view, evaluated whenever it is read."""
    df.createOrReplaceTempView(name)
    return df
