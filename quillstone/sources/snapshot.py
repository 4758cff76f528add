"""Snapshots: a table is never overwritten where it is read; a new folder is written, then the pointer moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Versions of a table under `<root>/<name>/v=<n>`; the newest folder with a _SUCCESS file is current."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/{name}"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        whole = [n for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS"))]
        return sorted(int(n[2:]) for n in whole)

    def current(self) -> DataFrame | None:
        found = self.versions()
        return self.spark.read.parquet(f"{self.folder}/v={found[-1]}") if found else None

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Writes the next version and returns its number; readers of older ones are not disturbed."""
        version = (self.versions() or [0])[-1] + 1
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.folder}/v={version}")
        return version


def write_report(df: DataFrame, folder: str) -> None:
    """A report as JSON lines, written by tasks."""
    df.write.mode("overwrite").json(folder)
