"""One place that maps a table's name to a DataFrame, whatever the storage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class MissingTableError(LookupError):
    """A table that a stage needs is not there."""


class Catalog:
    """Tables as `<root>/<name>.parquet`, or as JDBC tables when `jdbc` options are given."""

    def __init__(self, spark: SparkSession, root: str, jdbc: dict[str, str] | None = None):
        self.spark, self.root, self.jdbc = spark, root.rstrip("/"), jdbc

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if self.jdbc:
            return self.spark.read.format("jdbc").options(**self.jdbc, dbtable=name).load()
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def require(self, names: Iterable[str]) -> None:
        missing = [n for n in names if not self.exists(n)]
        if missing:
            raise MissingTableError(f"missing tables under {self.root}: {', '.join(missing)}")


def schema_guard(df: DataFrame, wanted: T.StructType) -> list[str]:
    """The differences between df and a wanted schema, as readable lines; empty when df can be used."""
    have = {f.name: f.dataType for f in df.schema}
    problems = [f"{f.name}: missing" for f in wanted if f.name not in have]
    return problems + [
        f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in wanted
        if f.name in have and have[f.name] != f.dataType
    ]


def conform(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """df with exactly the wanted columns: absent ones are null, present ones are cast."""
    return df.select(*[(df[f.name] if f.name in df.columns else _null()).cast(f.dataType).alias(f.name) for f in wanted])


def _null():
    from pyspark.sql import functions as F

    return F.lit(None)
