"""Bucketed, sorted Parquet tables: rows dealt once by a hash of their key, so
that joins and aggregates on the key need no exchange afterwards.

A table is a folder plus its layout (schema, key columns, number of buckets).
Spark reads the layout from its catalog, so an application registers the folder
under a name made from its path before reading it; nothing else is kept there.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.session import int_setting

# Buckets of the session tables.  Default; a cluster sets spark.basketlens.sessionBuckets
# to bytes of the largest table / ~256 MB.  A stored table keeps the number it was written with.
SESSION_BUCKETS = 32


def session_buckets(spark: SparkSession) -> int:
    return int_setting(spark, "spark.basketlens.sessionBuckets", SESSION_BUCKETS)


@dataclass(frozen=True)
class BucketedTable:
    """``path`` with rows of ``schema``, in ``buckets`` by a hash of ``keys``; rows of
    a bucket are sorted by the keys.  ``partition`` names a column of the schema
    whose values get folders of their own (appends stay apart by it)."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int
    partition: str | None = None

    @property
    def name(self) -> str:
        layout = f"{self.path}|{self.schema.simpleString()}|{self.keys}|{self.buckets}|{self.partition}"
        return f"bl_{hashlib.sha1(layout.encode()).hexdigest()[:20]}"

    def append(self, df: DataFrame) -> None:
        """Add rows: one file per bucket, as the rows are first dealt into the
        buckets.  Rows with the keys of earlier appends are simply further rows."""
        self._register(df.sparkSession)
        columns = self._columns()
        w = (df.select(*columns).repartition(self.buckets, *self.keys).write.mode("append").format("parquet")
             .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self.path))
        if self.partition:
            w = w.partitionBy(self.partition)
        w.saveAsTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as a bucketed scan."""
        self._register(spark)
        spark.catalog.refreshTable(self.name)          # files another application added
        return spark.table(self.name).select(*(F.col(c) for c in self.schema.fieldNames()))

    def _columns(self) -> list[str]:
        return [c for c in self.schema.fieldNames() if c != self.partition] + (
            [self.partition] if self.partition else [])

    def _register(self, spark: SparkSession) -> None:
        if spark.catalog.tableExists(self.name):
            return
        fields = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema}
        keys = ", ".join(f"`{k}`" for k in self.keys)
        parts = f"PARTITIONED BY (`{self.partition}`) " if self.partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(fields[c] for c in self._columns())}) "
                  f"USING parquet {parts}CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
