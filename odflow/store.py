"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``.

A table written there cuts the lineage and survives lost executors. A ``Store`` owns the
files of one operator call; ``drop`` removes a table that nothing needs any more and
``release`` all of them. Tables behind a returned, not yet executed result are left
in place: they belong to the caller, like any checkpoint file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from odflow.session import ensure_checkpoint_dir


class Store:
    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and read it back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._stored_at = path
        return back

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def drop(self, df: DataFrame) -> None:
        """Remove the files of a table this store wrote."""
        self._delete(df._stored_at)

    def release(self) -> None:
        self._delete(self.root)


class Versions:
    """A table kept in versions: version 0 is whole, a later one holds all rows of the keys it replaces and nothing else."""

    def __init__(self, store: Store, key: str):
        self.store, self.key, self.n = store, key, 0
        store.count += 1
        self.root = f"{store.root}/{store.count}"
        self.schema = None

    def put(self, rows: DataFrame, keys: DataFrame | None = None) -> None:
        """Write the next version; ``keys`` are the keys it replaces (also those left without rows)."""
        rows.write.parquet(f"{self.root}/rows/_v={self.n}")
        if self.n == 0:
            self.schema = rows.schema
        else:
            keys.select(self.key).write.parquet(f"{self.root}/keys/_v={self.n}")
        self.n += 1

    def part(self, version: int) -> DataFrame:
        return self.store.spark.read.schema(self.schema).parquet(f"{self.root}/rows/_v={version}")

    def latest(self) -> DataFrame:
        """The rows of each key's last version. One scan and one join, however many versions there are."""
        if self.n == 1:
            return self.part(0)
        spark = self.store.spark
        read = spark.read.schema(StructType([*self.schema.fields, StructField("_v", IntegerType())])).parquet(f"{self.root}/rows")
        owner = (spark.read.schema(StructType([self.schema[self.key], StructField("_v", IntegerType())])).parquet(f"{self.root}/keys")
                 .groupBy(self.key).agg(F.max("_v").alias("_last")))
        return read.join(owner, self.key, "left").where(F.col("_v") == F.coalesce("_last", F.lit(0))).drop("_v", "_last")
