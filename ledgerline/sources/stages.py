"""Intermediate tables in a folder that all executors see, so that a lost executor costs nothing of them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Stages:
    """Written steps of one job. The folder lies under spark.checkpoint.dir; where that is unset (tests), under the warehouse."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.number = spark, 0
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
        self.folder = f"{root.rstrip('/')}/stages-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """`df`, computed once and read from now on."""
        self.number += 1
        path = f"{self.folder}/{self.number}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, number: int) -> None:
        """Delete a step that is read no more."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
