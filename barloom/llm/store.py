"""Written intermediate tables in the cluster's shared folder, and sizes that decide plans."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import delete, scratch


class Store:
    """Intermediate tables of one operator call, each under a fresh folder.

    A written table cuts the lineage: a lost executor costs its running tasks, not
    the steps before. Tables stay until the session's scratch folder goes, unless dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch(spark, name, uuid.uuid4().hex)

    def put(self, name: str, frame: DataFrame) -> DataFrame:
        path = f"{self.base}/{name}"
        frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.base}/{name}")

    def tidy(self) -> None:
        """Shuffle files of steps that are over go; else they stay until the driver happens to collect its garbage."""
        gc.collect()
        self.spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(frame: DataFrame, column: str) -> int:
    """Bytes of a text column; a partial aggregate, one number reaches the driver."""
    return frame.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(spark: SparkSession, total: int, each: int) -> int:
    """Partitions so that each holds about `each` bytes, and no fewer than the session's."""
    return max(shuffle_partitions(spark), -(-total // each))
