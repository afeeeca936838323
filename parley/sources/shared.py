"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only on a single machine where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-parley-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: worked out once, whatever reads them, and no executor's loss undoes them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt by a key to `spark.sql.shuffle.partitions` parts, which isn't done again where they are dealt so already."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def saved_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As `saved`, in buckets of a key: what reads them finds them dealt, and windows and groups over the key shuffle nothing."""
    spark = df.sparkSession
    table = f"{re.sub('[^a-z]', '_', name)}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt(df, key).write.bucketBy(parts, key).option("path", f"{shared_dir(spark)}/{table}").saveAsTable(table)
    out = spark.read.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only; the files stay
    return out


def stacked(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Tables one below the other, with nulls for columns that one lacks; where all are dealt by the key, so is the whole.

    Spark finds that out only if the key has a new name in each.
    """
    out = parts[0].withColumnRenamed(key, f"_{key}")
    for more in parts[1:]:
        out = out.unionByName(more.withColumnRenamed(key, f"_{key}"), allowMissingColumns=True)
    return out.withColumnRenamed(f"_{key}", key)
