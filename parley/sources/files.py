"""Tables from CSV and nested JSON files, and tables to Parquet: whole, as label stores, and by split."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.sources.shared import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header, typed by the schema; empty fields are null, and texts may hold quotes and line ends."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def nested_json(spark: SparkSession, path: str, schema: str, top: str, lines: bool = False) -> DataFrame:
    """The objects of the array `top` of each JSON document, as columns: a document is a file, or a line if `lines`."""
    return spark.read.schema(schema).json(path, multiLine=not lines).select(F.explode(top).alias("_o")).select("_o.*")


def write_table(rows: DataFrame, path: str) -> None:
    """The rows as Parquet; readers see the old or the new files as Spark commits a job in whole."""
    rows.write.mode("overwrite").parquet(path)


def write_labels(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A label table: whole recordings to a task, in the order of the keys, the first of which is the recording; zstd."""
    rows.repartition(keys[0]).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split. The few splits are dealt over all tasks rather than gathered in one each."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)
