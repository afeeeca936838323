"""A store of label tables: the tables of an extractor are written beside the old ones, checked, and switched by one small file."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What identifies a row of each table of an extractor.
TABLE_KEYS = {
    "grid": ("recording_id", "decision_index"),
    "events": ("recording_id", "event_type", "time_s"),
    "segments": ("recording_id", "segment_type", "segment_id"),
    "participants": ("recording_id", "participant_index"),
    "recordings": ("recording_id",),
}
#: Tables in which a key stands for one row; several events may fall on one moment.
UNIQUE = ("grid", "segments", "participants", "recordings")
ROW_GROUP_ROWS = 65_536
POINTER = "current.json"


class StoreError(ValueError):
    """Tables that don't keep what the store promises, or a store that isn't there."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and renames it over the old one, in any file system that Spark reaches."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    side = f"{path}.{uuid.uuid4().hex}"
    out = _files(spark, side).create(_path(spark, side), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), conf).rename(_path(spark, side), _path(spark, path), over)


def _checked(rows: DataFrame, table: str) -> tuple[int, list[str]]:
    """A table's rows, and what is wrong with its keys and how often; one pass over it."""
    keys = TABLE_KEYS[table]
    optional = {"time_s"}  # an event need not be timed
    per = rows.groupBy(*keys).agg(F.count("*").alias("_n")) if table in UNIQUE else rows.select(*keys, F.lit(1).cast("long").alias("_n"))
    missing = (F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)).alias(k) for k in keys)
    found = per.agg(*missing, F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.count_if(F.col("_n") > 1).alias("_twice")).first()
    out = [f"{table}: {found[k]} rows without {k}" for k in keys if k not in optional and found[k]]
    out += [f"{table}: {found['_twice']} keys of several rows"] if found["_twice"] else []
    return found["_rows"], out


def write_extractor(tables: Mapping[str, DataFrame], root: str, extractor: str, manifest: Mapping | None = None) -> dict:
    """Writes the extractor's tables and makes them the current ones; returns the manifest with each table's rows and columns.

    A version is a folder of its own: whole recordings to a task, in the order of the keys, zstd, row groups of
    ROW_GROUP_ROWS. Its tables are read back and their keys checked, and only then does the pointer file name it, by one
    rename. So readers see the old tables during a write and after one that failed. Old versions stay until `drop_old`.
    """
    if not tables or set(tables) - set(TABLE_KEYS):
        raise StoreError(f"tables of an extractor are {', '.join(TABLE_KEYS)}; given {', '.join(sorted(tables)) or 'none'}")
    spark = next(iter(tables.values())).sparkSession
    version = f"v-{uuid.uuid4().hex}"
    entries, wrong = {}, []
    for name, rows in sorted(tables.items()):
        missing = [k for k in TABLE_KEYS[name] if k not in rows.columns]
        if missing:
            raise StoreError(f"{name}: no column {', '.join(missing)}")
        path = f"{root}/{extractor}/{version}/{name}.parquet"
        placed = rows.repartition("recording_id").sortWithinPartitions(*TABLE_KEYS[name])
        placed.write.option("compression", "zstd").option("parquet.block.row.count.limit", str(ROW_GROUP_ROWS)).parquet(path)
        back = spark.read.schema(rows.schema).parquet(path)
        n, faults = _checked(back, name)
        wrong += faults
        entries[name] = {"rows": n, "columns": rows.columns, "schema": rows.schema.jsonValue()}
    if wrong:
        raise StoreError("; ".join(wrong))
    document = {**(manifest or {}), "version": version, "tables": entries}
    _put(spark, f"{root}/{extractor}/{POINTER}", json.dumps(document, indent=2, sort_keys=True))
    return document


def read_manifest(spark: SparkSession, root: str, extractor: str) -> dict:
    """The manifest of the extractor's current version."""
    path = f"{root}/{extractor}/{POINTER}"
    if not _files(spark, path).exists(_path(spark, path)):
        raise StoreError(f"no labels of {extractor} at {root}")
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def read_table(spark: SparkSession, root: str, extractor: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of the current version with its keys and, of the others, `columns` (all if None); an unknown column is an error."""
    entry = read_manifest(spark, root, extractor)
    if table not in entry["tables"]:
        raise StoreError(f"{extractor} has no {table}")
    rows = spark.read.parquet(f"{root}/{extractor}/{entry['version']}/{table}.parquet")
    if columns is None:
        return rows
    unknown = [c for c in columns if c not in rows.columns]
    if unknown:
        raise StoreError(f"{extractor} {table} has no {', '.join(unknown)}")
    keys = TABLE_KEYS[table]
    return rows.select(*keys, *(c for c in columns if c not in keys))


def drop_old(spark: SparkSession, root: str, extractor: str) -> int:
    """Removes the versions that the pointer doesn't name, once no reader uses them; returns how many."""
    kept = read_manifest(spark, root, extractor)["version"]
    at = f"{root}/{extractor}"
    old = [f.getPath() for f in _files(spark, at).listStatus(_path(spark, at)) if f.getPath().getName().startswith("v-") and f.getPath().getName() != kept]
    for path in old:
        _files(spark, at).delete(path, True)
    return len(old)
