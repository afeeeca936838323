"""The label store: switches of versions, refusals, layout."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parley.sources import store


def tables(spark, n, label):
    grid = spark.range(n).select(F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("recording_id"), F.col("id").alias("decision_index"), F.lit(label).alias("label"))
    recordings = grid.select("recording_id").distinct()
    return {"grid": grid, "recordings": recordings}


def test_readers_see_a_whole_version(spark, tmp_path):
    root = f"file://{tmp_path}/labels"
    with pytest.raises(store.StoreError):
        store.read_table(spark, root, "speech", "grid")
    made = store.write_extractor(tables(spark, 10, "old"), root, "speech", {"step_s": 0.1})
    assert made["tables"]["grid"]["rows"] == 10 and store.read_manifest(spark, root, "speech")["step_s"] == 0.1
    held = store.read_table(spark, root, "speech", "grid")  # a reader that began before the next write
    twice = tables(spark, 12, "bad")
    with pytest.raises(store.StoreError, match="1 keys of several rows"):
        store.write_extractor(twice | {"grid": twice["grid"].unionByName(twice["grid"].filter("decision_index = 5"))}, root, "speech")
    with pytest.raises(store.StoreError, match="12 rows without decision_index"):
        store.write_extractor({"grid": twice["grid"].withColumn("decision_index", F.lit(None).cast("long"))}, root, "speech")
    fails = F.udf(lambda x: 1 // (x - 7), "long")
    with pytest.raises(Exception):  # noqa: B017 (tasks that fail half way)
        store.write_extractor({"grid": twice["grid"].withColumn("label", fails("decision_index"))}, root, "speech")
    assert {r.label for r in store.read_table(spark, root, "speech", "grid").collect()} == {"old"}
    store.write_extractor(tables(spark, 12, "new"), root, "speech")
    assert {r.label for r in held.collect()} == {"old"} and held.count() == 10
    assert {r.label for r in store.read_table(spark, root, "speech", "grid").collect()} == {"new"}
    assert store.drop_old(spark, root, "speech") == 3 and store.read_table(spark, root, "speech", "grid").count() == 12


def test_columns_and_tables_are_checked(spark, tmp_path):
    root = str(tmp_path / "labels")
    store.write_extractor(tables(spark, 5, "x"), root, "text")
    assert store.read_table(spark, root, "text", "grid", ["label"]).columns == ["recording_id", "decision_index", "label"]
    for table, columns in (("grid", ["no"]), ("events", None)):
        with pytest.raises(store.StoreError):
            store.read_table(spark, root, "text", table, columns)
    with pytest.raises(store.StoreError, match="no column"):
        store.write_extractor({"events": tables(spark, 5, "x")["grid"]}, root, "text")
    with pytest.raises(store.StoreError, match="given none"):
        store.write_extractor({}, root, "text")


def test_row_groups_are_of_one_size_and_sorted(spark, tmp_path):
    grid = spark.range(150_000).select(F.lit("r").alias("recording_id"), (150_000 - F.col("id")).alias("decision_index"))
    store.write_extractor({"grid": grid}, str(tmp_path), "speech")
    (path,) = [p for p in glob.glob(f"{tmp_path}/speech/v-*/grid.parquet/*.parquet") if pq.ParquetFile(p).metadata.num_rows]
    meta = pq.ParquetFile(path).metadata
    assert [meta.row_group(k).num_rows for k in range(meta.num_row_groups)] == [65_536, 65_536, 18_928]
    assert meta.row_group(0).column(0).compression == "ZSTD"
    assert pq.read_table(path)["decision_index"].to_pylist() == list(range(1, 150_001))


def test_rows_and_faults_of_a_table_are_found_in_one_pass(spark):
    columns = "recording_id string, decision_index int"
    rows = spark.createDataFrame([("r", 0), ("r", 1), ("r", 1), ("r", None), (None, None), (None, None)], columns)
    assert store._checked(rows, "grid") == (6, ["grid: 2 rows without recording_id", "grid: 3 rows without decision_index", "grid: 2 keys of several rows"])
    assert store._checked(rows.limit(0), "grid") == (0, [])
