"""Row numbers over ranges and exact quantiles, against plain sorting and DuckDB."""

import random

import pytest
from pyspark.sql import functions as F

from parley.operators.ranks import numbered, quantiles

SHARES = (0.0, 0.05, 0.25, 0.5, 0.95, 1.0)


def rows():
    r = random.Random(6)
    out = [("hot", round(r.gauss(0, 5), 1), r.random()) for _ in range(3000)]  # many ties
    out += [("one", 2.5, None), ("none", None, None), ("none", None, None), (None, 1.0, 3.0), (None, 2.0, None), ("two", -1.0, 1e300), ("two", 4.0, -1e300)]
    return out + [("same", 7.0, 7.0)] * 500


def test_quantiles_equal_duckdb(spark):
    import duckdb
    import pandas as pd

    table = pd.DataFrame(rows(), columns=["k", "x", "y"])  # noqa: F841 (DuckDB reads it by name)
    table["k"] = table["k"].astype(object)
    want = duckdb.sql(f"SELECT k, quantile_cont(x, {list(SHARES)}) AS x, quantile_cont(y, {list(SHARES)}) AS y FROM (SELECT k, CASE WHEN isnan(x) THEN NULL ELSE x END AS x, CASE WHEN isnan(y) THEN NULL ELSE y END AS y FROM table) GROUP BY k".replace("FROM table", 'FROM "table"')).fetchall()
    df = spark.createDataFrame(rows(), "k string, x double, y double")
    got = {r.k: (r.x, r.y) for r in quantiles(df.repartition(7), ["k"], ["x", "y"], SHARES).collect()}
    assert len(got) == len(want) == 6
    for k, x, y in want:
        for mine, theirs in zip(got[k], (x, y), strict=True):
            assert (mine is None) == (theirs is None)
            if mine is not None:
                assert mine == pytest.approx(list(theirs), rel=1e-12)


def test_quantiles_equal_percentile_without_keys(spark):
    df = spark.createDataFrame(rows(), "k string, x double, y double")
    (got,) = quantiles(df, [], ["x"], SHARES).collect()
    assert got.x == df.agg(F.percentile("x", F.array(*map(F.lit, SHARES)))).first()[0]
    (none,) = quantiles(df.filter("false"), [], ["x", "y"], SHARES).collect()
    assert none == (None, None)
    assert quantiles(df.filter("false"), ["k"], ["x"], SHARES).count() == 0


def test_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(k, -k % 97, "x") for k in range(2000)] + [(None, 5, "y")], "id long, score long, note string").repartition(5)
    got = numbered(df, [F.col("score").desc(), F.col("id").asc_nulls_last()], "place").collect()
    want = sorted(((r.id, r.score) for r in got), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 2002))
    assert numbered(df.filter("false"), [F.col("id")], "place").count() == 0
