"""Registered queries against their SQL on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
#: Quick ones here; the driver compares all of them.
NAMES = ["i2_merge", "i7_subtract", "v6_native_timeline", "v9_control_timeline", "v24_grid_summary", "t9_overlaps", "t13_onset_contexts", "m14_index_statistics", "a11_interval_coverage", "c2_required_fields", "p7_dropout_persistence", "p9_episodes", "x8_utterance_units", "v3_uncovered_media", "m19_manifest_violations", "p10_codec_boundary", "x6_utterances_to_turns", "x14_fact_participants"]


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 5) + 0.0)
    return str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


def test_each_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
