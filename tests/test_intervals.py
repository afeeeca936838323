"""Interval algebra against brute force on random intervals."""

import random

import pytest

from parley.operators import intervals as iv

KEY = ["k"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, start_s double, end_s double")


def drawn(seed, n=40, top=60):
    r = random.Random(seed)
    return [(r.choice("ab"), float(r.randint(0, top)), float(r.randint(0, top))) for _ in range(n)]


def covered(rows, key, t):
    return any(k == key and a <= t < b for k, a, b in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_total_subtract_overlap(spark, seed):
    a, b = drawn(seed), drawn(seed + 100, 15)
    grid = [x + 0.5 for x in range(60)]
    merged = [tuple(r) for r in iv.merge(frame(spark, a), KEY).collect()]
    for key in "ab":
        assert sum(covered(merged, key, t) for t in grid) == sum(covered(a, key, t) for t in grid)
        own = sorted((s, e) for k, s, e in merged if k == key)
        assert all(x[1] < y[0] for x, y in zip(own, own[1:]))
    totals = {r.k: r.duration_s for r in iv.total_duration(frame(spark, a), KEY).collect()}
    assert totals == {key: float(sum(covered(a, key, t) for t in grid)) for key in totals}
    left = [tuple(r) for r in iv.subtract(frame(spark, a), frame(spark, b), KEY).collect()]
    for key in "ab":
        for t in grid:
            assert covered(left, key, t) == (covered(a, key, t) and not covered(b, key, t))
    segments = iv.normalize(frame(spark, a))
    for r in iv.overlap(segments, frame(spark, b), KEY).collect():
        assert r.overlap_s == sum(covered(b, r.k, t) for t in grid if r.start_s <= t < r.end_s)
        assert 0 <= r.overlap_ratio <= 1


def test_normalize_drops_what_is_no_interval(spark):
    rows = [("a", 1.0, 1.0), ("a", 3.0, 2.0), ("a", float("nan"), 2.0), ("a", 0.0, float("inf")), ("a", None, 2.0), ("a", 0.0, 2.0)]
    assert [tuple(r) for r in iv.normalize(frame(spark, rows)).collect()] == [("a", 0.0, 2.0)]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, forward, strict):
    r = random.Random(7)
    left = [("a", i, float(r.randint(0, 30))) for i in range(40)]
    right = [("a", float(t)) for t in r.sample(range(30), 10)]
    out = iv.asof(spark.createDataFrame(left, "k string, i int, t double"), spark.createDataFrame(right, "k string, u double"), KEY, "t", "u", ["u"], strict=strict, forward=forward).collect()
    assert len(out) == 40
    for row in out:
        ok = [u for _, u in right if (u > row.t or (u == row.t and not strict) if forward else u < row.t or (u == row.t and not strict))]
        want = (min if forward else max)(ok) if ok else None
        assert (row._found.u if row._found else None) == want


def test_nearest_offsets_prefer_the_earlier(spark):
    seg = frame(spark, [("a", 5.0, 9.0), ("b", 1.0, 2.0)])
    ref = frame(spark, [("a", 3.0, 7.0), ("a", 7.0, 11.0)])
    out = {r.k: (r.start_offset_s, r.end_offset_s) for r in iv.nearest_offsets(seg, ref, KEY).collect()}
    assert out == {"a": (2.0, 2.0), "b": (None, None)}
