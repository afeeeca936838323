"""Blocks of queries repeated for every shard never pass through the driver."""

import random

from parley.llm import topk


def test_points_are_not_broadcast(spark, monkeypatch):
    plans, saved = [], topk.saved

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(topk, "saved", lambda df, name: saved(planned(df), name))
    random_ = random.Random(1)
    rows = [(i, [random_.uniform(-1, 1) for _ in range(6)]) for i in range(300)] + [(300, [1e9] * 6), (310, [-1e9] * 6)]
    _, vertices = topk._vertices(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10, 5)
    shards, blocks = topk.F.lit(3), topk.F.lit(2)
    for found in (topk._narrow(vertices.filter("NOT wide"), 5, 2, shards, blocks, 32), topk._wide(vertices, 5, shards, blocks)):
        assert planned(found).count() > 0
    assert sum("SortMergeJoin" in p for p in plans) >= 3  # cutoffs, answers, answers of wide vectors
    assert not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastExchange" in p]
