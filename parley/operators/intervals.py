"""Interval algebra on (keys, start_s, end_s) rows: half-open, in seconds.

Everything is windows over the keys and equi-joins; no overlap predicate is left to a range join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def normalize(rows: DataFrame) -> DataFrame:
    """Drops empty, reversed and non-finite intervals."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("start_s", "end_s")]
    return rows.filter(finite[0] & finite[1] & (F.col("end_s") > F.col("start_s")))


def merge(rows: DataFrame, keys: Keys, gap: float = 0.0) -> DataFrame:
    """The union of each key's intervals: neighbours join when one starts by the running end plus `gap`."""
    order = Window.partitionBy(*keys).orderBy("start_s", "end_s")
    reached = F.max("end_s").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reached.isNull() | (F.col("start_s") > reached + F.lit(gap)), 1).otherwise(0)
    rows = normalize(rows).select(*keys, "start_s", "end_s").withColumn("_apart", apart)
    rows = rows.withColumn("_island", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).drop("_island")


def dilate(rows: DataFrame, keys: Keys, tolerance: float) -> DataFrame:
    """Both sides widened by a tolerance of zero or more, merged again."""
    wider = normalize(rows).select(*keys, (F.col("start_s") - F.lit(tolerance)).alias("start_s"), (F.col("end_s") + F.lit(tolerance)).alias("end_s"))
    return merge(wider, keys)


def clip(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """The part within [low, high); what is empty goes."""
    cut = rows.withColumn("start_s", F.greatest("start_s", low)).withColumn("end_s", F.least("end_s", high))
    return cut.filter("end_s > start_s")


def total_duration(rows: DataFrame, keys: Keys) -> DataFrame:
    return merge(rows, keys).groupBy(*keys).agg(F.sum(F.col("end_s") - F.col("start_s")).alias("duration_s"))


def asof(left: DataFrame, right: DataFrame, keys: Keys, at: str, of: str, take: Sequence[str], *, strict: bool = False, forward: bool = False, into: str = "_found") -> DataFrame:
    """Each left row with the `take` columns, as a struct `into`, of the nearest right row of its key.

    Backward: the last right row with of <= at (of < at if strict); forward: the first with of >= at (of > at).
    Both sides are sorted together once per key; among right rows of one time the greatest `take` counts backward
    and the least forward.
    """
    side = {c: left.schema[c].dataType for c in left.columns}
    payload = F.struct(*take)
    near = right.select(*keys, F.col(of).alias("_t"), F.lit(1 if strict ^ forward else 0).alias("_side"), payload.alias("_right"), *(F.lit(None).cast(t).alias(f"_l_{c}") for c, t in side.items()))
    asks = left.select(*keys, F.col(at).alias("_t"), F.lit(0 if strict ^ forward else 1).alias("_side"), F.lit(None).cast(near.schema["_right"].dataType).alias("_right"), *(F.col(c).alias(f"_l_{c}") for c in side))
    both = near.unionByName(asks).withColumn("_ask", F.col("_right").isNull())
    # Forward, the order is reversed: a frame up to the current row is kept as it grows, one to the end is worked out anew for each row.
    columns = [F.col(c).desc() if forward else F.col(c).asc() for c in ("_t", "_side", "_right")]
    frame = Window.partitionBy(*keys).orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn(into, F.last("_right", ignorenulls=True).over(frame)).filter("_ask")
    return out.select(*(F.col(f"_l_{c}").alias(c) for c in side), into)


def covered_before(points: DataFrame, union: DataFrame, keys: Keys, at: str, into: str) -> DataFrame:
    """How many seconds of a merged union lie before each point: a running sum met by an as-of pass."""
    order = Window.partitionBy(*keys).orderBy("start_s")
    length = F.col("end_s") - F.col("start_s")
    sums = union.withColumn("before_s", F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    met = asof(points, sums, keys, at, "start_s", ["start_s", "end_s", "before_s"], into="_u")
    within = F.least(F.col(at), F.col("_u.end_s")) - F.col("_u.start_s")
    return met.withColumn(into, F.coalesce(F.col("_u.before_s") + within, F.lit(0.0))).drop("_u")


def overlap(segments: DataFrame, reference: DataFrame, keys: Keys) -> DataFrame:
    """Each segment with the seconds that the union of its key's reference covers, and their share: 0 when empty, 1 at most."""
    union = merge(reference, keys)
    met = covered_before(segments, union, keys, "start_s", "_low")
    met = covered_before(met, union, keys, "end_s", "_high")
    out = met.withColumn("overlap_s", F.greatest(F.lit(0.0), F.col("_high") - F.col("_low")))
    length = F.col("end_s") - F.col("start_s")
    return out.withColumn("overlap_ratio", F.when(length > 0, F.least(F.lit(1.0), F.col("overlap_s") / length)).otherwise(0.0)).drop("_low", "_high")


def pieces(rows: DataFrame, keys: Keys, bounds: DataFrame | None = None) -> DataFrame:
    """(keys, ordinal, start_s, end_s): each key's time cut at every endpoint, and at those of `bounds`."""
    ends = normalize(rows).select(*keys, F.explode(F.array("start_s", "end_s")).alias("start_s"))
    if bounds is not None:
        ends = ends.union(bounds.select(*keys, F.explode(F.array("start_s", "end_s")).alias("start_s")))
    order = Window.partitionBy(*keys).orderBy("start_s")
    cut = ends.distinct().withColumn("end_s", F.lead("start_s").over(order)).withColumn("ordinal", F.row_number().over(order) - 1)
    return cut.filter("end_s IS NOT NULL").select(*keys, "ordinal", "start_s", "end_s")


def on_pieces(rows: DataFrame, cut: DataFrame, keys: Keys) -> DataFrame:
    """Each interval once for every piece that it covers, as column `ordinal`.

    An interval's ends are piece boundaries, so two equi-joins find its first and last piece and a sequence the rest.
    """
    first = cut.select(*keys, F.col("start_s").alias("_first_s"), F.col("ordinal").alias("_first"))
    last = cut.select(*keys, F.col("end_s").alias("_last_s"), F.col("ordinal").alias("_last"))
    met = rows.withColumn("_first_s", F.col("start_s")).withColumn("_last_s", F.col("end_s"))
    met = met.join(first, [*keys, "_first_s"]).join(last, [*keys, "_last_s"]).filter("_last >= _first")
    return met.withColumn("ordinal", F.explode(F.sequence("_first", "_last"))).drop("_first_s", "_last_s", "_first", "_last")


def depth(rows: DataFrame, cut: DataFrame, keys: Keys, into: str) -> DataFrame:
    """`cut` with how many intervals cover each piece: a running sum of starts less ends."""
    ends = rows.select(*keys, F.explode(F.array(F.struct(F.col("start_s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end_s").alias("t"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.groupBy(*keys, F.col("e.t").alias("start_s")).agg(F.sum("e.d").alias("_step"))
    order = Window.partitionBy(*keys).orderBy("start_s").rowsBetween(Window.unboundedPreceding, 0)
    met = cut.join(steps, [*keys, "start_s"], "left")
    return met.withColumn(into, F.coalesce(F.sum("_step").over(order), F.lit(0))).drop("_step")


def islands(rows: DataFrame, keys: Keys, same: Sequence[str]) -> DataFrame:
    """Neighbouring pieces with equal `same` columns as one; pieces must abut."""
    order = Window.partitionBy(*keys).orderBy("start_s")
    was = F.lag(F.struct("end_s", *same)).over(order)
    joins = was["end_s"].eqNullSafe(F.col("start_s"))
    for c in same:
        joins &= was[c].eqNullSafe(F.col(c))
    rows = rows.withColumn("_new", F.when(joins, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island", *same).agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).drop("_island")


def subtract(rows: DataFrame, minus: DataFrame, keys: Keys) -> DataFrame:
    """The parts of the first union that the second doesn't cover, merged."""
    rows, minus = merge(rows, keys), merge(minus, keys)
    cut = pieces(rows.unionByName(minus), keys)
    cut = depth(minus, depth(rows, cut, keys, "_own"), keys, "_other")
    return islands(cut.filter("_own > 0 AND _other = 0"), keys, [])


def nearest_offsets(segments: DataFrame, reference: DataFrame, keys: Keys) -> DataFrame:
    """Signed distance of each segment's start and end to the nearest reference start and end; the earlier one on ties, null if none."""
    reference = normalize(reference)
    out = segments
    for side in ("start", "end"):
        at = f"{side}_s"
        points = reference.select(*keys, F.col(at).alias("_p"))
        out = asof(out, points, keys, at, "_p", ["_p"], into="_before")
        out = asof(out, points, keys, at, "_p", ["_p"], forward=True, into="_after")
        low, high = F.col(at) - F.col("_before._p"), F.col(at) - F.col("_after._p")
        nearer = F.when(low.isNull(), high).when(high.isNull(), low).when(low <= -high, low).otherwise(high)
        out = out.withColumn(f"{side}_offset_s", nearer).drop("_before", "_after")
    return out
