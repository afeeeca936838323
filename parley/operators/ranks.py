"""Row numbers and exact quantiles by ranges of a sorted table, so that no task holds a group or the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.sources.shared import saved

_PART = "range_part"
#: Least, 5 %, median, 95 % and greatest.
FIVE = (0.0, 0.05, 0.5, 0.95, 1.0)


def _in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with the number of the range they fall in, later ranges holding later rows; written, so that ranges are drawn once."""
    return saved(df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id()), name)


def numbered(df: DataFrame, order: Sequence[Column], into: str) -> DataFrame:
    """The rows with a column `into`: their number from 1 in this order over the whole table.

    Rows are cut into ranges of the order, numbered in each, and the ranges' sizes before are added: one row a range comes to
    the driver. Rows that `order` doesn't part are numbered in any order and lie in one range, so end it with something that
    differs where many rows may be equal.
    """
    placed = _in_ranges(df, order, "ranges")
    before, total = [], 0
    for r in placed.groupBy(_PART).count().orderBy(_PART).collect():
        before.append((r[_PART], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(before, f"{_PART} int, range_before long")
    nth = F.row_number().over(Window.partitionBy(_PART).orderBy(*order))
    return placed.join(F.broadcast(offsets), _PART).withColumn(into, nth + F.col("range_before")).drop(_PART, "range_before")


def quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(keys, one array for each of `values`): its quantiles at `shares` over the rows of each group, linear between neighbours.

    Equal to `percentile(value, shares)`: nulls don't count, a group without a value has null arrays, and NaN counts as the
    largest. But no task gathers a group: equal values are counted first, the distinct ones sorted into ranges, and running
    counts over the ranges of a group (as many as there are partitions, at most) tell which range and row holds a rank. Null keys
    are a group of their own. Without keys there is one row, of nulls if the table is empty.
    """
    flat = F.explode(F.array(*(F.struct(F.lit(i).alias("which"), F.col(v).cast("double").alias("value")) for i, v in enumerate(values))))
    group = [f"key_{i}" for i in range(len(keys))] + ["which"]
    named = df.select(*(F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)), flat.alias("cell")).select(*group[:-1], "cell.which", "cell.value")
    counted = named.filter(F.col("value").isNotNull()).groupBy(*group, "value").agg(F.count("*").alias("n"))
    arrays = _at_shares(counted, group, ["value"], shares)
    per_value = [F.max(F.when(F.col("which") == i, F.col("quantiles"))).alias(f"value_{i}") for i in range(len(values))]
    if not keys:
        return arrays.agg(*per_value).select(*(F.col(f"value_{i}").alias(v) for i, v in enumerate(values)))
    groups = named.select(*group[:-1]).distinct()
    out = arrays.groupBy(*group[:-1]).agg(*per_value)
    joined = groups.alias("g").join(out.alias("o"), [F.col(f"g.{c}").eqNullSafe(F.col(f"o.{c}")) for c in group[:-1]], "left")
    return joined.select(*(F.col(f"g.key_{i}").alias(k) for i, k in enumerate(keys)), *(F.col(f"value_{i}").alias(v) for i, v in enumerate(values)))


#: Of all values the sketch of `narrowed_quantiles` may misplace at most one in so many.
_SKETCH = 4000


def narrowed_quantiles(df: DataFrame, values: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """As `quantiles` without keys, and as exact, for rows that are cheap to read twice: only values near the quantiles are shuffled.

    A sketch gives bounds around each quantile; what lies between them is counted value by value, what lies outside only as how
    much lies there. Should a rank lie outside after all, the quantiles are worked out from all values.
    """
    flat = F.explode(F.array(*(F.struct(F.lit(i).alias("which"), F.col(v).cast("double").alias("value")) for i, v in enumerate(values))))
    named = df.select(flat.alias("cell")).select("cell.*").filter("value IS NOT NULL")
    reach = 4 / _SKETCH
    at = sorted({min(1.0, max(0.0, s + d)) for s in shares for d in (-reach, reach)})
    rough = {r["which"]: dict(zip(at, r["q"], strict=True)) for r in named.groupBy("which").agg(F.percentile_approx("value", at, _SKETCH).alias("q")).collect()}

    def zone(bounds: dict[float, float]) -> Column:
        """How many ends of bounded stretches lie before a value: odd inside one, even between two."""
        passed, reached = F.lit(0), None
        for s in sorted(shares):
            low, high = bounds[min(1.0, max(0.0, s - reach))], bounds[min(1.0, max(0.0, s + reach))]
            begins = F.lit(True) if s - reach <= 0 else F.col("value") >= F.lit(low)
            ends = F.lit(False) if s + reach >= 1 else F.col("value") > F.lit(high)
            if reached is not None:
                begins = begins & reached  # stretches that overlap are one: the next begins where the last one has ended
            passed, reached = passed + begins.cast("int") + (begins & ends).cast("int"), ends
        return passed

    zones = F.coalesce(*(F.when(F.col("which") == w, zone(b)) for w, b in rough.items()), F.lit(1))
    inside = F.when(F.col("zone") % 2 == 1, F.col("value"))
    counted = named.withColumn("zone", zones).groupBy("which", "zone", inside.alias("value")).agg(F.count("*").alias("n"))
    found = {r["which"]: r["quantiles"] for r in _at_shares(counted, ["which"], ["zone", "value"], shares).collect()}
    if set(found) != set(rough) or any(q is None for row in found.values() for q in row):
        return quantiles(df, [], values, shares)
    kind = ", ".join(f"value_{i} array<double>" for i in range(len(values)))
    return df.sparkSession.createDataFrame([tuple(found.get(i) for i in range(len(values)))], kind).select(*(F.col(f"value_{i}").alias(v) for i, v in enumerate(values)))


def _at_shares(counted: DataFrame, group: Sequence[str], order: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(group, quantiles) of rows (group, order, value, n): how often each value occurs in a group; `order` puts values in order."""
    placed = _in_ranges(counted, [F.col(c) for c in [*group, *order]], "distinct-values")

    sizes = placed.groupBy(*group, _PART).agg(F.sum("n").alias("part_n"))
    over_parts = Window.partitionBy(*group)
    before = F.sum("part_n").over(over_parts.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*group, _PART, F.coalesce(before, F.lit(0)).alias("before"), F.sum("part_n").over(over_parts).alias("total"))
    upto = F.sum("n").over(Window.partitionBy(*group, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, _PART]]
    ranked = placed.withColumn("upto", upto).alias("a").join(sizes.alias("b"), same).select(*(F.col(f"a.{c}").alias(c) for c in group), "value", "total", (F.col("before") + F.col("upto")).alias("upto"), "n")

    def near(share: float) -> tuple[Column, Column]:
        """Where the rank lies, and this row's share in its quantile: the value times how near it is to the two ranks that it may cover."""
        at = F.lit(float(share)) * (F.col("total") - 1)
        return at, F.floor(at)

    def covers(rank: Column) -> Column:
        return (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))

    picked = []
    for i, share in enumerate(shares):
        at, low = near(share)
        picked += [
            F.max(F.when(covers(low), F.col("value"))).alias(f"low_{i}"),
            F.max(F.when(covers(F.ceil(at)), F.col("value"))).alias(f"high_{i}"),
            F.max(at - low).alias(f"part_{i}"),
        ]
    wanted = F.lit(False)
    for share in shares:
        at, low = near(share)
        wanted = wanted | covers(low) | covers(F.ceil(at))
    found = ranked.filter(wanted).groupBy(*group).agg(*picked)

    def between(i: int) -> Column:
        low, high, part = F.col(f"low_{i}"), F.col(f"high_{i}"), F.col(f"part_{i}")
        return F.when(low == high, low).otherwise((1 - part) * low + part * high)

    return found.select(*group, F.array(*(between(i) for i in range(len(shares)))).alias("quantiles"))


def with_quantiles(counts: DataFrame, rows: DataFrame, keys: Sequence[str], values: Sequence[str], shares: Sequence[float] = FIVE) -> DataFrame:
    """`counts`, one row for each group of `rows` (or one row without keys), with the array of each value's quantiles under the value's name."""
    found = quantiles(rows, keys, values, shares)
    if not keys:
        return counts.crossJoin(found)  # one row each
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    return counts.alias("c").join(found.alias("q"), same).select("c.*", *(F.col(f"q.{v}") for v in values))
