"""Cleaning with exact accounting, and audits of keys, bounds, time and agreement between sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parley.operators.intervals import asof, normalize
from parley.operators.ranks import with_quantiles


def drop_reason(required: Sequence[str], more: Mapping[str, Column] | None = None) -> Column:
    """Why a row goes: the first required column that is null, in the order given, then the first further rule that fails; null if it stays."""
    reason = [F.when(F.col(c).isNull(), f"missing_{c}") for c in required]
    reason += [F.when(~F.coalesce(keep, F.lit(False)), name) for name, keep in (more or {}).items()]
    return F.coalesce(*reason)


def clean(rows: DataFrame, required: Sequence[str], more: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that stay, and (reason, n) of those that go."""
    marked = rows.withColumn("_reason", drop_reason(required, more))
    kept = marked.filter("_reason IS NULL").drop("_reason")
    return kept, marked.filter("_reason IS NOT NULL").groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n"))


def accounting(rows: DataFrame, required: Sequence[str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: source rows, kept rows, dropped rows, and whether they add up."""
    out = rows.agg(F.count("*").alias("source"), F.count_if(drop_reason(required, more).isNull()).alias("kept"), F.count(drop_reason(required, more)).alias("dropped"))
    return out.withColumn("balanced", F.col("source") == F.col("kept") + F.col("dropped"))


def null_report(rows: DataFrame, optional: Sequence[str]) -> DataFrame:
    """(column_name, nulls) for each optional column, and for `any` the rows with a null in one of them."""
    some = F.lit(False)
    for c in optional:
        some |= F.col(c).isNull()
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in optional), F.count_if(some).alias("any"))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in (*optional, "any")))).alias("r")).select("r.*")


def domain_counts(rows: DataFrame, domains: Mapping[str, Column]) -> DataFrame:
    """(domain, n): rows for which each condition holds."""
    counts = rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in domains.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("domain"), F.col(n).alias("n")) for n in domains))).alias("r")).select("r.*")


def temporal_integrity(rows: DataFrame, start: str, end: str, reference: str | None = None, tolerance_s: float = 0.0) -> DataFrame:
    """One row: missing, non-finite, negative, reversed and empty intervals, duration quantiles, and how far ends pass a reference duration."""
    s, e = F.col(start), F.col(end)
    both = s.isNotNull() & e.isNotNull()
    infinite = F.lit(float("inf"))
    length = F.when(both, e - s)
    past = e - F.col(reference) if reference else F.lit(None).cast("double")
    out = rows.agg(
        F.count("*").alias("rows"),
        F.count_if(~both).alias("missing"),
        F.count_if(F.coalesce((F.abs(s) == infinite) | (F.abs(e) == infinite), F.lit(False))).alias("non_finite"),
        F.count_if(F.coalesce(s < 0, F.lit(False))).alias("negative_start"),
        F.count_if(F.coalesce(s > e, F.lit(False))).alias("reversed"),
        F.count_if(F.coalesce(s == e, F.lit(False))).alias("empty"),
        F.count_if(F.coalesce(past > tolerance_s, F.lit(False))).alias("overshoots"),
        F.max(F.when(past > tolerance_s, past)).alias("max_overshoot"),
        F.count_if(both & past.isNull()).alias("unresolved"),
    )
    names = ("duration_min", "duration_p05", "duration_median", "duration_p95", "duration_max")
    out = with_quantiles(out, rows.select(length.alias("_q")), [], ["_q"])
    return out.select("*", *(F.col("_q")[k].alias(n) for k, n in enumerate(names))).drop("_q")


def severities(counts: DataFrame, levels: Mapping[str, str]) -> DataFrame:
    """(anomaly, n, severity) of the non-zero counts of a one-row report."""
    return counts.select(F.explode(F.array(*(F.struct(F.lit(a).alias("anomaly"), F.col(a).cast("long").alias("n"), F.lit(s).alias("severity")) for a, s in levels.items()))).alias("r")).select("r.*").filter("n > 0")


def source_verdict(anomalies: DataFrame, by: str) -> DataFrame:
    """blocked if a source has an ERROR, usable_with_caveats if a WARNING, else usable."""
    worst = F.max(F.when(F.col("severity") == "ERROR", 2).when(F.col("severity") == "WARNING", 1).otherwise(0))
    return anomalies.groupBy(by).agg(worst.alias("_w")).select(by, F.when(F.col("_w") == 2, "blocked").when(F.col("_w") == 1, "usable_with_caveats").otherwise("usable").alias("verdict"))


def foreign_key(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str], sentinels: Sequence = ()) -> DataFrame:
    """One row: rows whose key isn't in the parent, and rows that hold a sentinel in any key column, counted apart. Null matches null."""
    keys = parent.select(*(F.col(c).alias(f"_p{k}") for k, c in enumerate(parent_columns))).distinct().withColumn("_there", F.lit(True))
    on = F.lit(True)
    for k, c in enumerate(columns):
        on &= F.col(c).eqNullSafe(F.col(f"_p{k}"))
    sentinel = F.lit(False)
    for c in columns:
        sentinel |= F.coalesce(F.col(c).isin(*sentinels), F.lit(False)) if sentinels else F.lit(False)
    met = child.select(*columns).withColumn("_sentinel", sentinel).join(keys, on, "left")
    return met.agg(F.count("*").alias("rows"), F.count_if("_sentinel").alias("sentinels"), F.count_if(~F.col("_sentinel") & F.col("_there").isNull()).alias("orphans"))


def media_reference(rows: DataFrame, key: str, media: DataFrame, path: str) -> DataFrame:
    """Keys of `rows` that are no file stem of the media table, with their rows."""
    stems = media.select(F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1).alias("_stem")).distinct()
    return rows.join(stems, F.col(key).cast("string") == F.col("_stem"), "left_anti").groupBy(F.col(key).cast("string").alias("media_key")).agg(F.count("*").alias("n"))


def contract_failures(rows: DataFrame, checks: Mapping[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """(check_name, failures) of a table's contract: conditions that must hold on every row (null fails), and columns that must be unique together."""
    counts = rows.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in checks.items()))
    out = counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failures")) for n in checks))).alias("r")).select("r.*")
    if unique:
        repeated = rows.groupBy(*unique).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failures"))
        out = out.unionByName(repeated.select(F.lit("unique_" + "_".join(unique)).alias("check_name"), "failures"))
    return out


def failure_cases(rows: DataFrame, keys: Sequence[str], types: Mapping[str, str] | None = None, checks: Mapping[str, tuple[str, Column]] | None = None, required: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """(keys, check_name, column_name, failure_case): every cell that breaks a table's contract, its value as text.

    `types` says what a column's text must be read as, null or not; `required` must not be null; `checks` are (column,
    condition) by name, which a null passes, as its column says whether it may be null; `unique` are columns that must be
    unique together, null being a value: every row of a repeated key fails. All but the last are one pass over the table;
    keys are counted first, so a frequent one is spread.
    """
    def case(name: str, column: str, bad: Column) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("failure_case")))

    cells = [case("not_null", c, F.col(c).isNull()) for c in required]
    cells += [case(f"type_{t}", c, F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c, t in (types or {}).items()]
    cells += [case(n, c, ~ok) for n, (c, ok) in (checks or {}).items()]
    found = F.array_compact(F.array(*cells)) if cells else F.array().cast("array<struct<check_name:string,column_name:string,failure_case:string>>")
    out = rows.select(*keys, F.explode(found).alias("_f")).select(*keys, "_f.*")
    for columns in unique:
        many = rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)))
        same = F.lit(True)
        for i, c in enumerate(columns):
            same &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
        value = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns))
        out = out.unionByName(rows.join(many, same, "left_semi").select(*keys, F.lit("unique").alias("check_name"), F.lit(",".join(columns)).alias("column_name"), value.alias("failure_case")))
    return out


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of every key that occurs more than once. Counts are taken before the rows are met again, so a frequent key is spread."""
    many = rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
    return rows.join(many, list(keys))


def exact_identity(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct-free shares of each side's rows whose columns occur on the other side."""
    def share(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        met = a.select(*columns).join(b.select(*columns).distinct().withColumn("_there", F.lit(True)), list(columns), "left")
        return met.agg(F.avg(F.when(F.col("_there"), 1.0).otherwise(0.0)).alias(f"{name}_share"), F.count("*").alias(f"{name}_rows"))

    return share(left, right, "left").crossJoin(share(right, left, "right"))  # one row each


def coverage(left: DataFrame, right: DataFrame, key: str, tolerance_s: float) -> DataFrame:
    """Each left interval with `covered`: whether it overlaps, strictly and within the tolerance, any right interval of its key.

    The last right start before the left end (plus tolerance) carries the greatest right end so far, which decides.
    """
    order = Window.partitionBy(key).orderBy("start_s", "end_s").rowsBetween(Window.unboundedPreceding, 0)
    reach = normalize(right).select(key, "start_s", F.max("end_s").over(order).alias("reach_s"))
    asks = left.withColumn("_until", F.col("end_s") + F.lit(tolerance_s))
    met = asof(asks, reach, [key], "_until", "start_s", ["reach_s"], strict=True, into="_r")
    return met.withColumn("covered", F.coalesce(F.col("_r.reach_s") > F.col("start_s") - F.lit(tolerance_s), F.lit(False))).drop("_until", "_r")


def reference_durations(rows: DataFrame, key: str, reference: DataFrame, value: Column, order: Sequence[str]) -> DataFrame:
    """Rows with `reference_s` of their key's first reference row in the given order, which should leave no ties."""
    first = reference.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias("reference_s"))
    return rows.join(first, key, "left")


def one_hot_split(rows: DataFrame, flags: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """`split` from flags of which exactly one must be true; other rows have a null split and `broken`."""
    n = sum((F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags), F.lit(0))
    split = F.coalesce(*(F.when(F.col(f), F.lit(label)) for f, label in zip(flags, labels, strict=True)))
    return rows.withColumn("broken", n != 1).withColumn("split", F.when(n == 1, split))


def fingerprint(rows: DataFrame) -> DataFrame:
    """(n, checksum): row count and an order-insensitive sum of row hashes."""
    return rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.struct(*sorted(rows.columns))).cast("decimal(38,0)")).alias("checksum"))


def staleness(recorded: DataFrame, current: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Artifacts whose recorded fields differ from the current ones, with the fields in order; `missing` where there is no current one."""
    now = current.select(key, *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_there"))
    met = recorded.join(now, key, "left")
    reasons = [F.when(F.col("_there").isNull(), "missing")] + [F.when(F.col("_there") & ~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]
    return met.select(key, F.array_join(F.array_compact(F.array(*reasons)), ",").alias("reasons")).filter("reasons <> ''")


def cross_source(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], tolerance_s: float, required: Sequence[str] = (), sentinels: Sequence = ()) -> DataFrame:
    """One row on two sources: rows that count, keys shared and on one side only, identical rows, and both directions of interval coverage.

    Rows with a null or sentinel key or a null in a required column don't count. Durations of intervals that the other
    side leaves uncovered are given as five quantiles, null if there are none.
    """
    def counted(rows: DataFrame) -> DataFrame:
        kept = rows.filter(F.col(key).isNotNull())
        if sentinels:
            kept = kept.filter(~F.col(key).isin(*sentinels))
        return kept.dropna(subset=list(required)) if required else kept

    left, right = counted(left), counted(right)
    keys = left.select(key).distinct().withColumn("_l", F.lit(True)).join(right.select(key).distinct().withColumn("_r", F.lit(True)), key, "full_outer")
    out = keys.agg(F.count_if(F.col("_l") & F.col("_r")).alias("shared_keys"), F.count_if(F.col("_r").isNull()).alias("left_only_keys"), F.count_if(F.col("_l").isNull()).alias("right_only_keys"))
    out = out.crossJoin(exact_identity(left, right, columns))  # one row each
    for a, b, name in ((left, right, "left"), (right, left, "right")):
        met = coverage(a.select(key, "start_s", "end_s"), b, key, tolerance_s)
        bare = F.when(~F.col("covered"), F.col("end_s") - F.col("start_s"))
        side = with_quantiles(met.agg(F.count_if("covered").alias(f"{name}_covered"), F.count(bare).alias(f"{name}_uncovered")), met.select(bare.alias("_q")), [], ["_q"])
        out = out.crossJoin(side.select(f"{name}_covered", f"{name}_uncovered", *(F.col("_q")[k].alias(f"{name}_uncovered_{n}_s") for k, n in enumerate(("min", "q05", "median", "q95", "max")))))  # one row
    return out


def population_scan(items: DataFrame, work: Callable[..., Mapping], schema: str) -> DataFrame:
    """`work(**item)` for each row of items, whose columns stay; `schema` types what it gives.

    An exception makes a failed row: probe_ok is false, probe_error names its type and message, the rest is null. So one bad
    item never ends a scan, and the number of rows stays.
    """
    given, made = items.schema, T.StructType.fromDDL(schema)
    out = T.StructType([*given.fields, *made.fields, T.StructField("probe_ok", T.BooleanType()), T.StructField("probe_error", T.StringType())])
    names, target = given.names, to_arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item in batch.to_pylist():
                try:
                    found, error = work(**item), None
                except Exception as failed:  # the point of the operator: any failure is a row
                    found, error = {}, f"{type(failed).__name__}: {failed}"
                rows.append({**{n: item[n] for n in names}, **{f.name: found.get(f.name) for f in made}, "probe_ok": error is None, "probe_error": error})
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return items.mapInArrow(scan, out)
