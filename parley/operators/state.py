"""The wearer's SPEAKING / SILENT / UNKNOWN timeline, and its requantization at a control step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.intervals import clip, islands, normalize

EPS = 1e-9
#: The three states and what a row's state rests on.
SPEAKING, SILENT, UNKNOWN = "SPEAKING", "SILENT", "UNKNOWN"
NATIVE_KIND, INVALID_KIND = "native_annotation", "invalid_or_missing"
BRIDGE_KIND = "sub_step_silence_bridge"

KEY = ["recording_id"]


def in_order() -> Window:
    return Window.partitionBy("recording_id").orderBy("start_s")


def native_timeline(recordings: DataFrame, speech: DataFrame, unknown: DataFrame) -> DataFrame:
    """(recording_id, native_index, start_s, end_s, state, source_kind, annotation_ids): each recording's whole window.

    UNKNOWN goes before SPEAKING goes before SILENT. A row has the sorted ids of the annotations that cover it, joined
    by a pipe; neighbours are one row only if state, kind and ids are the same. Annotations are shuffled once, by recording.
    """
    window = recordings.select("recording_id", F.col("start_s").alias("_low"), F.col("end_s").alias("_high"), F.col("wearer_id").alias("_wearer"))
    columns, nobody = ["recording_id", "start_s", "end_s", "annotation_id"], F.lit(None).cast("string").alias("participant_id")
    marks = normalize(speech).select(*columns, "participant_id", F.lit(False).alias("bad")).unionByName(normalize(unknown).select(*columns, nobody, F.lit(True).alias("bad")))
    whole = recordings.filter("end_s > start_s").select("recording_id", "start_s", "end_s", nobody, F.lit(None).cast("boolean").alias("bad"))
    marks = marks.unionByName(whole, allowMissingColumns=True)
    # A fixed number of partitions isn't coalesced: the rows are few here, but many once a grid is made of them.
    parts = int(recordings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = marks.repartition(parts, "recording_id").join(window.hint("merge"), "recording_id").filter(F.col("bad").isNull() | F.col("bad") | (F.col("participant_id") == F.col("_wearer")))
    met = clip(met, F.col("_low"), F.col("_high")).select(*columns, "bad")

    # Each mark's ends are numbered among all ends; it then gives out its two ends and its id once for every piece between them.
    ends = met.select("*", F.explode(F.array("start_s", "end_s")).alias("_t"))
    ends = ends.withColumn("_at", F.dense_rank().over(Window.partitionBy("recording_id").orderBy("_t")) - 1)
    own = ends.groupBy(*columns, "bad").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))

    def given(at: Column, time: Column | None = None) -> Column:
        ids = (F.when(F.col("bad") == b, F.col("annotation_id")) if time is None else F.lit(None).cast("string") for b in (True, False))
        return F.struct(at.alias("ordinal"), (F.lit(None).cast("double") if time is None else time).alias("start_s"), *(i.alias(n) for i, n in zip(ids, ("bad_id", "own_id"), strict=True)))

    covered = F.when(F.col("bad").isNotNull(), F.transform(F.sequence("_first", F.col("_last") - 1), lambda k: given(k)))
    two = F.array(given(F.col("_first"), F.col("start_s")), given(F.col("_last"), F.col("end_s")))
    cut = own.select("recording_id", F.explode(F.when(covered.isNull(), two).otherwise(F.concat(two, covered))).alias("p")).select("recording_id", "p.*")
    cut = cut.groupBy("recording_id", "ordinal").agg(F.max("start_s").alias("start_s"), *(F.sort_array(F.collect_set(f"{n}_id")).alias(f"{n}_ids") for n in ("bad", "own")))
    cut = cut.withColumn("end_s", F.lead("start_s").over(Window.partitionBy("recording_id").orderBy("ordinal"))).filter("end_s IS NOT NULL")
    bad, spoken = F.size("bad_ids") > 0, F.size("own_ids") > 0
    rows = cut.select(
        "recording_id",
        "start_s",
        "end_s",
        F.when(bad, UNKNOWN).when(spoken, SPEAKING).otherwise(SILENT).alias("state"),
        F.when(bad, INVALID_KIND).otherwise(NATIVE_KIND).alias("source_kind"),
        F.when(bad, F.array_join("bad_ids", "|")).when(spoken, F.array_join("own_ids", "|")).alias("annotation_ids"),
    )
    rows = islands(rows, KEY, ["state", "source_kind", "annotation_ids"])
    return rows.withColumn("native_index", F.row_number().over(in_order()) - 1)


def durations(timeline: DataFrame, short_s: float = 0.1) -> DataFrame:
    """Per recording: seconds, shares and rows of each state, and silences shorter than `short_s`."""
    length = F.col("end_s") - F.col("start_s")
    parts = []
    for state in (SPEAKING, SILENT, UNKNOWN):
        name = state.lower()
        mine = F.when(F.col("state") == state, length)
        parts += [F.coalesce(F.sum(mine), F.lit(0.0)).alias(f"{name}_s"), F.count(mine).alias(f"{name}_rows")]
    out = timeline.groupBy("recording_id").agg(F.sum(length).alias("total_s"), *parts, F.count_if((F.col("state") == SILENT) & (length < short_s)).alias("short_silences"))
    for state in (SPEAKING, SILENT, UNKNOWN):
        out = out.withColumn(f"{state.lower()}_share", F.when(F.col("total_s") > 0, F.col(f"{state.lower()}_s") / F.col("total_s")))
    return out


def unknown_reasons(timeline: DataFrame) -> DataFrame:
    """How many UNKNOWN rows each source of annotations has a part in: ids split at the pipe, what follows the # off."""
    ids = timeline.filter(F.col("state") == UNKNOWN).select(F.explode(F.split("annotation_ids", r"\|")).alias("id"))
    return ids.groupBy(F.substring_index("id", "#", 1).alias("reason")).agg(F.count("*").alias("n"))


def _bridged(step_s: float) -> Column:
    """Whether a row is a silence shorter than a step between two abutting speeches. Such rows never touch, so this is local."""
    order = in_order()
    before, after = (f(F.struct("state", "start_s", "end_s")).over(order) for f in (F.lag, F.lead))
    return F.coalesce(
        (F.col("state") == SILENT)
        & (before["state"] == SPEAKING)
        & (after["state"] == SPEAKING)
        & (F.abs(F.col("start_s") - before["end_s"]) <= EPS)
        & (F.abs(after["start_s"] - F.col("end_s")) <= EPS)
        & (F.col("end_s") - F.col("start_s") < step_s - EPS),
        F.lit(False),
    )


def bridged_gaps(timeline: DataFrame, step_s: float) -> DataFrame:
    """(recording_id, native_index, gap_start_s, gap_end_s, gap_s): each silence that the control timeline bridges."""
    gaps = timeline.withColumn("_bridged", _bridged(step_s)).filter("_bridged")
    return gaps.select("recording_id", "native_index", F.col("start_s").alias("gap_start_s"), F.col("end_s").alias("gap_end_s"), (F.col("end_s") - F.col("start_s")).alias("gap_s"))


def control_timeline(timeline: DataFrame, step_s: float) -> DataFrame:
    """The native timeline with silences shorter than a step bridged; chains of them become one SPEAKING row.

    A row begins a group unless it, or the row before it, is bridged.
    """
    order = in_order()
    rows = timeline.withColumn("_bridged", _bridged(step_s))
    joins = F.col("_bridged") | F.coalesce(F.lag("_bridged").over(order), F.lit(False))
    rows = rows.withColumn("_new", F.when(joins, 0).otherwise(1))
    rows = rows.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    gap = F.when(F.col("_bridged"), F.col("end_s") - F.col("start_s"))
    ids = F.array_distinct(F.flatten(F.collect_list(F.split("annotation_ids", r"\|"))))
    out = rows.groupBy("recording_id", "_group").agg(
        F.min("start_s").alias("start_s"),
        F.max("end_s").alias("end_s"),
        F.min_by("state", "start_s").alias("state"),
        F.min_by("source_kind", "start_s").alias("source_kind"),
        F.array_join(F.sort_array(ids), "|").alias("_ids"),
        F.min("native_index").alias("first_native_index"),
        F.max("native_index").alias("last_native_index"),
        F.count(gap).alias("bridged_gaps"),
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("bridged_s"),
    )
    out = out.withColumn("annotation_ids", F.when(F.col("_ids") != "", F.col("_ids")))
    return out.withColumn("transform_kind", F.when(F.col("bridged_gaps") > 0, BRIDGE_KIND)).drop("_group", "_ids")


def transitions(timeline: DataFrame) -> DataFrame:
    """(recording_id, time_s, before, after, resolved): state changes; those from or to UNKNOWN are not resolved."""
    order = in_order()
    rows = timeline.select("recording_id", F.lag("end_s").over(order).alias("time_s"), F.lag("state").over(order).alias("before"), F.col("state").alias("after"), "start_s")
    rows = rows.filter("before <> after").drop("start_s")
    return rows.withColumn("resolved", (F.col("before") != UNKNOWN) & (F.col("after") != UNKNOWN))


def resolved_transitions(timeline: DataFrame) -> DataFrame:
    """Per recording the number of changes between SILENT and SPEAKING."""
    return timeline.withColumn("_was", F.lag("state").over(in_order())).groupBy("recording_id").agg(
        F.count_if((F.col("_was") != F.col("state")) & (F.col("_was") != UNKNOWN) & (F.col("state") != UNKNOWN)).alias("transitions")
    )


def control_summary(native: DataFrame, control: DataFrame, step_s: float) -> DataFrame:
    """Per recording: rows, transitions and SPEAKING seconds before and after, gaps bridged and their five-point quantiles."""
    def side(of: DataFrame, name: str) -> DataFrame:
        spoken = F.when(F.col("state") == SPEAKING, F.col("end_s") - F.col("start_s"))
        counts = of.groupBy("recording_id").agg(F.count("*").alias(f"{name}_rows"), F.coalesce(F.sum(spoken), F.lit(0.0)).alias(f"{name}_speaking_s"))
        return counts.join(resolved_transitions(of).withColumnRenamed("transitions", f"{name}_transitions"), "recording_id")

    gaps = bridged_gaps(native, step_s).groupBy("recording_id").agg(
        F.count("*").alias("gaps"), F.sum("gap_s").alias("gaps_s"), F.percentile("gap_s", F.array(*(F.lit(q) for q in (0.0, 0.05, 0.5, 0.95, 1.0)))).alias("q")
    )
    out = side(native, "native").join(side(control, "control"), "recording_id").join(gaps, "recording_id", "left")
    quantiles = [F.col("q")[k].alias(n) for k, n in enumerate(("gap_min_s", "gap_q05_s", "gap_median_s", "gap_q95_s", "gap_max_s"))]
    rest = ["recording_id", *(f"{s}_{c}" for s in ("native", "control") for c in ("rows", "speaking_s", "transitions"))]
    return out.select(*rest, F.coalesce("gaps", F.lit(0)).alias("gaps"), F.coalesce("gaps_s", F.lit(0.0)).alias("gaps_s"), *quantiles)


def gap_histogram(gaps: DataFrame, step_s: float, bins: int = 10) -> DataFrame:
    """How many bridged gaps fall in each tenth of [0, step)."""
    bin_ = F.least(F.greatest(F.floor(F.col("gap_s") / F.lit(step_s / bins)), F.lit(0)), F.lit(bins - 1))
    return gaps.groupBy(bin_.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def timeline_errors(timeline: DataFrame) -> DataFrame:
    """(recording_id, error) of timelines that can't be gridded: a row without length, or a gap or overlap between two."""
    order = in_order()
    rows = timeline.withColumn("_was", F.lag("end_s").over(order)).groupBy("recording_id").agg(
        F.bool_or(F.col("end_s") <= F.col("start_s")).alias("_short"), F.coalesce(F.bool_or(F.abs(F.col("start_s") - F.col("_was")) > EPS), F.lit(False)).alias("_apart")
    )
    error = F.when(F.col("_short"), "non-increasing interval").when(F.col("_apart"), "gap or overlap between intervals")
    return rows.select("recording_id", error.alias("error")).filter("error IS NOT NULL")
