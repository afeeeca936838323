"""The decision grid: one row per complete slot, with the action it logs or the reason why it logs none."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.ranks import with_quantiles
from parley.operators.state import EPS, SILENT, SPEAKING, UNKNOWN, in_order, timeline_errors, transitions
from parley.sources.shared import saved

ONSET, OFFSET, NO_EVENT = "ONSET", "OFFSET", "NO_EVENT"
#: Fixed values, the most specific first.
MASK_REASONS = ("recording_start", "unknown_state", "unknown_within_slot", "compound_transition", "invalid_timeline")


def slot_index(time: Column, step_s: float) -> Column:
    """The slot [k * step, (k + 1) * step) of a time; one within EPS of a slot's end belongs to the next."""
    return F.floor((time + F.lit(EPS)) / F.lit(step_s)).cast("long")


def tau(event: Column, decision: Column, step_s: float) -> Column:
    """Seconds into the slot; what rounding puts just outside [0, step) is put back in."""
    raw = event - decision
    top = math.nextafter(step_s, 0.0)
    return F.when((raw < 0) & (raw >= -EPS), F.lit(0.0)).when((raw >= step_s) & (raw <= step_s + EPS), F.lit(top)).otherwise(raw)


def _limits(step_s: float) -> tuple[Column, Column]:
    """The first and last complete slot between the columns `_low` and `_high`."""
    first = F.ceil((F.col("_low") - F.lit(EPS)) / F.lit(step_s)).cast("long")
    return first, (F.floor((F.col("_high") + F.lit(EPS)) / F.lit(step_s)) - 1).cast("long")


def bounds(timeline: DataFrame, step_s: float) -> DataFrame:
    """(recording_id, first_index, slots, head_s, tail_s): complete slots of each timeline and the seconds left over at its ends."""
    span = timeline.groupBy("recording_id").agg(F.min("start_s").alias("_low"), F.max("end_s").alias("_high"))
    first, last = _limits(step_s)
    out = span.withColumn("first_index", first).withColumn("_last", last)
    out = out.withColumn("slots", F.greatest(F.lit(0).cast("long"), F.col("_last") - F.col("first_index") + 1))
    some = F.col("slots") > 0
    head = F.when(some, F.greatest(F.lit(0.0), F.col("first_index") * F.lit(step_s) - F.col("_low"))).otherwise(0.0)
    tail = F.when(some, F.greatest(F.lit(0.0), F.col("_high") - (F.col("_last") + 1) * F.lit(step_s))).otherwise(F.col("_high") - F.col("_low"))
    return out.select("recording_id", "first_index", "slots", head.alias("head_s"), tail.alias("tail_s"), F.col("_low").alias("timeline_start_s"))


def _given(rows: DataFrame, step_s: float, *more: str) -> DataFrame:
    """Each timeline row with the slots that it gives out, spread: (recording_id, decision_index, state_before, more).

    The first row whose end is at or after the slot's start (less EPS) holds the state before it, so each row gives out the slots
    between the end of the row before and its own end: no as-of join, one row per slot. The quotient may round either way, so
    the last index is corrected by one against the exact comparison. `rows` have `_low` and `_high` of their recording.
    """
    step, eps = F.lit(step_s), F.lit(EPS)

    def last_at(end: Column) -> Column:
        """The greatest k with k * step - EPS <= end."""
        k = F.floor((end + eps) / step).cast("long")
        return F.when((k + 1) * step - eps <= end, k + 1).when(k * step - eps <= end, k).otherwise(k - 1)

    order, (first, last) = in_order(), _limits(step_s)
    rows = rows.select("recording_id", "start_s", "state", *more, last_at(F.col("end_s")).alias("_upto"), F.lead("end_s").over(order).isNull().alias("_final"), first.alias("_least"), last.alias("_most"))
    since = F.greatest(F.coalesce(F.lag("_upto").over(order) + 1, F.col("_least")), F.col("_least"))
    rows = rows.withColumn("_since", since).withColumn("_till", F.when(F.col("_final"), F.col("_most")).otherwise(F.least("_upto", "_most"))).filter("_till >= _since")
    return rows.select("recording_id", F.explode(F.sequence("_since", "_till")).alias("decision_index"), F.col("state").alias("state_before"), *more)


def slots_with_state(timeline: DataFrame, step_s: float) -> DataFrame:
    """(recording_id, decision_index, state_before): the state just before each complete slot."""
    whole = Window.partitionBy("recording_id")
    return _given(timeline.withColumns({"_low": F.min("start_s").over(whole), "_high": F.max("end_s").over(whole)}), step_s)


def action_grid(timeline: DataFrame, step_s: float) -> DataFrame:
    """One row per complete slot: state before it, action, exact event time and tau, or a mask reason.

    A masked slot has no action. All slots of a timeline that has gaps, overlaps or empty rows are masked. The timeline is read once and
    all stays in the partition of its recording: changes are counted per slot on the timeline's rows, before slots are spread. A slot with
    changes is given out by the row that ends first in it, or, where rounding differs at an edge, by a neighbour of that row.
    """
    step, order, whole = F.lit(step_s), in_order(), Window.partitionBy("recording_id")
    before = F.lag("end_s").over(order)
    rows = timeline.select("recording_id", "start_s", "end_s", "state", F.lead("state").over(order).alias("_next"), ((F.col("end_s") <= F.col("start_s")) | F.coalesce(F.abs(F.col("start_s") - before) > EPS, F.lit(False))).alias("_wrong"))
    rows = rows.withColumns({"_low": F.min("start_s").over(whole), "_high": F.max("end_s").over(whole), "bad": F.bool_or("_wrong").over(whole)})
    changed = F.coalesce(F.col("state") != F.col("_next"), F.lit(False))
    resolved = changed & (F.col("state") != UNKNOWN) & (F.col("_next") != UNKNOWN)
    rows = rows.withColumn("_slot", slot_index(F.col("end_s"), step_s))
    each = Window.partitionBy("recording_id", "_slot")
    own = F.struct(
        F.col("_slot").alias("slot"),
        F.count_if(resolved).over(each).alias("changes"),
        F.bool_or(changed & ~resolved).over(each).alias("unknown_change"),
        F.min(F.when(resolved, F.struct(F.col("end_s").alias("time_s"), F.col("_next").alias("after")))).over(each).alias("change"),
    )
    rows = rows.withColumn("_own", own).withColumns({"_earlier": F.lag("_own").over(order), "_later": F.lead("_own").over(order)})
    rows = _given(rows, step_s, "bad", "_low", "_own", "_earlier", "_later")
    k = F.col("decision_index")
    met = F.when(F.col("_own.slot") == k, F.col("_own")).when(F.col("_earlier.slot") == k, F.col("_earlier")).when(F.col("_later.slot") == k, F.col("_later"))
    rows = rows.select("recording_id", "decision_index", "state_before", "bad", F.col("_low").alias("timeline_start_s"), met.alias("_met")).select("*", "_met.changes", "_met.unknown_change", "_met.change")
    rows = rows.withColumn("decision_time_s", F.col("decision_index") * step)
    changes = F.coalesce("changes", F.lit(0))
    reason = (
        F.when(F.col("bad"), MASK_REASONS[4])
        .when(F.col("decision_time_s") <= F.col("timeline_start_s") + F.lit(EPS), MASK_REASONS[0])
        .when(F.col("state_before") == UNKNOWN, MASK_REASONS[1])
        .when(F.col("unknown_change"), MASK_REASONS[2])
        .when(changes > 1, MASK_REASONS[3])
    )
    rows = rows.withColumn("mask_reason", reason)
    valid = F.col("mask_reason").isNull()
    event = F.when(valid & (changes == 1), F.col("change.time_s"))
    action = F.when(valid, F.when(changes == 0, NO_EVENT).when(F.col("change.after") == SPEAKING, ONSET).otherwise(OFFSET))
    return rows.select(
        "recording_id",
        "decision_index",
        "decision_time_s",
        (F.col("decision_time_s") + step).alias("slot_end_s"),
        F.when(F.col("bad"), UNKNOWN).otherwise(F.col("state_before")).alias("state_before"),
        action.alias("action"),
        valid.alias("action_valid"),
        event.alias("event_time_s"),
        tau(event, F.col("decision_time_s"), step_s).alias("tau_s"),
        "mask_reason",
    )


def compound_slots(timeline: DataFrame, step_s: float) -> DataFrame:
    """Slots of the grid with several resolved changes: their times and kinds in order, the state after, and the pattern."""
    rows = transitions(timeline).filter("resolved").withColumn("decision_index", slot_index(F.col("time_s"), step_s))
    kind = F.when(F.col("after") == SPEAKING, ONSET).otherwise(OFFSET)
    many = rows.groupBy("recording_id", "decision_index").agg(F.sort_array(F.collect_list(F.struct("time_s", kind.alias("kind"), "after"))).alias("e")).filter(F.size("e") > 1)
    inside = bounds(timeline, step_s)
    many = many.join(inside, "recording_id").filter((F.col("decision_index") >= F.col("first_index")) & (F.col("decision_index") < F.col("first_index") + F.col("slots")))
    return many.select(
        "recording_id",
        "decision_index",
        F.size("e").alias("changes"),
        F.transform("e", lambda x: x["time_s"]).alias("times_s"),
        F.array_join(F.transform("e", lambda x: x["kind"]), ">").alias("pattern"),
        F.element_at("e", -1)["after"].alias("state_after"),
    )


def sub_step_gaps(timeline: DataFrame, step_s: float) -> DataFrame:
    """Silences shorter than a step between two speeches, with the slots of their ends and whether both are in the grid."""
    order = in_order()
    rows = timeline.withColumn("_was", F.lag("state").over(order)).withColumn("_next", F.lead("state").over(order))
    rows = rows.filter((F.col("state") == SILENT) & (F.col("_was") == SPEAKING) & (F.col("_next") == SPEAKING) & (F.col("end_s") - F.col("start_s") < step_s - EPS))
    rows = rows.join(bounds(timeline, step_s), "recording_id")
    offset, onset = slot_index(F.col("start_s"), step_s), slot_index(F.col("end_s"), step_s)
    return rows.select(
        "recording_id",
        (F.col("end_s") - F.col("start_s")).alias("gap_s"),
        F.col("start_s").alias("offset_s"),
        F.col("end_s").alias("onset_s"),
        offset.alias("offset_slot"),
        onset.alias("onset_slot"),
        (offset != onset).alias("cross_slot"),
        ((F.col("slots") > 0) & (offset >= F.col("first_index")) & (onset <= F.col("first_index") + F.col("slots") - 1)).alias("within_grid"),
    )


def summary(grid: DataFrame) -> DataFrame:
    """Per recording: slots, valid slots, slots per action, per state before and per mask reason."""
    counts = [F.count_if(F.col("action") == a).alias(a.lower()) for a in (NO_EVENT, ONSET, OFFSET)]
    counts += [F.count_if(F.col("state_before") == s).alias(f"before_{s.lower()}") for s in (SPEAKING, SILENT, UNKNOWN)]
    counts += [F.count_if(F.col("mask_reason") == m).alias(m) for m in MASK_REASONS]
    return grid.groupBy("recording_id").agg(F.count("*").alias("slots"), F.count_if("action_valid").alias("valid_slots"), F.min("decision_index").alias("first_index"), F.max("decision_index").alias("last_index"), *counts)


#: What differs between a timeline's grid and another's.
DELTAS = ("compound_slots", "compound_transitions", "source_transitions", "represented_transitions", "masked_transitions", "valid_slots")


def timeline_summary(timeline: DataFrame, step_s: float) -> DataFrame:
    """Per recording: slots by validity, action, state before and mask reason; what becomes of the timeline's resolved transitions; gaps shorter than a step; seconds left over; why a timeline can't be gridded.

    Transitions are represented by a slot's action, masked, or outside the grid. `timeline` is read several times: write it first where it is costly.
    """
    slots = summary(action_grid(timeline, step_s)).withColumn("masked_slots", F.col("slots") - F.col("valid_slots")).withColumn("represented_transitions", F.col("onset") + F.col("offset"))
    limits = bounds(timeline, step_s)
    moves = transitions(timeline).filter("resolved").withColumn("_slot", slot_index(F.col("time_s"), step_s)).join(limits, "recording_id")
    inside = (F.col("_slot") >= F.col("first_index")) & (F.col("_slot") < F.col("first_index") + F.col("slots"))
    counted = moves.groupBy("recording_id").agg(F.count("*").alias("source_transitions"), F.count_if(~inside).alias("transitions_outside_grid"))
    compound = compound_slots(timeline, step_s).groupBy("recording_id").agg(F.count("*").alias("compound_slots"), F.sum("changes").alias("compound_transitions"))
    gaps = sub_step_gaps(timeline, step_s).groupBy("recording_id").agg(F.count("*").alias("short_gaps"), F.count_if("cross_slot").alias("short_gaps_across_slots"), F.count_if(~F.col("cross_slot")).alias("short_gaps_within_a_slot"))
    out = limits.select("recording_id", F.col("head_s").alias("leading_dropped_s"), F.col("tail_s").alias("trailing_dropped_s"))
    for part in (slots, counted, compound, gaps):
        out = out.join(part, "recording_id", "left")
    names = [c for c in out.columns if c not in ("recording_id", "leading_dropped_s", "trailing_dropped_s", "first_index", "last_index")]
    out = out.fillna(0, names).withColumn("masked_transitions", F.col("source_transitions") - F.col("represented_transitions") - F.col("transitions_outside_grid"))
    return out.join(timeline_errors(timeline).withColumnRenamed("error", "invalid_timeline_reason"), "recording_id", "left")


def layer_deltas(native: DataFrame, control: DataFrame) -> DataFrame:
    """(statistic, native, control, delta) of the sums of two timelines' summaries, and the recordings with a compound slot."""
    def sums(rows: DataFrame, name: str) -> DataFrame:
        one = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in DELTAS), F.count_if(F.col("compound_slots") > 0).alias("recordings_with_compound_slot"))
        return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("statistic"), F.col(c).alias(name)) for c in one.columns))).alias("r")).select("r.*")

    return sums(native, "native").join(sums(control, "control"), "statistic").withColumn("delta", F.col("control") - F.col("native"))


def pattern_counts(timeline: DataFrame, step_s: float) -> DataFrame:
    """(pattern, changes, slots): how often each order of onsets and offsets makes a slot compound."""
    return compound_slots(timeline, step_s).groupBy("pattern", "changes").agg(F.count("*").alias("slots"))


def statistics(grid: DataFrame, by: str = "state_before") -> DataFrame:
    """Slots, share of valid ones and quantiles of tau, for each state before and action."""
    rows = saved(grid.select(by, F.coalesce("action", F.lit("-")).alias("action"), "action_valid", "tau_s"), "grid")
    counts = rows.groupBy(by, "action").agg(F.count("*").alias("slots"), F.avg(F.col("action_valid").cast("double")).alias("valid_share"))
    out = with_quantiles(counts, rows.withColumnRenamed("tau_s", "q"), [by, "action"], ["q"])
    names = ("tau_min_s", "tau_q05_s", "tau_median_s", "tau_q95_s", "tau_max_s")
    return out.select(by, "action", "slots", "valid_share", *(F.col("q")[k].alias(n) for k, n in enumerate(names)))


def compare_layers(native: DataFrame, control: DataFrame, step_s: float) -> DataFrame:
    """The grid's counts on both timelines, side by side."""
    layers = [summary(action_grid(t, step_s)).withColumn("layer", F.lit(name)) for name, t in (("native", native), ("control", control))]
    both = layers[0].unionByName(layers[1])
    sums = [c for c in both.columns if c not in ("recording_id", "layer", "first_index", "last_index")]
    return both.groupBy("layer").agg(*(F.sum(c).alias(c) for c in sums))


def grid_violations(grid: DataFrame, step_s: float) -> DataFrame:
    """(rule, n): rows that break what a grid promises; a sound grid has 0 everywhere."""
    order = Window.partitionBy("recording_id").orderBy("decision_index")
    rows = grid.withColumn("_was", F.lag("decision_index").over(order))
    event = F.col("action").isin(ONSET, OFFSET)
    rules = {
        "index_not_consecutive": F.col("decision_index") != F.col("_was") + 1,
        "masked_with_action": ~F.col("action_valid") & F.col("action").isNotNull(),
        "valid_without_action": F.col("action_valid") & F.col("action").isNull(),
        "valid_with_reason": F.col("action_valid") & F.col("mask_reason").isNotNull(),
        "event_without_time": event & F.col("event_time_s").isNull(),
        "tau_outside_slot": (F.col("tau_s") < 0) | (F.col("tau_s") >= step_s),
        "onset_while_speaking": (F.col("action") == ONSET) & (F.col("state_before") == SPEAKING) & (F.col("tau_s") > EPS),
    }
    counts = rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules))).alias("r")).select("r.*")


def by_recording(grid: DataFrame) -> DataFrame:
    """The grid dealt by recording, each in the order of its slots, with the slot's zero-based place in it."""
    order = Window.partitionBy("recording_id").orderBy("decision_index")
    return grid.withColumn("place", F.row_number().over(order) - 1)
