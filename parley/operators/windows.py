"""The index of training windows over a decision grid, and its splits."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.grid import OFFSET, ONSET


@dataclass(frozen=True)
class WindowSpec:
    """Window lengths in steps, and the least shares of valid slots."""

    min_context: int
    max_context: int
    future: int
    min_context_valid: float = 0.90
    min_future_valid: float = 1.0

    @classmethod
    def of_seconds(cls, step_s: float, min_context_s: float, max_context_s: float, future_s: float, **shares: float) -> WindowSpec:
        """Whole steps that cover the seconds."""
        return cls(*(math.ceil(s / step_s - 1e-9) for s in (min_context_s, max_context_s, future_s)), **shares)


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """`rows` with a global zero-based `row_number` in the order of (key, order): numbers within a key plus the rows of the keys before it."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    # One row per key, so the running total over all keys is small next to the rows.
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return rows.join(before, key).withColumn("row_number", F.col("_before") + own).drop("_before")


def segments(grid: DataFrame) -> DataFrame:
    """The grid with `segment`: runs of consecutive decision_index."""
    order = Window.partitionBy("recording_id").orderBy("decision_index")
    return grid.withColumn("segment", F.col("decision_index") - F.row_number().over(order))


def _counted(grid: DataFrame, spec: WindowSpec, *more: str) -> DataFrame:
    """The anchors with their counts of valid slots and events, and `more` columns of the grid; `segment_id` counts segments from 0 in a recording, `place` its slots.

    Counts over a window are differences of running counts: a frame of fixed length would be added up anew for each row.
    """
    valid = F.coalesce(F.col("action_valid").cast("int"), F.lit(0)).alias("_valid")
    event = F.coalesce(F.col("action").isin(ONSET, OFFSET), F.lit(False)).cast("int").alias("_event")
    every, own = Window.partitionBy("recording_id").orderBy("decision_index"), Window.partitionBy("recording_id", "segment").orderBy("decision_index")
    rows = grid.select("recording_id", "decision_index", *more, valid, event).withColumn("place", F.row_number().over(every) - 1)
    rows = rows.withColumn("segment", F.col("decision_index") - F.col("place") - 1)
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"position": F.row_number().over(own) - 1, "_valid": F.sum("_valid").over(so_far), "_event": F.sum("_event").over(so_far)})
    before = F.coalesce(F.lag("_valid", spec.max_context).over(own), F.lit(0))
    rows = rows.withColumns({
        "_context": F.col("_valid") - before,
        "_future": F.lead("_valid", spec.future).over(own) - F.col("_valid"),
        "future_events": F.lead("_event", spec.future).over(own) - F.col("_event"),
        "segment_id": F.dense_rank().over(Window.partitionBy("recording_id").orderBy("segment")) - 1,
    })
    rows = rows.withColumn("context_steps", F.least(F.col("position") + 1, F.lit(spec.max_context)))
    return rows.filter((F.col("position") + 1 >= spec.min_context) & F.col("_future").isNotNull())  # null: the segment ends before the future does


def anchors(grid: DataFrame, spec: WindowSpec) -> DataFrame:
    """Slots with enough context and a whole future in their segment: context steps, valid shares, future events, class, whether trainable."""
    return _judged(_counted(grid, spec), spec).select("recording_id", "decision_index", "segment", "position", "context_steps", "context_valid", "future_valid", "future_events", "sample_class", "trainable")


def _judged(rows: DataFrame, spec: WindowSpec) -> DataFrame:
    rows = rows.withColumn("context_valid", F.col("_context") / F.col("context_steps")).withColumn("future_valid", F.col("_future") / F.lit(spec.future))
    trainable = (F.col("context_valid") >= spec.min_context_valid) & (F.col("future_valid") >= spec.min_future_valid)
    return rows.withColumns({"sample_class": F.when(F.col("future_events") > 0, "event").otherwise("background"), "trainable": trainable})


#: Versions of the layout of the index and of the actions that it counts.
WINDOW_VERSION, ACTION_VERSION = 1, 1


def build_index(grid: DataFrame, recordings: DataFrame, splits: DataFrame, spec: WindowSpec) -> DataFrame:
    """The index that training reads: every anchor with its identity, its place in the canonical grid and in its segment, its shares, class and split.

    `recordings` have (dataset, recording_id, conversation_id, view_id, wearer_id); a recording without a conversation is its own.
    `anchor_row` is the anchor's zero-based row in the grid sorted by recording and decision_index; segments count from 0 in a recording.
    """
    counts = grid.groupBy("recording_id").agg(F.count("*").alias("_n"))
    # One row per recording, as in `numbered`; all that is known of a recording meets its anchors in one join.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("recording_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = recordings.select("dataset", "recording_id", F.coalesce("conversation_id", "recording_id").alias("conversation_id"), "view_id", "wearer_id")
    known = counts.select("recording_id", before.alias("_before")).join(known, "recording_id").join(splits.select("recording_id", "split", "split_source"), "recording_id", "left")
    rows = _judged(_counted(grid, spec, "decision_time_s"), spec).join(known, "recording_id").withColumn("row_number", F.col("_before") + F.col("place"))
    return rows.select(
        F.concat_ws("#", "recording_id", "decision_index").alias("sample_id"), "dataset", "recording_id", "conversation_id", "view_id", "wearer_id", "split", "segment_id",
        F.col("decision_index").alias("anchor_idx"), F.col("decision_time_s").alias("anchor_time"), F.col("row_number").alias("anchor_row"), F.col("context_steps").alias("max_context_steps"), F.lit(spec.future).alias("future_steps"),
        F.col("context_valid").alias("context_valid_ratio"), F.col("future_valid").alias("future_valid_ratio"), F.col("future_events").alias("future_event_count"), "sample_class", F.col("trainable").alias("is_trainable"), "split_source",
        F.lit(WINDOW_VERSION).alias("window_schema_version"), F.lit(ACTION_VERSION).alias("action_schema_version"),
    )


def normal_split(split: Column) -> Column:
    """A split's usual name: trimmed, lower case, val / valid / dev as validation; blanks, nan and none as null."""
    name = F.lower(F.trim(split))
    return F.when(name.isin("", "nan", "none"), None).when(name.isin("val", "valid", "dev"), "validation").otherwise(name)


def first_split(rows: DataFrame) -> DataFrame:
    """Each recording's first split by source_row."""
    return rows.filter("split IS NOT NULL").groupBy("recording_id").agg(F.min_by("split", "source_row").alias("split"))


def fallback_splits(conversations: DataFrame, seed: str, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """(conversation_id, split): conversations in the order of a seeded hash, the first 80 % train, the next 10 % validation, the rest test.

    Counts are rounded half to even. The hash order takes the place of a random permutation, so the members
    are fixed by the seed on any cluster.
    """
    ids = conversations.select("conversation_id").filter("conversation_id IS NOT NULL").distinct()
    hashed = ids.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), "conversation_id").cast("binary"))).withColumn("_range", F.substring("_hash", 1, 3))
    # Ranks within ranges of the hash, plus the rows of the ranges before: 4096 counts are all that one task has to see.
    before, whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = hashed.groupBy("_range").agg(F.count("*").alias("_in"))
    counts = counts.select("_range", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"), F.sum("_in").over(whole).alias("_n"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_hash"))
    ranked = hashed.withColumn("_own", own).join(counts, "_range").withColumn("_rank", F.col("_before") + F.col("_own"))
    to_train, to_validation = F.bround(F.col("_n") * train), F.bround(F.col("_n") * validation)
    split = F.when(F.col("_rank") <= to_train, "train").when(F.col("_rank") <= to_train + to_validation, "validation").otherwise("test")
    return ranked.select("conversation_id", split.alias("split"))


def assign_splits(recordings: DataFrame, upstream: DataFrame, seed: str) -> DataFrame:
    """Each recording's split and where it comes from: upstream if given, else by conversation among the recordings without one."""
    given = first_split(upstream.withColumn("split", normal_split(F.col("split"))))
    rows = recordings.select("recording_id", F.coalesce("conversation_id", "recording_id").alias("conversation_id")).join(given, "recording_id", "left")
    own = fallback_splits(rows.filter("split IS NULL"), seed).withColumnRenamed("split", "_own")
    rows = rows.join(own, "conversation_id", "left")
    source = F.when(F.col("split").isNotNull(), "upstream").otherwise("fallback")
    return rows.select("recording_id", "conversation_id", F.coalesce("split", "_own").alias("split"), source.alias("split_source"))


def split_leakage(splits: DataFrame) -> DataFrame:
    """Conversations that lie in more than one split."""
    out = splits.groupBy("conversation_id").agg(F.array_sort(F.collect_set("split")).alias("splits"))
    return out.filter(F.size("splits") > 1).withColumn("splits", F.array_join("splits", ","))


def index_summary(index: DataFrame) -> DataFrame:
    """Per recording: anchors, trainable ones, events, segments, first and last slot, mean share of valid context."""
    return index.groupBy("recording_id").agg(
        F.count("*").alias("anchors"),
        F.count_if("trainable").alias("trainable"),
        F.count_if(F.col("sample_class") == "event").alias("events"),
        F.count_distinct("segment").alias("segments"),
        F.min("decision_index").alias("first_index"),
        F.max("decision_index").alias("last_index"),
        F.avg("context_valid").alias("mean_context_valid"),
    )


def index_statistics(index: DataFrame, splits: DataFrame) -> DataFrame:
    """Anchors by split, by split and class, and in all, in one pass over grouping sets; null marks 'all'."""
    # A recording's anchors are counted first: what meets the splits and is told apart is a row per recording and class.
    some = index.groupBy("recording_id", "sample_class").agg(F.count("*").alias("_n"), F.count_if("trainable").alias("_trainable"), F.sum("future_valid").alias("_future"), F.count("future_valid").alias("_futures"))
    rows = some.join(splits.select("recording_id", "split"), "recording_id")
    out = rows.groupingSets([[F.col("split"), F.col("sample_class")], [F.col("split")], []], F.col("split"), F.col("sample_class")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("anchors"), F.coalesce(F.sum("_trainable"), F.lit(0)).alias("trainable"), F.count_distinct("recording_id").alias("recordings"), (F.sum("_future") / F.nullif(F.sum("_futures"), F.lit(0))).alias("mean_future_valid")
    )
    return out


def context_histogram(index: DataFrame, splits: DataFrame) -> DataFrame:
    """(split, context_steps, anchors, trainable): how many anchors have a context of each length; most have the longest."""
    rows = index.join(splits.select("recording_id", "split"), "recording_id")
    return rows.groupBy("split", "context_steps").agg(F.count("*").alias("anchors"), F.count_if("trainable").alias("trainable"))


#: Anchors whose windows are cut from one array.
BLOCK = 1024


def reconstruct(grid: DataFrame, spec: WindowSpec, block: int = BLOCK) -> DataFrame:
    """Each anchor with its window read back: actions of the context that ends at it, and of the future after it.

    A segment is cut into blocks of anchors; a block gathers its slots once, with as many before and after as its windows
    reach, and each window is a slice of that array.
    """
    own, whole = Window.partitionBy("recording_id", "segment").orderBy("decision_index"), Window.partitionBy("recording_id", "segment")
    rows = segments(grid).select("recording_id", "segment", "decision_index", F.coalesce("action", F.lit("masked")).alias("mark"))
    rows = rows.withColumn("position", F.row_number().over(own) - 1).withColumn("_n", F.count("*").over(whole))
    first, last = F.floor((F.col("position") - spec.future) / block), F.floor((F.col("position") + spec.max_context - 1) / block)
    dealt = rows.withColumn("block", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)))
    gathered = dealt.groupBy("recording_id", "segment", "block").agg(F.sort_array(F.collect_list(F.struct("position", "decision_index", "mark"))).alias("_slots"), F.first("_n").alias("_n"))
    marks = F.transform("_slots", lambda s: s["mark"])

    def of_block(slot: Column) -> Column:
        at = slot["position"]
        return (F.floor(at / block) == F.col("block")) & (at + 1 >= spec.min_context) & (at + spec.future < F.col("_n"))

    def window(slot: Column) -> Column:
        at = slot["position"] - F.col("_slots")[0]["position"]  # its place in the array, from 0
        steps = F.least(slot["position"] + 1, F.lit(spec.max_context))
        return F.struct(slot["decision_index"].alias("decision_index"), F.slice("_marks", at - steps + 2, steps).alias("context"), F.slice("_marks", at + 2, F.lit(spec.future)).alias("future"))

    cut = gathered.withColumn("_marks", marks).select("recording_id", F.explode(F.transform(F.filter("_slots", of_block), window)).alias("w"))
    return cut.select("recording_id", "w.decision_index", "w.context", "w.future")


def index_violations(index: DataFrame, grid: DataFrame, splits: DataFrame, spec: WindowSpec) -> DataFrame:
    """(rule, n): anchors that break what an index promises of its grid, and recordings and conversations that break what splits do.

    `index` is of `windows.anchors`, `splits` have (recording_id, conversation_id, split). An anchor is a slot of the grid, once; its context
    has between the least and the most steps and is all there, and so is its future; its class follows from its future's events, and
    it is trainable just if both shares of valid slots suffice. A recording has one split, and so has a conversation.
    """
    key = ["recording_id", "decision_index"]
    slots = grid.select(*key, F.row_number().over(Window.partitionBy("recording_id").orderBy("decision_index")).alias("_place"))

    rows = index.withColumn("_first_index", F.col("decision_index") - F.col("context_steps") + 1).withColumn("_last_index", F.col("decision_index") + spec.future)
    for name in ("own", "first", "last"):
        column = "decision_index" if name == "own" else f"_{name}_index"
        rows = rows.join(slots.select("recording_id", F.col("decision_index").alias(column), F.col("_place").alias(f"_{name}")), ["recording_id", column], "left")
    several = Window.partitionBy(*key)
    enough = (F.col("context_valid") >= spec.min_context_valid) & (F.col("future_valid") >= spec.min_future_valid)
    rules = {
        "anchor_not_in_grid": F.col("_own").isNull(),
        "anchor_twice": F.col("_times") > 1,
        "context_length": ~F.col("context_steps").between(spec.min_context, spec.max_context),
        "context_with_holes": F.col("_first").isNull() | (F.col("_own") - F.col("_first") + 1 != F.col("context_steps")),
        "future_with_holes": F.col("_last").isNull() | (F.col("_last") - F.col("_own") != spec.future),
        "class_of_events": (F.col("sample_class") == "event") != (F.col("future_events") > 0),
        "trainable_shares": F.col("trainable") != enough,
    }
    counts = rows.withColumn("_times", F.count("*").over(several)).agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    out = counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules))).alias("r")).select("r.*")
    without = index.select("recording_id").distinct().join(splits.filter("split IS NOT NULL"), "recording_id", "left_anti").agg(F.lit("recording_without_split").alias("rule"), F.count("*").alias("n"))
    out = out.unionByName(without)
    for unit in ("recording", "conversation"):
        twice = splits.filter(F.col(f"{unit}_id").isNotNull()).groupBy(f"{unit}_id").agg(F.count_distinct("split").alias("_n")).filter("_n > 1")
        out = out.unionByName(twice.agg(F.lit(f"{unit}_in_two_splits").alias("rule"), F.count("*").alias("n")))
    return out
