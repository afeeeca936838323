"""State timelines and the grid: boundary cases, and brute force on random timelines."""

import math
import random
import re

import pytest

from parley.operators import grid, state, windows
from parley.operators.state import EPS


def timeline(spark, *rows, rec="r"):
    full, at = [], 0.0
    for n, (end, s) in enumerate(rows):
        full.append((rec, n, at, end, s, "native_annotation", f"a#{n}" if s == "SPEAKING" else None))
        at = end
    return spark.createDataFrame(full, "recording_id string, native_index int, start_s double, end_s double, state string, source_kind string, annotation_ids string")


def by_slot(df):
    return {r.decision_index: r for r in df.collect()}


def test_event_on_a_slot_edge_belongs_to_the_slot_that_begins(spark):
    g = by_slot(grid.action_grid(timeline(spark, (0.3, "SILENT"), (1.0, "SPEAKING")), 0.1))
    assert (g[3].action, g[3].tau_s) == ("ONSET", 0.0)
    assert g[2].action == "NO_EVENT"
    assert g[0].mask_reason == "recording_start"


def test_two_changes_mask_and_unknown_masks(spark):
    g = by_slot(grid.action_grid(timeline(spark, (0.52, "SILENT"), (0.57, "SPEAKING"), (0.85, "SILENT"), (0.95, "UNKNOWN"), (1.3, "SILENT")), 0.1))
    assert g[5].mask_reason == "compound_transition"
    assert g[8].mask_reason == "unknown_within_slot"
    assert g[9].mask_reason == "unknown_state"
    assert all(r.action is None for r in g.values() if not r.action_valid)


def test_gaps_of_a_step_stay_and_chains_of_shorter_ones_go(spark):
    t = timeline(spark, (1.0, "SPEAKING"), (1.05, "SILENT"), (1.5, "SPEAKING"), (1.58, "SILENT"), (2.0, "SPEAKING"), (2.1, "SILENT"), (3.0, "SPEAKING"))
    c = sorted((r.start_s, r.end_s, r.state, r.bridged_gaps) for r in state.control_timeline(t, 0.1).collect())
    assert c == [(0.0, 2.0, "SPEAKING", 2), (2.0, 2.1, "SILENT", 0), (2.1, 3.0, "SPEAKING", 0)]


def test_overlapping_annotations_keep_both_ids(spark):
    rec = spark.createDataFrame([("r", "w", 0.0, 10.0)], "recording_id string, wearer_id string, start_s double, end_s double")
    speech = spark.createDataFrame([("r", "w", 1.0, 4.0, "a#1"), ("r", "w", 3.0, 6.0, "a#2"), ("r", "x", 0.0, 9.0, "a#3")], "recording_id string, participant_id string, start_s double, end_s double, annotation_id string")
    unknown = spark.createDataFrame([("r", None, 5.0, 12.0, "e#1")], "recording_id string, participant_id string, start_s double, end_s double, annotation_id string")
    rows = sorted((r.start_s, r.end_s, r.state, r.annotation_ids) for r in state.native_timeline(rec, speech, unknown).collect())
    assert rows == [(0.0, 1.0, "SILENT", None), (1.0, 3.0, "SPEAKING", "a#1"), (3.0, 4.0, "SPEAKING", "a#1|a#2"), (4.0, 5.0, "SPEAKING", "a#2"), (5.0, 10.0, "UNKNOWN", "e#1")]


@pytest.mark.parametrize("step", [0.1, 0.08, 10.0])
def test_state_before_slot_is_that_of_the_first_row_ending_at_or_after_it(spark, step):
    r = random.Random(int(step * 100))
    ends = sorted({round(r.uniform(0, 60 * step), r.choice([1, 3])) for _ in range(40)} - {0.0})
    rows = [(e, r.choice(["SILENT", "SPEAKING", "UNKNOWN"])) for e in ends]
    got = {x.decision_index: x.state_before for x in grid.slots_with_state(timeline(spark, *rows), step).collect()}
    last = math.floor((ends[-1] + EPS) / step) - 1
    assert set(got) == set(range(last + 1))
    for k, s in got.items():
        assert s == next(state for e, state in rows if e >= k * step - EPS)


def test_window_geometry_and_holes(spark):
    spec = windows.WindowSpec.of_seconds(0.08, 1.0, 5.0, 1.0)
    assert (spec.min_context, spec.max_context, spec.future) == (13, 63, 13)
    rows = [("r", k, True, "NO_EVENT") for k in range(20) if k != 10]
    g = spark.createDataFrame(rows, "recording_id string, decision_index long, action_valid boolean, action string")
    found = {r.decision_index for r in windows.anchors(g, windows.WindowSpec(3, 5, 2)).collect()}
    assert found == {2, 3, 4, 5, 6, 7, 13, 14, 15, 16, 17}


def test_from_annotations_to_anchors_rows_stay_in_the_partition_of_their_recording(spark):
    rec = spark.createDataFrame([("r", "w", 0.0, 10.0)], "recording_id string, wearer_id string, start_s double, end_s double")
    columns = "recording_id string, participant_id string, start_s double, end_s double, annotation_id string"
    speech = spark.createDataFrame([("r", "w", 1.2, 4.7, "a"), ("r", "w", 4.7, 6.0, "b"), ("r", "x", 5.0, 9.0, "c")], columns)
    unknown = spark.createDataFrame([("r", None, 8.0, 8.5, "u")], columns)
    g = grid.action_grid(state.control_timeline(state.native_timeline(rec, speech, unknown), 1.0), 1.0)
    for rows in (g, windows.anchors(g, windows.WindowSpec(1, 3, 2))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert {keys.split("#")[0] for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)} == {"recording_id"}
        assert not re.findall(r"Exchange hashpartitioning\([^,)]*, [^,)]*#", plan)
    # A row without a change ends in slot 4: the change that ends slot 5 isn't lost, nor is one that shares a slot with such an end.
    assert {r.decision_index: r.action for r in g.collect() if r.action in ("ONSET", "OFFSET")} == {1: "ONSET", 6: "OFFSET"}
    late = timeline(spark, (0.52, "SILENT"), (0.57, "SILENT"), (0.85, "SPEAKING"))
    assert [(r.decision_index, r.action) for r in grid.action_grid(late, 0.1).collect() if r.action in ("ONSET", "OFFSET")] == [(5, "ONSET")]
