"""Conversational structure: the boundary cases of the rules."""

import re

from parley.operators import structure as st


def states(spark, speech, unknown=(), people=("w", "a", "b"), end=20.0):
    rec = spark.createDataFrame([("r", 0.0, end)], "recording_id string, start_s double, end_s double")
    who = spark.createDataFrame([("r", p, p == "w", True) for p in people], "recording_id string, participant_id string, is_wearer boolean, resolved boolean")
    s = spark.createDataFrame([("r", *x) for x in speech], "recording_id string, participant_id string, start_s double, end_s double")
    u = spark.createDataFrame([("r", *x) for x in unknown], "recording_id string, participant_id string, start_s double, end_s double")
    return st.participant_states(rec, who, s, u)


def test_handover_without_gap_is_a_transfer_and_no_overlap(spark):
    s = states(spark, [("w", 1.0, 3.0), ("a", 3.0, 5.0)])
    assert st.overlaps(s).count() == 0
    change = st.floor_changes(s).collect()
    assert [(c.previous_holder, c.next_holder, c.fto_s, c.kind) for c in change] == [(0, 1, 0.0, "no_gap_no_overlap")]
    context = {c.time_s: c.onset_type for c in st.onset_contexts(s).collect()}
    assert context[3.0] == "floor_transfer"


def test_equal_starts_count_once_with_the_lower_index_first(spark):
    out = st.overlaps(states(spark, [("w", 1.0, 3.0), ("a", 1.0, 4.0)])).collect()
    assert [(o.initial, o.entering, o.overlap_type, o.end_s) for o in out] == [(0, 1, "simultaneous_onset", 3.0)]


def test_unknown_forgets_the_floor_and_keeps_turns_apart(spark):
    s = states(spark, [("w", 1.0, 3.0), ("a", 6.0, 8.0)], [(None, 4.0, 5.0)])
    assert st.floor_changes(s).count() == 0
    joined = states(spark, [("w", 1.0, 3.0), ("w", 3.2, 5.0), ("w", 5.2, 6.0)], [("w", 5.05, 5.1)])
    assert sorted((t.start_s, t.end_s, t.runs) for t in st.turns(joined).collect()) == [(1.0, 5.0, 2), (5.2, 6.0, 1)]


def test_silences_and_within(spark):
    s = states(spark, [("w", 1.0, 6.0), ("a", 2.0, 4.0), ("w", 7.0, 8.0), ("a", 9.0, 10.0)])
    assert [(o.initial, o.entering, o.overlap_type) for o in st.overlaps(s).collect()] == [(0, 1, "within")]
    kinds = sorted((x.start_s, x.silence_type) for x in st.silences(s).collect())
    assert kinds == [(0.0, "undetermined"), (6.0, "pause"), (8.0, "gap"), (10.0, "undetermined")]


def shuffled_by(df):
    """The columns that the plan shuffles by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {c for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan) for c in re.findall(r"([a-z_]+)#", keys)}


def test_states_and_what_is_drawn_from_them_are_shuffled_by_recording_alone(spark):
    s = states(spark, [("w", 1.0, 3.0), ("a", 3.0, 5.0)], [(None, 8.0, 9.0)])
    for rows in (s, st.floor(s), st.speech_runs(s), st.floor_changes(s), st.onset_contexts(s)):
        assert shuffled_by(rows) == {"recording_id"}


def test_joint_rows_stand_for_states(spark):
    s = states(spark, [("w", 1.0, 6.0), ("a", 2.0, 4.0), ("b", 4.0, 12.0), ("w", 7.0, 8.0), ("a", 13.0, 15.0)], [("a", 10.0, 11.0), (None, 16.0, 17.0)])
    pieces = st.joint(s)
    for f in (st.floor, st.speaker_events, st.speech_runs, st.floor_changes, st.silences, st.turns, st.overlaps, st.onset_contexts, st.observed_spans, st.profiles):
        assert sorted(map(str, f(pieces).collect())) == sorted(map(str, f(s).collect()))
