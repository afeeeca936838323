"""Token classes, markers, social flags and floor changes on cases whose results are known."""

import re

from pyspark.sql import functions as F

from parley.operators import audit, labels, media, structure, text


def test_token_classes_and_markers(spark):
    said = {"word": "lexical", "—": "punctuation", "…": "punctuation", "?!": "punctuation", "[noise]": "special", "[a] b [c]": "lexical", "<x>": "special", "(laughs)": "special", " ": "empty", "12": "other", "漢": "other"}
    rows = spark.createDataFrame([(t,) for t in said], "t string").select("t", text.token_class(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == said
    turns = {"you know that": ("you know", None), "and so": ("and", "so"), "it is or something": (None, "or something"), "well though": ("well", "though"), "um yeah": (None, None), "Ok, I guess.": ("ok", "i guess")}
    rows = spark.createDataFrame([(t,) for t in turns], "t string").withColumn("w", text.words(F.col("t"))).select("t", text.marker(F.col("w"), False).alias("a"), text.marker(F.col("w"), True).alias("b")).collect()
    assert {r.t: (r.a, r.b) for r in rows} == turns


def test_file_types(spark):
    files = spark.createDataFrame([(f"Corpus/a.{e}", 1) for e in ("AVI", "m4a", "csv", "json", "xyz")], "path string, size long")
    assert {r.relative_path[-3:]: r.file_type for r in media.inventory(files).collect()} == {"AVI": "video", "m4a": "audio", "csv": "tabular", "son": "structured_data", "xyz": "other"}


def _states(spark, speech, unknown=()):
    recordings = spark.createDataFrame([("d", "r", "c", "v", "w", 0.0, 10.0)], "dataset string, recording_id string, conversation_id string, view_id string, wearer_id string, start_s double, end_s double")
    people = spark.createDataFrame([("r", "w", True, True), ("r", "a", False, True)], "recording_id string, participant_id string, is_wearer boolean, resolved boolean")
    kind = "recording_id string, participant_id string, start_s double, end_s double, annotation_id string"
    return structure.participant_states(recordings, people, spark.createDataFrame([("r", *s, "x") for s in speech], kind), spark.createDataFrame([("r", *u, "u") for u in unknown], kind))


def test_social_units_are_dense_and_hidden_where_the_recording_is(spark):
    """Wearer w and a; unit by unit: marked, unmarked, tracked, hidden, and speech or segments that nobody says of whom."""
    segment = "recording_id string, participant_id string, kind string, start_s double, end_s double, is_at_me boolean"
    social = [("a", "looking", 0.0, 1.0, True), ("a", "looking", 1.0, 2.0, False), ("w", "looking", 1.0, 2.0, None), ("a", "talking", 4.0, 5.0, False), (None, "talking", 6.0, 7.0, True), ("a", "talking", 7.0, 9.0, True), ("a", "looking", 9.0, 9.5, False)]
    tracks = spark.createDataFrame([("r", "a", 3.5), ("r", "a", 8.5), ("r", "nobody", 6.5)], "recording_id string, participant_id string, time_s double")
    states = _states(spark, [("w", 4.2, 5.8)], [(None, 8.0, 9.0)])
    people = spark.createDataFrame([("r", "w", 0), ("r", "a", 1)], "recording_id string, participant_id string, participant_index int")
    unknown = spark.createDataFrame([("r", 8.0, 9.0)], "recording_id string, start_s double, end_s double")
    units = _cells(spark).withColumnRenamed("decision_index", "unit")
    out = {r.unit: r for r in media.social_units(units, people, spark.createDataFrame([("r", *x) for x in social], segment), tracks, states, unknown, 1.0).collect()}
    assert sorted(out) == list(range(10))
    plan = media.social_units(units, people, spark.createDataFrame([("r", *x) for x in social], segment), tracks, states, unknown, 1.0)._jdf.queryExecution().executedPlan().toString()
    keys = [k.split(", ") for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    assert not [k for k in keys if any(c.startswith(("participant_", "mark")) for c in k)]  # marks meet their participants in their recording
    assert {u: r.looking_at_wearer for u, r in out.items()} == {0: [None, True], 1: [None, False], 2: [None, None], 3: [None, False], 4: [None, None], 5: [None, None], 6: [None, None], 7: [None, None], 8: [None, None], 9: [None, False]}
    assert {u: r.anyone_looking_at_wearer for u, r in out.items()} == {0: True, 1: None, 2: None, 3: False, 4: None, 5: None, 6: None, 7: None, 8: None, 9: False}
    assert {u: r.talking_to_wearer[1] for u, r in out.items()} == {4: False, 7: True} | dict.fromkeys((0, 1, 2, 3, 5, 6, 8, 9))
    assert {u: r.anyone_talking_to_wearer for u, r in out.items()} == {7: True} | dict.fromkeys((0, 1, 2, 3, 4, 5, 6, 8, 9))  # the wearer speaks in 4
    assert {u: r.face_tracked for u, r in out.items()} == {3: [False, True], 8: [None, None]} | {u: [False, False] for u in (0, 1, 2, 4, 5, 6, 7, 9)}


def _cells(spark):
    return spark.range(10).select(F.lit("r").alias("recording_id"), F.col("id").alias("decision_index"))


def test_floor_changes_are_unknown_without_a_floor(spark):
    states = _states(spark, [("w", 2.0, 3.0), ("a", 4.5, 6.0)], [(None, 8.0, 9.0)])
    got = {r.decision_index: r.floor_change for r in labels.event_units(states, _cells(spark), 1.0, 1).collect()}
    assert got == {0: None, 1: None, 2: None, 3: False, 4: True, 5: False, 6: False, 7: False, 8: None, 9: None}


def test_events_and_futures_by_participant(spark):
    states = _states(spark, [("w", 2.0, 3.0), ("a", 2.5, 6.0)], [(None, 8.0, 9.0)])
    units = {r.decision_index: r for r in labels.speaker_event_units(states, _cells(spark), 1.0, 1).collect()}
    assert units[2].speaker_onset == [True, True] and units[3].speaker_offset == [True, False] and units[0].speaker_onset == [None, None]
    assert units[8].speaker_transition_valid == [False, False] and units[9].speaker_onset == [None, None] and units[5].speaker_transition_valid == [True, True]
    around = labels.references(states, _cells(spark), 1.0)
    got = {(r.decision_index, r.horizon_s): (r.future_speaker_activity, r.future_others_activity, r.future_overlap) for r in labels.future_activity(states, around, 1.0, (1.0, 3.0)).collect()}
    assert got[0, 1.0] == ([False, False], False, False) and got[1, 1.0] == ([True, True], True, True) and got[2, 1.0] == ([False, True], True, False)
    assert got[0, 3.0] == ([True, True], True, True) and got[6, 3.0] == (None, None, None)


def test_fingerprints_tell_values_not_order(spark):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("x"))
    a, b, c = (audit.fingerprint(r).first() for r in (rows, rows.repartition(5, "x"), rows.withColumn("x", F.when(F.col("id") == 3, 9).otherwise(F.col("x")))))
    assert a == b and a.n == c.n and a.checksum != c.checksum


def test_event_units_join_their_facts_once(spark):
    """Facts on units are grouped first, so that the units, which outnumber them, are shuffled for one join."""
    states = _states(spark, [("w", 1.0, 3.0)])
    cells = spark.createDataFrame([("r", k) for k in range(2)], "recording_id string, decision_index long")
    plan = labels.event_units(states, cells, 5.0, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


def test_coverage_reads_its_labels_once(spark):
    rows = spark.createDataFrame([("r", 0, [1, None], True), ("r", 1, None, None), ("r", 2, [None, 2], False)], "recording_id string, decision_index long, who array<int>, ego boolean")
    out = labels.coverage(rows)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [("ego", 3, 2, 1), ("who", 6, 2, 4)]
