"""The catalog of labels, selections and support."""

import pytest

from parley.operators import catalog as ct


def test_the_catalog_is_sound():
    assert len(ct.LABELS) == 116 and ct.catalog_errors(ct.LABELS) == []
    assert ct.catalog_errors([ct.Label("a.b", ("audio",)), ct.Label("a.b", ("smell",), ("gossip",)), ct.Label("plain", ())]) == ["a.b: twice", "a.b: unknown modality smell", "a.b: unknown fact gossip", "plain: no family", "plain: no modality"]
    assert {n: len([x for x in ct.LABELS if x.family == n]) for n in ("timing", "nuisance", "text")} == {"timing": 15, "nuisance": 16, "text": 6}


def test_selections():
    assert ct.select_labels(["turns.*", "text.tokens"]).names == ("turns.speech_runs", "turns.turns", "turns.floor_transfers", "text.tokens")
    assert len(ct.select_labels(["all"]).names) == 116
    assert set(ct.select_labels(["text.*"], ["text"]).names) == {x.name for x in ct.LABELS if x.family == "text"} - {"text.speech_rate"}
    assert "text.speech_rate" in ct.select_labels(["all"], ["text", "audio"]).names
    some = ct.select_labels(["turns.*"], supported=["turns.turns"])
    assert some.names == ("turns.turns",) and set(some.skipped) == {"turns.speech_runs", "turns.floor_transfers"}


@pytest.mark.parametrize(
    "include, modalities, said",
    [
        (["timing.silence_durations"], [], "timing.silence_duration"),
        (["timming.*"], [], "timing"),
        (["all"], ["vidoe"], "video"),
        ([], [], "nothing"),
        (["text.speech_rate"], ["text"], "not all"),
        (["quite.else"], [], "unknown label"),
    ],
)
def test_bad_selections_name_the_nearest(include, modalities, said):
    with pytest.raises(ct.SelectionError, match=said):
        ct.select_labels(include, modalities)


def test_a_label_named_exactly_must_be_supported():
    with pytest.raises(ct.SelectionError, match="isn't supported"):
        ct.select_labels(["turns.turns"], supported=[])


def test_support_and_counts(spark):
    labels = (ct.Label("a.x", ("audio",), ("speech",)), ct.Label("a.y", ("audio", "video"), ("speech", "face_tracks")), ct.Label("m.z", ("metadata",)))
    facts = spark.createDataFrame([("one", "speech"), ("one", "speech"), ("two", "face_tracks"), ("two", "speech"), ("none", None)], "dataset string, fact string")
    support = ct.support_matrix(facts, labels)
    got = {(r.dataset, r.label): (r.supported, r.missing) for r in support.collect()}
    assert got == {
        ("one", "a.x"): (True, []), ("one", "a.y"): (False, ["face_tracks"]), ("one", "m.z"): (True, []),
        ("two", "a.x"): (True, []), ("two", "a.y"): (True, []), ("two", "m.z"): (True, []),
        ("none", "a.x"): (False, ["speech"]), ("none", "a.y"): (False, ["face_tracks", "speech"]), ("none", "m.z"): (True, []),
    }
    made = spark.createDataFrame([("two", "a.y"), ("two", "a.y"), ("one", "m.z")], "dataset string, label string")
    counts = {(r.dataset, r.modality): (r.registered, r.supported, r.materialized) for r in ct.modality_counts(support, made).collect()}
    assert counts["two", "audio"] == (2, 2, 1) and counts["two", "video"] == (1, 1, 1) and counts["one", "audio"] == (2, 1, 0) and counts["one", "metadata"] == (1, 1, 1)
    assert ct.support_matrix(facts.filter("false"), labels).count() == 0
