"""Text units and token events on known cases."""

import pytest

from parley.operators import text as tx

TOKENS = "recording_id string, participant_id string, unit string, text string, start_s double, end_s double, timing_valid boolean, source_row long"


def test_utterances_count_lexical_words_only(spark):
    said = [("[noise] 123 ok.", 0.0, True), ("...?", 1.0, True), ("not timed", None, False), (None, 3.0, True), ("You know, it works?", 2.0, True), ("so I guess", 2.0, True)]
    rows = [("r", "a", "utterance", t, s, None if s is None else s + 0.5, ok, k) for k, (t, s, ok) in enumerate(said)]
    out = {r.source_row: r for r in tx.utterance_units(spark.createDataFrame(rows, TOKENS)).collect()}
    assert {k: r.segment_id for k, r in out.items()} == {0: 0, 1: 1, 4: 2, 5: 3, 3: 4}
    shown = {k: (r.word_count, r.final_punctuation, r.interrogative_cue, r.final_token, r.initial_discourse_marker, r.final_discourse_marker) for k, r in out.items()}
    assert shown == {
        0: (1, ".", False, "ok", "ok", None),
        1: (0, None, None, None, None, None),
        3: (0, None, None, None, None, None),
        4: (4, "?", True, "works", "you know", None),
        5: (3, None, False, "guess", "so", "i guess"),
    }
    assert all(r.words_per_second is None and r.words_per_voiced_second is None and r.speech_rate_valid is False for r in out.values())


def turns_of(spark):
    rows = [("r", "a", 0, 0.0, 4.0, 1.0), ("r", "b", 1, 4.0, 6.0, 0.0), ("r", "a", 2, 6.0, 8.0, 2.0), ("r", "a", 3, 8.0, 9.0, 0.0)]
    return spark.createDataFrame(rows, "recording_id string, participant_id string, turn int, start_s double, end_s double, pauses_s double")


def words_of(spark):
    said = [("a", "Well", 0.0), ("a", "[laughs]", 0.5), ("a", "42", 1.0), ("a", "fine", 2.0), ("a", "?", 3.0), ("b", "...", 4.2), ("a", "Yes.", 6.5), ("a", "edge", 7.9), ("b", "late", 20.0)]
    rows = [("r", p, "word", t, s, s + 0.2, True, k) for k, (p, t, s) in enumerate(said)] + [("r", "a", "word", "lost", None, None, False, 90)]
    return spark.createDataFrame(rows, TOKENS)


def test_turns_have_rates_over_their_length_and_their_voiced_seconds(spark):
    turns = turns_of(spark)
    out = {r.turn: r for r in tx.turn_units(tx.words_to_turns(words_of(spark), turns), turns).collect()}
    shown = {k: (r.word_count, r.words_per_second, r.words_per_voiced_second, r.final_punctuation, r.interrogative_cue, r.final_token, r.speech_rate_valid) for k, r in out.items()}
    assert shown == {
        0: (2, 0.5, pytest.approx(2 / 3), "?", True, "fine", True),
        1: (0, None, None, None, None, None, False),  # only an ellipsis
        2: (2, 1.0, None, None, False, "edge", True),  # all of it pauses; a midpoint on the turns' common edge goes to the earlier
        3: (0, None, None, None, None, None, False),
    }
    assert out[0].initial_discourse_marker == "well"
    empty = tx.turn_units(tx.words_to_turns(words_of(spark).filter("false"), turns), turns)
    assert [r.word_count for r in empty.collect()] == [0, 0, 0, 0]


def test_token_events_keep_every_token(spark):
    who = spark.createDataFrame([("r", "a", 0), ("r", "b", 1)], "recording_id string, participant_id string, participant_index int")
    words = words_of(spark)
    placed = tx.words_to_turns(words, turns_of(spark)).unionByName(words.filter("NOT timing_valid"), allowMissingColumns=True)
    unheard = spark.createDataFrame([("r", None, "word", None, 1.0, 2.0, True, 91)], TOKENS)
    out = {r.source_row: r for r in tx.token_events(placed.unionByName(unheard, allowMissingColumns=True), who).collect()}
    assert len(out) == 11 and out[90][2:4] == (None, None) and out[90].turn_id is None and out[90].token_class == "lexical"
    assert (out[91].participant_index, out[91].text, out[91].token_class) == (None, None, "empty")
    assert {k: r.turn_id for k, r in out.items() if k < 9} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 2, 7: 2, 8: None}
    assert [out[k].token_class for k in (1, 2, 4)] == ["special", "other", "punctuation"]
