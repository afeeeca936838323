"""Tokens, words and turns: classes, discourse markers, and one row of text measures per turn or utterance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.intervals import asof, normalize, on_pieces, pieces
from parley.operators.state import EPS

#: Discourse markers that open a unit and those that close one; of several that fit, the longer goes first.
OPENING = ("you know", "i mean", "so", "well", "okay", "ok", "oh", "right", "anyway", "actually", "like", "and", "but")
CLOSING = ("you know", "i guess", "i think", "or something", "right", "okay", "so", "though")
CLOSERS = (".", "?", "!", ",")


def token_class(text: Column) -> Column:
    """empty, special (in brackets), lexical (has an ASCII letter), punctuation or other, the first that fits."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (
        F.when(t == "", "empty")
        .when(t.rlike(r"^(\[[^\]]*\]|<[^>]*>|\([^)]*\))$"), "special")
        .when(t.rlike("[A-Za-z]"), "lexical")
        .when(t.rlike(r"(?U)^[^\w\s]+$"), "punctuation")
        .otherwise("other")
    )


def normal_word(text: Column) -> Column:
    """Lower case, without characters at the edges that are neither of a word nor an apostrophe."""
    return F.regexp_replace(F.lower(text), r"(?U)^[^\w']+|[^\w']+$", "")


def words(text: Column) -> Column:
    """The normal, non-empty words of a text."""
    return F.filter(F.transform(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), normal_word), lambda w: w != "")


def marker(found: Column, at_end: bool, lexicon: Sequence[str] | None = None) -> Column:
    """The first marker of the lexicon, longest first, that the words begin or end with; null if none."""
    lexicon, out = lexicon or (CLOSING if at_end else OPENING), []
    for entry in sorted(lexicon, key=lambda e: (-len(e.split()), lexicon.index(e))):
        parts = entry.split()
        n = len(parts)
        cut = F.slice(found, -n if at_end else 1, n)
        out.append(F.when((F.size(found) >= n) & (cut == F.array(*(F.lit(p) for p in parts))), F.lit(entry)))
    return F.coalesce(*out)


def closing(text: Column) -> Column:
    """The last character of the right-trimmed text if it closes a phrase."""
    last = F.substring(F.rtrim(text), -1, 1)
    return F.when(last.isin(*CLOSERS), last)


def token_events(tokens: DataFrame, participants: DataFrame | None = None) -> DataFrame:
    """Every token as an event, with its text, its class, its speaker's index and the turn that it lies in.

    `tokens` have `unit` (word or utterance) and `turn`, of `words_to_turns`, `utterances_to_turns` or `structure.in_turns`, zero-based
    within the recording; `participants` say (recording_id, participant_id, participant_index), unless tokens have their index. Untimed
    tokens stay, with null times and turn; a null or unknown speaker has a null index, a missing text stays null and is of class empty.
    """
    timed = F.coalesce("timing_valid", F.lit(False))
    if participants is not None:
        tokens = tokens.join(participants.select("recording_id", "participant_id", "participant_index"), ["recording_id", "participant_id"], "left")
    return tokens.select(
        "recording_id",
        F.lit("token").alias("event_type"),
        F.when(timed, F.col("start_s")).alias("time_s"),
        F.when(timed, F.col("end_s")).alias("end_s"),
        "participant_index",
        "participant_id",
        "unit",
        "text",
        token_class(F.col("text")).alias("token_class"),
        timed.alias("timing_valid"),
        F.when(timed, F.col("turn")).alias("turn_id"),
        "source_row",
    )


def words_to_turns(tokens: DataFrame, turns: DataFrame) -> DataFrame:
    """Each timed word with the turn of its own speaker that its midpoint lies in (within EPS, before the end); the earliest if two do.

    Turns of one speaker don't overlap, so the last one that starts by the midpoint decides, or the one before it
    when the midpoint lies on their common edge. `turns` may name their `turn`; else they are numbered from 1 for each speaker.
    """
    key = ["recording_id", "participant_id"]
    order = Window.partitionBy(*key).orderBy("start_s")
    named = turns if "turn" in turns.columns else turns.withColumn("turn", F.row_number().over(order))
    numbered = named.select(*key, "start_s", "end_s", "turn", F.lag("end_s").over(order).alias("_was"), F.lag("turn").over(order).alias("_before"))
    asks = tokens.filter("timing_valid").withColumn("mid_s", (F.col("start_s") + F.col("end_s")) / 2).withColumn("_at", F.col("mid_s") + F.lit(EPS))
    met = asof(asks, numbered, key, "_at", "start_s", ["start_s", "end_s", "turn", "_was", "_before"], into="_t")
    earlier = F.col("_t._was").isNotNull() & (F.col("mid_s") < F.col("_t._was") + EPS)
    inside = F.col("mid_s") < F.col("_t.end_s") + EPS
    return met.withColumn("turn", F.when(earlier, F.col("_t._before")).when(inside, F.col("_t.turn"))).drop("_t", "_at")


def _unit_columns(found: Column, punctuation: Column) -> list[Column]:
    """What both kinds of units say of their lexical words; null, but for the count, where there is none."""
    some = F.size(found) > 0
    return [
        F.size(found).alias("word_count"),
        F.when(some, punctuation).alias("final_punctuation"),
        F.when(some, F.coalesce(punctuation == "?", F.lit(False))).alias("interrogative_cue"),
        F.when(some, F.element_at(found, -1)).alias("final_token"),
        F.when(some, marker(found, False)).alias("initial_discourse_marker"),
        F.when(some, marker(found, True)).alias("final_discourse_marker"),
    ]


def utterance_units(utterances: DataFrame) -> DataFrame:
    """One row per timed utterance, numbered from 0 in a recording by start and source row: its lexical words, their number, how it closes, and markers.

    Only words with a letter count; in brackets they don't. Utterances have no rates, as their pauses aren't known. Untimed ones have no row;
    without a lexical word all but the count is null.
    """
    order = Window.partitionBy("recording_id").orderBy("start_s", "source_row")
    rows = utterances.filter("timing_valid").withColumn("segment_id", F.row_number().over(order) - 1)
    parts = F.filter(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+"), lambda w: token_class(w) == "lexical")
    rows = rows.withColumn("_words", F.transform(parts, normal_word))
    shared = ["recording_id", "segment_id", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), "participant_id", "source_row"]
    nothing = F.lit(None).cast("double")
    return rows.select(*shared, *_unit_columns(F.col("_words"), closing(F.coalesce("text", F.lit("")))), nothing.alias("words_per_second"), nothing.alias("words_per_voiced_second"), F.lit(False).alias("speech_rate_valid"))


def turn_units(tokens: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for every turn, also for those without a word: its lexical words, their rates over its length and over its voiced seconds, and how it closes.

    `turns` have (recording_id, participant_id, turn, start_s, end_s, pauses_s); voiced is what pauses leave of a turn. `tokens` are words
    of `words_to_turns`. The last token closes a turn if it is a closing mark by itself. Rates need a lexical word and a
    length above 0; without a lexical word all but the count is null.
    """
    key = ["recording_id", "participant_id", "turn"]
    said = F.struct("start_s", "source_row", F.coalesce("text", F.lit("")).alias("text"))
    spoken = tokens.filter("turn IS NOT NULL").groupBy(*key).agg(F.sort_array(F.collect_list(said)).alias("_said"))
    rows = turns.select(*key, "start_s", "end_s", "pauses_s").join(spoken.hint("merge"), key, "left")
    lexical = F.filter(F.coalesce(F.transform("_said", lambda t: t["text"]), F.array().cast("array<string>")), lambda w: token_class(w) == "lexical")
    rows = rows.withColumn("_words", F.transform(lexical, lambda w: normal_word(F.trim(w)))).withColumn("_last", F.trim(F.element_at("_said", -1)["text"]))
    length = F.col("end_s") - F.col("start_s")
    voiced, n = length - F.col("pauses_s"), F.size("_words")
    mark = F.when(F.col("_last").isin(*CLOSERS), F.col("_last"))
    rate = F.when((n > 0) & (length > 0), n / length)
    return rows.select(
        *key, "start_s", "end_s", length.alias("duration_s"), *_unit_columns(F.col("_words"), mark),
        rate.alias("words_per_second"), F.when((n > 0) & (voiced > 0), n / voiced).alias("words_per_voiced_second"), rate.isNotNull().alias("speech_rate_valid"),
    )


def utterances_to_turns(utterances: DataFrame, turns: DataFrame) -> DataFrame:
    """Each timed utterance with the turn of its own speaker that it shares most time with, the earliest on ties (within EPS); null if it shares none.

    Turns and utterances are cut at each other's ends, so an utterance meets only turns that it overlaps.
    """
    key = ["recording_id", "participant_id"]
    number = F.col("turn") if "turn" in turns.columns else F.row_number().over(Window.partitionBy(*key).orderBy("start_s"))
    numbered = turns.withColumn("turn", number).select(*key, "turn", "start_s", "end_s")
    timed = utterances.filter("timing_valid")
    spans = timed.select(*key, "source_row", "start_s", "end_s")
    cut = pieces(spans.select(*key, "start_s", "end_s").unionByName(numbered.select(*key, "start_s", "end_s")), key)
    length = cut.select(*key, "ordinal", (F.col("end_s") - F.col("start_s")).alias("_s"))
    met = on_pieces(normalize(spans), cut, key).select(*key, "source_row", "ordinal").join(on_pieces(normalize(numbered), cut, key).select(*key, "turn", "ordinal"), [*key, "ordinal"]).join(length, [*key, "ordinal"])
    shared = met.groupBy(*key, "source_row", "turn").agg(F.sum("_s").alias("shared_s")).filter(F.col("shared_s") > EPS)
    best = shared.groupBy(*key, "source_row").agg(F.min_by(F.struct("turn", "shared_s"), F.struct(-F.round("shared_s", 9), "turn")).alias("_b"))
    return timed.join(best, [*key, "source_row"], "left").select(*timed.columns, "_b.turn", F.coalesce("_b.shared_s", F.lit(0.0)).alias("shared_s"))
