"""Pieces that are written by recording: what reads them shuffles nothing, and gives what plain Python gives."""

import random
import re

import pytest
from pyspark.sql import functions as F

from parley.operators import labels, ranks, structure
from parley.sources.shared import dealt, saved_by, stacked

LENGTH, PEOPLE = 12, ("w", "a", "b")


def made(spark, seed=3):
    random_ = random.Random(seed)
    speech = [(r, p, s, s + random_.choice([0.25, 0.5, 1.0, 2.5]), "x") for r in ("r", "s", "t") for p in PEOPLE for s in (random_.randrange(0, 4 * LENGTH) / 4 for _ in range(2))]
    recordings = spark.createDataFrame([("d", r, "c", "v", "w", 0.0, float(LENGTH)) for r in ("r", "s", "t")], "dataset string, recording_id string, conversation_id string, view_id string, wearer_id string, start_s double, end_s double")
    people = spark.createDataFrame([(r, p, p == "w", True) for r in ("r", "s", "t") for p in PEOPLE], "recording_id string, participant_id string, is_wearer boolean, resolved boolean")
    kind = "recording_id string, participant_id string, start_s double, end_s double, annotation_id string"
    states = structure.participant_states(recordings, people, spark.createDataFrame(speech, kind), spark.createDataFrame([], kind))
    cells = dealt(recordings.select("recording_id"), "recording_id").select("recording_id", F.explode(F.sequence(F.lit(0), F.lit(LENGTH - 1)).cast("array<long>")).alias("decision_index"))
    return speech, saved_by(structure.joint(states), "pieces", "recording_id"), cells


def shuffles(df):
    """What is dealt by a hash in the plan, but for `dealt` itself."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [keys for keys, why in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\), (\w+)", plan) if why != "REPARTITION_BY_NUM"]


def test_stacked_tables_stay_dealt(spark):
    _, pieces, cells = made(spark)
    both = stacked([pieces.select("recording_id", "ordinal").filter("ordinal >= 0"), pieces.groupBy("recording_id").agg(F.max("end_s").alias("end_s")), cells], "recording_id")
    assert both.columns == ["recording_id", "ordinal", "end_s", "decision_index"] and both.count() == pieces.count() + 3 + cells.count()
    assert not shuffles(both.groupBy("recording_id", "ordinal").count())


def test_future_activity_stays_in_its_recording(spark):
    speech, pieces, cells = made(spark)
    out = labels.future_activity(pieces, labels.references(pieces, cells, 1.0, ["span"]), 1.0, (1.0, 3.0))
    assert not shuffles(out)
    marks = [[(r, s, min(e, LENGTH)) for r, p, s, e, _ in speech if p == who] for who in ("w", "a", "b")]
    want = {}
    for r in ("r", "s", "t"):
        for cell in range(LENGTH):
            for n in (1, 3):
                quarters = [cell + 1 + k / 4 for k in range(4 * n)]
                on = [[any(x == r and s <= q < e for x, s, e in marks[p]) for q in quarters] for p in range(3)]
                seen = [any(o) for o in on]
                want[r, cell, float(n)] = (seen, any(seen[1:]), any(sum(q) >= 2 for q in zip(*on, strict=True))) if cell + 1 + n <= LENGTH else (None, None, None)
    got = {(x.recording_id, x.decision_index, x.horizon_s): (x.future_speaker_activity, x.future_others_activity, x.future_overlap) for x in out.collect()}
    assert got == want


def test_cells_and_overlaps_stay_in_their_recording(spark):
    speech, pieces, cells = made(spark)
    codes = labels.instantaneous(pieces, cells, 1.0, 2)
    assert not shuffles(codes)
    got = {(x.recording_id, x.decision_index): x.speaker_activity for x in codes.collect()}
    assert got == {(r, k): [int(any(x == r and p == who and s < k + 1 and e > k for x, p, s, e, _ in speech)) for who in ("w", "a", "b")] for r in ("r", "s", "t") for k in range(LENGTH)}
    over = structure.overlaps(pieces)
    assert not shuffles(over)
    runs = structure.speech_runs(pieces).collect()
    met = [(a, b) for a in runs for b in runs if a.recording_id == b.recording_id and a.participant_index != b.participant_index and a.start_s <= b.start_s < a.end_s and (a.start_s < b.start_s or a.participant_index < b.participant_index)]
    assert met and sorted((x.recording_id, x.initial, x.entering, x.start_s, x.end_s) for x in over.collect()) == sorted((a.recording_id, a.participant_index, b.participant_index, b.start_s, min(a.end_s, b.end_s)) for a, b in met)


def test_sanity_needs_no_more_than_its_columns(spark):
    """The tables that it reads hold nothing else, and only streams that it needs are drawn from the pieces."""
    _, pieces, cells = made(spark)
    read = labels.SANITY_COLUMNS
    times = labels.timing(labels.references(pieces, cells, 1.0, ["ego_onset", "other_onset"]), read["times"])
    assert times.columns == ["recording_id", "decision_index", *read["times"]]
    every = labels.timing(labels.references(pieces, cells, 1.0)).select(times.columns)
    assert sorted(map(tuple, times.collect()), key=str) == sorted(map(tuple, every.collect()), key=str)
    events, segments, cell = structure.events_table(pieces), structure.segments_table(pieces), labels.instantaneous(pieces, cells, 1.0, 2)
    whole = {r.statistic: r.value for r in labels.sanity(cell, times, events, segments).collect()}
    few = {r.statistic: r.value for r in labels.sanity(*(df.select(*read[n]) for n, df in zip(read, (cell, times, events, segments), strict=True))).collect()}
    assert few == whole and whole["cells"] == 3 * LENGTH
    counts = [n for r in cell.collect() for n in r.active_speaker_count_subframes]
    assert whole["silence_share"] == sum(n == 0 for n in counts) / len(counts) and whole["overlap_share"] == sum(n >= 2 for n in counts) / len(counts)


@pytest.mark.parametrize("sketch", [4000, 20])
def test_narrowed_quantiles_are_the_quantiles(spark, monkeypatch, sketch):
    """Ties, nulls, NaN, infinities, few rows and none; with a poor sketch as well, and with one that is wrong."""
    monkeypatch.setattr(ranks, "_SKETCH", sketch)
    random_, nan, inf = random.Random(7), float("nan"), float("inf")
    many = [(random_.gauss(0, 1), random_.choice([1.0, 2.0, None, nan, inf, -inf, -0.0])) for _ in range(9000)]
    shares = labels.SANITY_QUANTILES
    for rows in (many, many[:3], [(1.5, None)], [(None, None)], []):
        df = spark.createDataFrame(rows, "a double, b double").repartition(5)
        (got,), (want,) = ranks.narrowed_quantiles(df, ["a", "b"], shares).collect(), ranks.quantiles(df, [], ["a", "b"], shares).collect()
        assert str(got) == str(want)
    wrong = F.percentile_approx
    monkeypatch.setattr(ranks.F, "percentile_approx", lambda c, at, n: F.transform(wrong(c, at, n), lambda x: x + 3))
    df = spark.createDataFrame(many, "a double, b double")
    assert str(ranks.narrowed_quantiles(df, ["a"], shares).collect()) == str(ranks.quantiles(df, [], ["a"], shares).collect())
