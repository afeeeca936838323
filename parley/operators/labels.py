"""Labels on the decision grid: states per cell and subframe, events, time since and to, next speakers, futures.

Null means unknown, never false or zero. A cell's reference instant is its end. Cells are (recording_id,
decision_index); a unit is a subframe, numbered decision_index * subframes + place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators import structure as st
from parley.operators.intervals import asof
from parley.operators.ranks import narrowed_quantiles
from parley.operators.state import EPS, SPEAKING, UNKNOWN
from parley.sources.shared import saved_by, stacked

#: State codes of units.
SILENT_CODE, SPEAKING_CODE, UNKNOWN_CODE = 0, 1, 2
CELL = ["recording_id", "decision_index"]


def cells_of(grid: DataFrame) -> DataFrame:
    return grid.select(*CELL)


def seconds_per_unit(rows: DataFrame, width_s: float, keys: Sequence[str]) -> DataFrame:
    """(keys, unit, seconds): how long each key's intervals last within each unit that they touch."""
    width = F.lit(width_s)
    first, last = F.floor(F.col("start_s") / width), F.ceil(F.col("end_s") / width) - 1
    spread = rows.filter("end_s > start_s").withColumn("unit", F.explode(F.sequence(first, F.greatest(first, last))))
    part = F.least("end_s", (F.col("unit") + 1) * width) - F.greatest("start_s", F.col("unit") * width)
    return spread.groupBy(*keys, "unit").agg(F.sum(F.greatest(F.lit(0.0), part)).alias("seconds"))


def _state_seconds(states: DataFrame, width_s: float, wanted: Sequence[str] = (SPEAKING, UNKNOWN)) -> DataFrame:
    """(recording_id, participant_index, state, unit, seconds) of the wanted states; units that they don't touch have no row."""
    some = st.by_participant(states).filter(F.col("state").isin(*wanted)).select("recording_id", F.col("participant_index").cast("int").alias("participant_index"), "state", "start_s", "end_s")
    return seconds_per_unit(some, width_s, ["recording_id", "participant_index", "state"])


def _per_recording(states: DataFrame) -> DataFrame:
    """(recording_id, _people, _origin, _end) of each recording that has states."""
    last = F.max(F.array_max(F.transform("who", lambda p: p["participant_index"]))) if "who" in states.columns else F.max("participant_index")
    return states.groupBy("recording_id").agg((last + 1).cast("int").alias("_people"), F.min("start_s").alias("_origin"), F.max("end_s").alias("_end"))


def _units(cells: DataFrame, per_cell: int) -> DataFrame:
    return cells.select(*CELL, F.explode(F.sequence(F.lit(0), F.lit(per_cell - 1))).alias("place")).withColumn("unit", F.col("decision_index") * per_cell + F.col("place"))


def _together(parts: Sequence[DataFrame]) -> DataFrame:
    """Tables of facts on units one below the other, so that they are grouped at once and joined to the units once."""
    return stacked(parts, "recording_id")


def instantaneous(states: DataFrame, cells: DataFrame, step_s: float, subframes: int) -> DataFrame:
    """Per cell: each participant's state, the wearer's, others' activity, joint state, speakers and floor holder, by subframe and for the cell."""
    # Seconds of the subframes add up to those of the cell, which has place -1: one table of codes for both, joined once.
    timed = _state_seconds(states, step_s / subframes).withColumn("place", F.explode(F.array(F.pmod("unit", F.lit(subframes)), F.lit(-1).cast("long"))))
    key = ["recording_id", F.floor(F.col("unit") / subframes).alias("decision_index"), "participant_index", "place"]

    def lasts(state: str) -> Column:
        return F.sum(F.when(F.col("state") == state, F.col("seconds"))) > EPS

    code = F.when(lasts(UNKNOWN), UNKNOWN_CODE).when(lasts(SPEAKING), SPEAKING_CODE).otherwise(SILENT_CODE)
    codes = timed.groupBy(*key).agg(code.alias("code"))
    at = (F.col("participant_index") * (subframes + 1) + F.col("place") + 1).cast("int")
    # Codes meet their cells in groups, not in a join on cells, which would deal both anew; all but the lists of everyone's states are counts.
    met = stacked([codes.withColumn("_code", F.struct(at, "code")), cells.select(*CELL, F.lit(True).alias("_cell"))], "recording_id")
    who = F.col("participant_index")

    def counted(place: int, name: str) -> list[Column]:
        here = F.col("place") == place
        speaks, hides = here & (F.col("code") == SPEAKING_CODE), here & (F.col("code") == UNKNOWN_CODE)
        ego = F.coalesce(F.max(F.when(here & (who == 0), F.col("code"))), F.lit(SILENT_CODE))
        return [F.count_if(speaks).cast("int").alias(f"_active{name}"), F.count_if(hides).cast("int").alias(f"_hidden{name}"), ego.alias(f"_ego{name}"), F.min(F.when(speaks, who)).alias(f"_one{name}")]

    names = {**{k: f"_{k}" for k in range(subframes)}, -1: "_whole"}
    sums = [c for k, n in names.items() for c in counted(k, n)]
    rows = met.groupBy(*CELL).agg(F.map_from_entries(F.collect_list("_code")).alias("_codes"), F.max("_cell").alias("_cell"), *sums).filter("_cell")
    rows = rows.join(_per_recording(states).select("recording_id", "_people"), "recording_id")

    def views(place: int) -> dict[str, Column]:
        active, hidden, ego, one = (F.col(f"{n}{names[place]}") for n in ("_active", "_hidden", "_ego", "_one"))
        others = active - (ego == SPEAKING_CODE).cast("int")
        others_hidden = hidden - (ego == UNKNOWN_CODE).cast("int")
        known = hidden == 0
        code = F.transform(F.sequence(F.lit(0), F.col("_people") - 1), lambda p: F.coalesce(F.try_element_at("_codes", p * (subframes + 1) + place + 1), F.lit(SILENT_CODE)))
        return {
            "speaker_activity": F.transform(code, lambda c: F.when(c != UNKNOWN_CODE, c)),
            "ego_speaking": F.when(ego != UNKNOWN_CODE, ego == SPEAKING_CODE),
            "others_active": F.when(others > 0, True).when(others_hidden > 0, None).otherwise(False),
            "joint_speech_state": F.when(known, ego + 2 * (others > 0).cast("int")),
            "active_speaker_count": F.when(known, active),
            "floor_holder": F.when(known, F.when(active == 0, st.NONE).when(active > 1, st.MULTIPLE).otherwise(one)),
        }

    shown = [views(k) for k in range(subframes)]
    by_subframe = [F.array(*(v[n] for v in shown)).alias(f"{n}_subframes") for n in shown[0]]
    whole = {n: v for n, v in views(-1).items() if n in ("speaker_activity", "ego_speaking", "others_active")}
    return rows.select(*CELL, *by_subframe, *(v.alias(n) for n, v in whole.items()))


def joint_occupancy(states: DataFrame, cells: DataFrame, step_s: float) -> DataFrame:
    """Per cell the shares of the four joint states (nobody, wearer, others, both); null if anything in it is unknown."""
    rows = st.by_participant(states).groupBy("recording_id", "ordinal").agg(
        F.first("start_s").alias("start_s"),
        F.first("end_s").alias("end_s"),
        F.bool_or(F.col("state") == UNKNOWN).alias("_hidden"),
        F.bool_or((F.col("state") == SPEAKING) & (F.col("participant_index") == 0)).cast("int").alias("_ego"),
        F.bool_or((F.col("state") == SPEAKING) & (F.col("participant_index") > 0)).cast("int").alias("_others"),
    )
    rows = rows.withColumn("code", F.when(F.col("_hidden"), -1).otherwise(F.col("_ego") + 2 * F.col("_others")))
    timed = seconds_per_unit(rows.select("recording_id", "code", "start_s", "end_s"), step_s, ["recording_id", "code"])
    sums = [F.coalesce(F.sum(F.when(F.col("code") == k, F.col("seconds"))), F.lit(0.0)) for k in range(-1, 4)]
    shares = timed.groupBy("recording_id", F.col("unit").alias("decision_index")).agg(sums[0].alias("_hidden_s"), F.array(*(s / step_s for s in sums[1:])).alias("_shares"))
    out = cells.join(shares, CELL, "left")
    return out.select(*CELL, F.when(F.col("_hidden_s") <= EPS, F.col("_shares")).alias("joint_speech_state_occupancy"))


def _unit_of(time: Column, step_s: float, subframes: int) -> Column:
    return F.floor((time + F.lit(EPS)) / F.lit(step_s / subframes)).cast("long")


def _unknown_before(states: DataFrame, width_s: float) -> DataFrame:
    """(recording_id, unit, participant_index, ...) of whoever is unknown just before a unit, which hides a transition at its very start."""
    width = F.lit(width_s)
    rows = st.by_participant(states).filter(F.col("state") == UNKNOWN).select("recording_id", F.col("participant_index").cast("int").alias("participant_index"), "start_s", "end_s").withColumn("unit", F.explode(F.sequence(F.floor(F.col("start_s") / width), F.floor(F.col("end_s") / width))))
    edge = F.col("unit") * width
    return rows.filter((F.col("start_s") < edge - EPS) & (F.col("end_s") >= edge - EPS))


def speaker_event_units(states: DataFrame, cells: DataFrame, step_s: float, subframes: int) -> DataFrame:
    """Per unit lists by participant: whether an onset, an offset lies in it, and whether a transition could be observed at all.

    A flag is true where such an event lies in the unit, null where none does but one could have gone unseen.
    """
    width = step_s / subframes
    key = ["recording_id", "unit"]
    who = F.col("participant_index").cast("int").alias("who")
    unknown = _state_seconds(states, width, [UNKNOWN]).filter(F.col("seconds") > EPS).select(*key, F.lit("bad").alias("kind"), who)
    hidden = _unknown_before(states, width).select(*key, F.lit("bad").alias("kind"), who)
    events = st.speaker_events(states).select("recording_id", _unit_of(F.col("time_s"), step_s, subframes).alias("unit"), "kind", who)
    facts = _together([unknown, hidden, events]).groupBy(*key).agg(*(F.collect_set(F.when(F.col("kind") == k, F.col("who"))).alias(f"_{k}") for k in ("bad", "onset", "offset")))
    rows = _units(cells, subframes).join(facts, key, "left").join(_per_recording(states), "recording_id")
    early = F.col("unit") * width <= F.col("_origin") + EPS

    def among(name: str, p: Column) -> Column:
        return F.coalesce(F.array_contains(name, p), F.lit(False))

    def flag(kind: str) -> Column:
        return F.transform("valid", lambda v, p: F.when(among(f"_{kind}", p), True).when(v, False)).alias(f"speaker_{kind}")

    rows = rows.withColumn("valid", F.transform(F.sequence(F.lit(0), F.col("_people") - 1), lambda p: ~early & ~among("_bad", p)))
    return rows.select(*CELL, "place", *(flag(k) for k in ("onset", "offset")), F.col("valid").alias("speaker_transition_valid"))


def event_units(states: DataFrame, cells: DataFrame, step_s: float, subframes: int) -> DataFrame:
    """Per unit: onset and offset of the wearer and of others, and the floor change with the first previous and the last next holder.

    A flag is true where an event lies in the unit, null where the transition couldn't be observed: something unknown
    in the unit or just before it, or the recording's start.
    """
    width, key = step_s / subframes, ["recording_id", "unit"]
    names = {(k, e): f"{'ego' if e else 'other'}_{k}" for k in ("onset", "offset") for e in (True, False)}
    pieces, ego, unit = st.joint(states), F.col("participant_index") == 0, _unit_of(F.col("time_s"), step_s, subframes).alias("unit")
    unknown = _state_seconds(states, width, [UNKNOWN]).filter(F.col("seconds") > EPS).select(*key, ego.alias("_ego_bad"), (~ego).alias("_other_bad"), F.lit(True).alias("_unknown"))
    before = _unknown_before(states, width).select(*key, ego.alias("_ego_bad"), (~ego).alias("_other_bad"))
    events = st.speaker_events(states).select("recording_id", unit, *(((F.col("kind") == k) & (ego == e)).alias(f"_{n}") for (k, e), n in names.items()))
    changes = st.floor_changes(pieces).select("recording_id", unit, "time_s", "previous_holder", "next_holder")
    # Units before whose start the floor was nobody's: the last piece that starts before it decides, the very last one for all units after it.
    width_ = F.lit(width)
    free = pieces.filter("last_unique IS NULL").select("recording_id", "start_s", "end_s", F.explode(F.sequence(F.floor(F.col("start_s") / width_), F.floor(F.col("end_s") / width_) + 1)).alias("unit"))
    at = F.col("unit") * width_ - F.lit(EPS)
    free = free.filter((F.col("start_s") < at) & (F.col("end_s") >= at)).select(*key, F.lit(True).alias("_free"))
    flags = ["_ego_bad", "_other_bad", "_unknown", *(f"_{n}" for n in names.values()), "_free"]
    facts = _together([unknown, before, events, changes, free]).groupBy(*key).agg(
        *(F.coalesce(F.bool_or(n), F.lit(False)).alias(n) for n in flags),
        F.min_by("previous_holder", "time_s").alias("previous_floor_holder"),
        F.max_by("next_holder", "time_s").alias("next_floor_holder"),
        F.max(F.col("time_s").isNotNull()).alias("_change"),
    )
    ends = pieces.groupBy("recording_id").agg(F.min("start_s").alias("_origin"), F.max("end_s").alias("_end"), F.max_by("last_unique", "ordinal").alias("_final"))
    rows = _units(cells, subframes).join(facts, key, "left").join(ends, "recording_id").fillna(False, [*flags, "_change"])
    early = F.col("unit") * width <= F.col("_origin") + EPS
    shown = [F.when(F.col(f"_{n}"), True).when(early | F.col("_ego_bad" if e else "_other_bad"), None).otherwise(False).alias(n) for (_, e), n in names.items()]
    # Without a floor before the unit, nobody can tell whether it changed.
    unsure = early | F.col("_unknown") | F.when(at > F.col("_end"), F.col("_final").isNull()).otherwise(F.col("_free"))
    change = F.when(F.col("_change"), True).when(unsure, None).otherwise(False).alias("floor_change")
    return rows.select(*CELL, "place", *shown, change, "previous_floor_holder", "next_floor_holder")


def at_references(cells: DataFrame, step_s: float, streams: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Each cell with `last_<stream>` and `next_<stream>`: the stream's last row strictly before the cell's end and its first from there on.

    A stream is (rows, time column); what is found is a struct of its row. All streams and cells are sorted together
    once per recording.
    """
    reference = (F.col("decision_index") + 1) * F.lit(step_s)
    types = {n: F.struct(*(c for c in df.columns if c != "recording_id")) for n, (df, _) in streams.items()}
    asks = cells.select("recording_id", (reference - F.lit(EPS)).alias("_t"), F.lit(0).alias("_side"), "decision_index", reference.alias("reference_s"))
    rows = [df.select("recording_id", F.col(at).alias("_t"), F.lit(1).alias("_side"), types[name].alias(f"_{name}")) for name, (df, at) in streams.items()]
    both = stacked([*rows, asks], "recording_id")
    # Forward passes sort the other way: a frame up to the current row grows with it, one to the end would be worked out anew for each row.
    key = Window.partitionBy("recording_id")
    back = key.orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    on = key.orderBy(F.col("_t").desc(), F.col("_side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = [F.last(f"_{n}", ignorenulls=True).over(w).alias(f"{side}_{n}") for side, w in (("last", back), ("next", on)) for n in streams]
    return both.select("recording_id", "decision_index", "reference_s", *found).filter("decision_index IS NOT NULL")


def _streams(states: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    events = st.speaker_events(states).select("recording_id", "time_s", "kind", "participant_index")
    ego = F.col("participant_index") == 0
    out = {f"{who}_{kind}": (events.filter((F.col("kind") == kind) & on).select("recording_id", "time_s").distinct(), "time_s") for who, on in (("ego", ego), ("other", ~ego)) for kind in ("onset", "offset")}
    onsets = events.filter("kind = 'onset'").groupBy("recording_id", "time_s").agg(F.min("participant_index").alias("who"), (F.min("participant_index") != F.max("participant_index")).alias("tie"))
    out["onset"] = onsets, "time_s"
    out["floor_change"] = st.floor_changes(states).select("recording_id", "time_s", "next_holder"), "time_s"
    out["span"] = st.observed_spans(states).select("recording_id", "start_s", "end_s"), "start_s"
    pieces = st.joint(states)
    out["piece"] = st.floor(states), "start_s"
    out["speech_end"] = pieces.filter("all_known AND speakers > 0").select("recording_id", F.col("end_s").alias("time_s")), "time_s"
    out["silence"] = st.silences(states).select("recording_id", "start_s", "end_s"), "start_s"
    out["stretch"] = pieces.filter("solo IS NOT NULL AND (was_solo IS NULL OR was_solo <> solo)").select("recording_id", F.col("start_s").alias("time_s"), "solo"), "time_s"
    return out


def references(states: DataFrame, cells: DataFrame, step_s: float, names: Sequence[str] | None = None) -> DataFrame:
    """Every cell's end with what lies around it, and `observed`: whether the moment just before it lies in an observed span.

    Eleven streams, or the named ones and the spans, are drawn from the rows of `structure.joint`, which are written once for
    all of them, unless the caller gives such rows, written already.
    """
    pieces = states if "who" in states.columns else saved_by(st.joint(states), "pieces", "recording_id")
    streams = {n: s for n, s in _streams(pieces).items() if names is None or n in (*names, "span")}
    rows = at_references(cells, step_s, streams)
    observed = F.coalesce(F.col("reference_s") <= F.col("last_span.end_s") + EPS, F.lit(False))
    return rows.withColumn("observed", observed).withColumn("span_start_s", F.when(observed, F.col("last_span.start_s"))).withColumn("span_end_s", F.when(observed, F.col("last_span.end_s")))


def timing(around: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Seconds since and to events, silence so far and the span's bounds, or the named ones of these; null where censored."""
    r = F.col("reference_s")

    def since(name: str) -> Column:
        t = F.col(f"last_{name}.time_s")
        return F.when(F.col("observed") & (t >= F.col("span_start_s") - EPS), r - t)

    def until(name: str) -> Column:
        t = F.col(f"next_{name}.time_s")
        return F.when(F.col("observed") & (t <= F.col("span_end_s") + EPS), F.greatest(t - r, F.lit(0.0)))

    events = ("ego_onset", "ego_offset", "other_onset", "other_offset", "floor_change")
    active = F.coalesce((F.col("last_piece.speakers") > 0) & F.col("last_piece.all_known"), F.lit(False))
    quiet = F.col("last_silence.start_s")
    silent = F.col("observed") & (r <= F.col("last_silence.end_s") + EPS) & (quiet > F.col("span_start_s") + EPS)
    shown = {f"time_since_{n}": since(n) for n in events} | {f"time_to_next_{n}": until(n) for n in events}
    shown |= {
        "time_to_next_speaker_onset": until("onset"),
        "time_since_speaker_activity": F.when(F.col("observed") & active, F.lit(0.0)).otherwise(since("speech_end")),
        "silence_duration": F.when(silent, r - quiet),
        "time_since_observation_start": F.when(F.col("observed"), r - F.col("span_start_s")),
        "time_to_observation_end": F.when(F.col("observed"), F.col("span_end_s") - r),
    }
    return around.select(*CELL, *(v.alias(n) for n, v in shown.items() if names is None or n in names))


def next_speakers(around: DataFrame) -> DataFrame:
    """The next speaker (null on ties), the next one to speak alone, whether that is who holds the floor, and who takes the floor next."""
    def within(name: str) -> Column:
        return F.col("observed") & F.coalesce(F.col(f"next_{name}.time_s") <= F.col("span_end_s") + EPS, F.lit(False))

    unique = F.when(within("stretch"), F.col("next_stretch.solo"))
    return around.select(
        *CELL,
        F.when(within("onset") & ~F.col("next_onset.tie"), F.col("next_onset.who")).alias("next_speaker"),
        unique.alias("next_unique_speaker"),
        (unique == F.col("last_piece.last_unique")).alias("current_speaker_continues"),
        F.when(within("floor_change"), F.col("next_floor_change.next_holder")).alias("floor_transfer_target"),
    )


def future_events(around: DataFrame, horizons_s: Sequence[float]) -> DataFrame:
    """Per cell and horizon: whether the wearer's or another's onset or offset comes within it, and who speaks next; null unless wholly observed."""
    rows = around.withColumn("horizon_s", F.explode(F.array(*(F.lit(float(h)) for h in horizons_s))))
    r, end = F.col("reference_s"), F.col("reference_s") + F.col("horizon_s")
    valid = F.col("observed") & (end <= F.col("span_end_s") + EPS)

    def comes(name: str) -> Column:
        return F.coalesce(F.col(f"next_{name}.time_s") < end - EPS, F.lit(False))

    events = ("ego_onset", "ego_offset", "other_onset", "other_offset")
    who = F.when(~comes("onset"), F.lit(-1)).when(~F.col("next_onset.tie"), F.col("next_onset.who"))
    return rows.select(*CELL, "horizon_s", *(F.when(valid, comes(n)).alias(f"future_{n}") for n in events), F.when(valid, who).alias("future_next_speaker"))


def solo_share(states: DataFrame, cells: DataFrame, step_s: float) -> DataFrame:
    """The share of each cell in which the wearer alone speaks; null if anything in it is unknown."""
    shares = joint_occupancy(states, cells, step_s)
    return shares.select(*CELL, F.col("joint_speech_state_occupancy")[1].alias("ego_solo_mask_fraction"))


def onset_context_units(states: DataFrame, step_s: float, subframes: int, rules: st.Rules) -> DataFrame:
    """Units with an onset of the wearer: the context of the first one in each."""
    rows = st.onset_contexts(states, rules).filter("participant_index = 0").withColumn("unit", _unit_of(F.col("time_s"), step_s, subframes))
    first = Window.partitionBy("recording_id", "unit").orderBy("time_s")
    rows = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    last = F.col("previous_unique_speaker")
    return rows.select(
        "recording_id",
        F.floor(F.col("unit") / subframes).cast("long").alias("decision_index"),
        (F.col("unit") % subframes).alias("place"),
        "previous_unique_speaker",
        (last == 0).alias("ego_was_last_unique_speaker"),
        F.col("others_at").alias("others_active_at_ego_onset"),
        F.col("silence_before_s").alias("silence_duration_before_ego_onset"),
        F.col("simultaneous").alias("simultaneous_other_onset"),
        (F.col("onset_type") != "undetermined").alias("ego_onset_context_valid"),
        F.col("onset_type").alias("ego_onset_type"),
    )


def overlap_units(states: DataFrame, cells: DataFrame, step_s: float, subframes: int, rules: st.Rules) -> DataFrame:
    """Per unit whether an overlap of each type lies in it; null if none does and something unknown might hide one."""
    width = step_s / subframes
    timed = seconds_per_unit(st.overlaps(states, rules).select("recording_id", "overlap_type", "start_s", "end_s"), width, ["recording_id", "overlap_type", "start_s", "end_s"])
    kinds = ("within", "between", "simultaneous_onset", "undetermined")
    found = timed.filter(F.col("seconds") > EPS).groupBy("recording_id", "unit").agg(*(F.bool_or(F.col("overlap_type") == k).alias(f"_{k}") for k in kinds))
    unknown = _state_seconds(states, width, [UNKNOWN]).filter(F.col("seconds") > EPS).select("recording_id", "unit", F.lit(True).alias("_hidden"))
    facts = _together([found, unknown]).groupBy("recording_id", "unit").agg(*(F.bool_or(f"_{k}").alias(f"_{k}") for k in (*kinds, "hidden")))
    rows = _units(cells, subframes).join(facts, ["recording_id", "unit"], "left").join(_per_recording(states), "recording_id")
    hidden = F.coalesce(F.col("_hidden"), F.lit(False))
    unsure = {k: hidden | F.coalesce(F.col("_undetermined"), F.lit(False)) if k != "simultaneous_onset" else hidden for k in kinds[:3]}
    shown = [F.when(F.col(f"_{k}"), True).when(unsure[k], None).otherwise(False).alias(f"{k}_overlap") for k in kinds[:3]]
    return rows.select(*CELL, "place", *shown)


def future_states(states: DataFrame, around: DataFrame, horizons_s: Sequence[float]) -> DataFrame:
    """Per cell and horizon the joint state and floor holder just before it ends; null unless wholly observed."""
    rows = around.select(*CELL, "reference_s", "observed", "span_end_s", F.explode(F.array(*(F.lit(float(h)) for h in horizons_s))).alias("horizon_s"))
    asks = rows.withColumn("_at", F.col("reference_s") + F.col("horizon_s") - F.lit(EPS))
    ego = F.exists("who", lambda p: (p["participant_index"] == 0) & (p["state"] == SPEAKING)).cast("int").alias("ego")
    pieces = st.joint(states).select("recording_id", "start_s", ego, "speakers", "holder")
    met = asof(asks, pieces, ["recording_id"], "_at", "start_s", ["start_s", "ego", "speakers", "holder"], strict=True, into="_p")
    valid = F.col("observed") & (F.col("reference_s") + F.col("horizon_s") <= F.col("span_end_s") + EPS)
    joint = F.col("_p.ego") + 2 * (F.col("_p.speakers") > F.col("_p.ego")).cast("int")
    return met.select(*CELL, "horizon_s", F.when(valid, joint).alias("future_joint_speech_state"), F.when(valid, F.col("_p.holder")).alias("future_floor_holder"))


def future_activity(states: DataFrame, around: DataFrame, step_s: float, horizons_s: Sequence[float]) -> DataFrame:
    """Per cell and horizon who speaks before it ends, by participant, the wearer, others, and whether two speak at once; null unless wholly observed.

    Horizons are whole numbers of steps, so speech is summed up once per cell, and a cell looks at the few cells after it
    in its recording's order. Nothing is shuffled where pieces and cells are dealt by recording.
    """
    pieces = st.joint(states)
    speaking = F.transform(F.filter("who", lambda p: p["state"] == SPEAKING), lambda p: p["participant_index"].cast("int"))
    heard = F.when(F.col("all_known") & (F.col("speakers") >= 2), F.concat(speaking, F.array(F.lit(-1)))).otherwise(speaking)
    timed = seconds_per_unit(pieces.select("recording_id", F.explode(heard).alias("who"), "start_s", "end_s"), step_s, ["recording_id", "who"])
    said = timed.select("recording_id", F.col("unit").alias("decision_index"), F.struct("who", "seconds").alias("_said"))
    both = stacked([said, around.select(*CELL, "reference_s", "observed", "span_end_s")], "recording_id")
    order = Window.partitionBy("recording_id").orderBy("decision_index")
    ahead = {float(h): F.collect_list("_said").over(order.rangeBetween(1, round(h / step_s))) for h in horizons_s}
    rows = both.withColumns({f"_ahead_{k}": v for k, v in enumerate(ahead.values())}).filter("reference_s IS NOT NULL")
    each_h = F.explode(F.array(*(F.struct(F.lit(h).alias("horizon_s"), F.col(f"_ahead_{k}").alias("said")) for k, h in enumerate(ahead)))).alias("_h")
    rows = rows.select(*CELL, "reference_s", "observed", "span_end_s", each_h).select("*", "_h.horizon_s").join(_per_recording(states).select("recording_id", "_people"), "recording_id")

    def lasts(who: Column) -> Column:
        return F.aggregate(F.filter("_h.said", lambda s: s["who"] == who), F.lit(0.0), lambda a, s: a + s["seconds"]) > EPS

    key = [*CELL, "horizon_s"]
    valid = F.col("observed") & (F.col("reference_s") + F.col("horizon_s") <= F.col("span_end_s") + EPS)
    rows = rows.withColumn("_who", F.when(valid, F.filter(F.array_distinct(F.transform("_h.said", lambda s: s["who"])), lasts)))
    each = F.transform(F.sequence(F.lit(0), F.col("_people").cast("int") - 1), lambda p: F.coalesce(F.array_contains("_who", p), F.lit(False)))
    others = F.coalesce(F.exists("_who", lambda p: p > 0), F.lit(False))
    shown = {"speaker_activity": each, "ego_activity": each[0], "others_activity": others, "overlap": F.coalesce(F.array_contains("_who", -1), F.lit(False))}
    return rows.select(*key, *(F.when(valid, v).alias(f"future_{n}") for n, v in shown.items()))


def coverage(labels: DataFrame) -> DataFrame:
    """(label, units, known, missing) for every label column of a cell table; a list counts by its elements, a null list as as many missing ones as lists of that column have most often."""
    values = [c for c in labels.columns if c not in CELL]
    lists = {c for c in values if labels.schema[c].dataType.typeName() == "array"}
    parts = []
    for c in values:
        if c in lists:
            # One pass: how many lists are null, times their usual length.
            size, null = F.when(F.col(c).isNotNull(), F.size(c)), F.count_if(F.col(c).isNull())
            units = F.coalesce(F.sum(size), F.lit(0)) + F.when(null > 0, null * F.mode(size, True)).otherwise(F.lit(0))
            known = F.sum(F.coalesce(F.size(F.filter(c, lambda x: x.isNotNull())), F.lit(0)))
        else:
            units, known = F.count("*"), F.count(c)
        parts.append(F.struct(F.lit(c).alias("label"), units.cast("long").alias("units"), known.cast("long").alias("known")))
    out = labels.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    return out.withColumn("missing", F.col("units") - F.col("known"))


#: Quantiles of the sanity statistics.
SANITY_QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
#: What the sanity statistics read of each table.
SANITY_COLUMNS = {
    "cells": ("ego_speaking", "others_active", "active_speaker_count_subframes"),
    "times": ("time_to_next_ego_onset", "time_to_next_other_onset"),
    "events": ("event", "participant_index", "onset_type", "fto_s"),
    "segments": ("segment", "start_s", "end_s", "overlap_type", "silence_type"),
}


def sanity(cells: DataFrame, times: DataFrame, events: DataFrame, segments: DataFrame) -> DataFrame:
    """(statistic, value) of the speech labels: shares of known cells and subframes, censored shares, counts and kinds of events and segments, quantiles.

    `cells` is of `instantaneous`, `times` of `timing`, the rest are the tables of events and segments; columns that aren't in
    SANITY_COLUMNS may be left out. `cells` is read once, the others several times: write them first. Shares and
    quantiles of nothing are null; kinds that don't occur have no row.
    """
    def long(rows: DataFrame, stats: dict[str, Column]) -> DataFrame:
        one = rows.agg(*(v.cast("double").alias(n) for n, v in stats.items()))
        return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in stats))).alias("r")).select("r.*")

    def share(test: Column) -> Column:
        return F.avg(test.cast("int"))

    def spread(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        found = narrowed_quantiles(rows.select(*(v.alias(n) for n, v in values.items())), list(values), SANITY_QUANTILES)
        cells = [F.struct(F.lit(f"{n}_q{round(q * 100)}").alias("statistic"), F.col(n)[k].alias("value")) for n in values for k, q in enumerate(SANITY_QUANTILES)]
        return found.select(F.explode(F.array(*cells)).alias("r")).select("r.*")

    def kinds(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.filter(F.col(column).isNotNull()).groupBy(F.concat(F.lit(f"{name}_"), F.col(column)).alias("statistic")).agg(F.count("*").cast("double").alias("value"))

    frames = F.coalesce("active_speaker_count_subframes", F.array().cast("array<int>"))
    known = F.sum(F.size(F.filter(frames, lambda n: n.isNotNull())))

    def share_of_frames(test: Callable[[Column], Column]) -> Column:
        return F.when(known > 0, F.sum(F.size(F.filter(frames, test))) / known)

    onset, change = F.col("event") == "onset", F.col("event") == "floor_change"
    fto, length = F.when(change, F.col("fto_s")), F.when(F.col("segment") == "turn", F.col("end_s") - F.col("start_s"))
    timing_stats = {}
    for name in ("time_to_next_ego_onset", "time_to_next_other_onset"):
        timing_stats |= {f"{name}_censored": share(F.col(name).isNull())}
    parts = [
        long(cells, {"cells": F.count("*"), "ego_speaking_share": share(F.col("ego_speaking")), "others_active_share": share(F.col("others_active")), "overlap_share": share_of_frames(lambda n: n >= 2), "silence_share": share_of_frames(lambda n: n == 0)}),
        long(times, timing_stats),
        long(events, {"onsets": F.count_if(onset), "offsets": F.count_if(F.col("event") == "offset"), "ego_onsets": F.count_if(onset & (F.col("participant_index") == 0)), "floor_changes": F.count_if(change), "overlap_transfer_share": share(fto < 0)}),
        kinds(events, "onset_type", "onset"),
        long(segments, {"turns": F.count(length)}),
        kinds(segments, "overlap_type", "overlap"),
        kinds(segments, "silence_type", "silence"),
        spread(times, {n: F.col(n) for n in ("time_to_next_ego_onset", "time_to_next_other_onset")}),
        spread(events, {"fto": fto}),
        spread(segments, {"turn": length}),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
