"""Queries on grid labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import labels as lb
from parley.operators import structure as st
from parley.plans.oracle import EPS, PARTS, part, sql
from parley.plans.q_state import STEP, rounded
from parley.plans.q_structure import RULES, states
from parley.sources import canonical as c
from parley.sources.shared import dealt, saved, saved_by

SUBFRAMES = 2
HORIZONS = (10.0, 50.0, 100.0)


def cells(spark, sf_dir):
    """All whole cells of each recording's window, dealt by recording before they are many."""
    days = dealt(c.recordings(c.table(spark, sf_dir, "events")).select("recording_id", "end_s"), "recording_id")
    last = F.floor(F.col("end_s") / STEP).cast("long") - 1
    return days.select("recording_id", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("decision_index"))


def _around(spark, sf_dir):
    return lb.references(states(spark, sf_dir), cells(spark, sf_dir), STEP)


def _shown(values):
    return F.array_join(F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("-"))), ",")


def g4_instantaneous_labels(spark, sf_dir):
    out = lb.instantaneous(states(spark, sf_dir), cells(spark, sf_dir), STEP, SUBFRAMES)
    nested = F.array_join(F.transform("speaker_activity_subframes", _shown), "|").alias("speaker_activity_subframes")
    flat = [_shown(F.col(f"{n}_subframes")).alias(f"{n}_subframes") for n in ("ego_speaking", "others_active", "joint_speech_state", "active_speaker_count", "floor_holder")]
    return rounded(out.select("recording_id", "decision_index", nested, *flat, _shown(F.col("speaker_activity")).alias("speaker_activity"), "ego_speaking", "others_active"))


def g7_joint_occupancy(spark, sf_dir):
    out = lb.joint_occupancy(states(spark, sf_dir), cells(spark, sf_dir), STEP)
    s = F.col("joint_speech_state_occupancy")
    return rounded(out.select("recording_id", "decision_index", *(s[k].alias(f"share_{k}") for k in range(4))))


def _pieces(spark, sf_dir):
    """The pieces with all participants, written once, by recording, for all that read them."""
    return saved_by(st.joint(states(spark, sf_dir)), "pieces", "recording_id")


def g9_event_units(spark, sf_dir):
    return rounded(lb.event_units(_pieces(spark, sf_dir), cells(spark, sf_dir), STEP, SUBFRAMES))


def g9_speaker_event_units(spark, sf_dir):
    out = lb.speaker_event_units(_pieces(spark, sf_dir), cells(spark, sf_dir), STEP, SUBFRAMES)
    return rounded(out.select("recording_id", "decision_index", "place", *(_shown(F.col(n)).alias(n) for n in ("speaker_onset", "speaker_offset", "speaker_transition_valid"))))


def g18_future_activity(spark, sf_dir):
    pieces = _pieces(spark, sf_dir)
    out = lb.future_activity(pieces, lb.references(pieces, cells(spark, sf_dir), STEP, ["span"]), STEP, HORIZONS)
    return rounded(out.withColumn("future_speaker_activity", F.when(F.col("future_speaker_activity").isNotNull(), _shown(F.col("future_speaker_activity")))))


def g13_timing_labels(spark, sf_dir):
    return rounded(lb.timing(_around(spark, sf_dir)))


def g16_next_speakers(spark, sf_dir):
    return rounded(lb.next_speakers(_around(spark, sf_dir)))


def g18_future_events(spark, sf_dir):
    return rounded(lb.future_events(_around(spark, sf_dir), HORIZONS))


def g19_ego_solo_share(spark, sf_dir):
    return rounded(lb.solo_share(states(spark, sf_dir), cells(spark, sf_dir), STEP))


def g11_onset_context_units(spark, sf_dir):
    return rounded(lb.onset_context_units(states(spark, sf_dir), STEP, SUBFRAMES, RULES))


def g12_overlap_units(spark, sf_dir):
    return rounded(lb.overlap_units(_pieces(spark, sf_dir), cells(spark, sf_dir), STEP, SUBFRAMES, RULES))


def g18_future_states(spark, sf_dir):
    pieces = _pieces(spark, sf_dir)
    return rounded(lb.future_states(pieces, lb.references(pieces, cells(spark, sf_dir), STEP), HORIZONS))


def l4_label_coverage(spark, sf_dir):
    nested = lb.instantaneous(states(spark, sf_dir), cells(spark, sf_dir), STEP, SUBFRAMES).drop("speaker_activity_subframes")
    occupancy = lb.joint_occupancy(states(spark, sf_dir), cells(spark, sf_dir), STEP)
    return rounded(lb.coverage(nested).unionByName(lb.coverage(occupancy)))


def l5_sanity_statistics(spark, sf_dir):
    around = _pieces(spark, sf_dir)
    grid_, read = cells(spark, sf_dir), lb.SANITY_COLUMNS
    times = saved(lb.timing(lb.references(around, grid_, STEP, ["ego_onset", "other_onset"]), read["times"]).select(*read["times"]), "timing")
    events_, segments = saved(st.events_table(around, RULES).select(*read["events"]), "events"), saved(st.segments_table(around, RULES).select(*read["segments"]), "segments")
    out = lb.sanity(lb.instantaneous(around, grid_, STEP, SUBFRAMES), times, events_, segments)
    return rounded(out, 3)


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "gl" and k.split("_")[0][1:].isdigit()}

part("cel", "recs", "SELECT recording_id, unnest(range(0, 360)) AS decision_index FROM recs")
for _name, _width, _per in (("ucodes", 5, 2), ("ccodes", 10, 1)):
    part(
        f"{_name}0",
        "pstates",
        f"""SELECT recording_id, participant_index, unit, CASE WHEN sum(s) FILTER (WHERE state = 'UNKNOWN') > {EPS} THEN 2 WHEN sum(s) FILTER (WHERE state = 'SPEAKING') > {EPS} THEN 1 ELSE 0 END AS code FROM (
          SELECT *, greatest(0, least(end_s, (unit + 1) * CAST({_width} AS DOUBLE)) - greatest(start_s, unit * CAST({_width} AS DOUBLE))) AS s FROM (
            SELECT *, unnest(range(CAST(floor(start_s / {_width}) AS BIGINT), greatest(CAST(floor(start_s / {_width}) AS BIGINT) + 1, CAST(ceil(end_s / {_width}) AS BIGINT)))) AS unit FROM pstates WHERE state <> 'SILENT')) GROUP BY 1, 2, 3""",
    )
    part(
        _name,
        f"cel {_name}0",
        f"""SELECT recording_id, decision_index, place, list(coalesce(code, 0) ORDER BY p) AS codes FROM (SELECT *, decision_index * {_per} + place AS unit FROM cel, (SELECT unnest(range({_per})) AS place)), (SELECT unnest(range(4)) AS p)
          LEFT JOIN {_name}0 u ON u.recording_id = cel.recording_id AND u.unit = cel.unit AND u.participant_index = p GROUP BY 1, 2, 3""".replace("FROM (SELECT *, decision_index", "FROM (SELECT cel.recording_id, decision_index, place, decision_index").replace(", (SELECT unnest(range(4)) AS p)", " cel CROSS JOIN (SELECT unnest(range(4)) AS p)").replace("SELECT recording_id, decision_index, place, list", "SELECT cel.recording_id, cel.decision_index, cel.place, list"),
    )
part("occ", "flr pstates cel", f"""SELECT c.recording_id, c.decision_index, h, s FROM cel c LEFT JOIN (
  SELECT recording_id, unit, coalesce(sum(x) FILTER (WHERE code = -1), 0) AS h, [coalesce(sum(x) FILTER (WHERE code = 0), 0) / 10, coalesce(sum(x) FILTER (WHERE code = 1), 0) / 10, coalesce(sum(x) FILTER (WHERE code = 2), 0) / 10, coalesce(sum(x) FILTER (WHERE code = 3), 0) / 10] AS s FROM (
    SELECT recording_id, unit, code, greatest(0, least(end_s, (unit + 1) * CAST(10 AS DOUBLE)) - greatest(start_s, unit * CAST(10 AS DOUBLE))) AS x FROM (
      SELECT f.recording_id, f.start_s, f.end_s, CASE WHEN NOT f.all_known THEN -1 WHEN f.speakers = 0 THEN 0 WHEN e.state <> 'SPEAKING' THEN 2 WHEN f.speakers = 1 THEN 1 ELSE 3 END AS code,
        unnest(range(CAST(floor(f.start_s / 10) AS BIGINT), greatest(CAST(floor(f.start_s / 10) AS BIGINT) + 1, CAST(ceil(f.end_s / 10) AS BIGINT)))) AS unit
      FROM flr f JOIN pstates e ON e.recording_id = f.recording_id AND e.ordinal = f.ordinal AND e.participant_index = 0)) GROUP BY 1, 2) o ON o.recording_id = c.recording_id AND o.unit = c.decision_index""")
part("spans", "flr", "SELECT recording_id, min(start_s) AS a, max(end_s) AS b FROM (SELECT *, ordinal - row_number() OVER (PARTITION BY recording_id ORDER BY ordinal) AS g FROM flr WHERE all_known) GROUP BY recording_id, g")
part("ref0", "cel", f"SELECT recording_id, decision_index, (decision_index + 1) * CAST(10 AS DOUBLE) AS r, (decision_index + 1) * CAST(10 AS DOUBLE) - {EPS} AS q FROM cel")
part("refs", "ref0 spans", f"SELECT c.*, CASE WHEN c.r <= s.b + {EPS} THEN s.a END AS a, CASE WHEN c.r <= s.b + {EPS} THEN s.b END AS b FROM ref0 c ASOF LEFT JOIN spans s ON s.recording_id = c.recording_id AND s.a < c.q")
_STREAMS = {
    "ego_onset": ("pevents", "SELECT DISTINCT recording_id, time_s AS t FROM pevents WHERE kind = 'onset' AND participant_index = 0"),
    "ego_offset": ("pevents", "SELECT DISTINCT recording_id, time_s AS t FROM pevents WHERE kind = 'offset' AND participant_index = 0"),
    "other_onset": ("pevents", "SELECT DISTINCT recording_id, time_s AS t FROM pevents WHERE kind = 'onset' AND participant_index > 0"),
    "other_offset": ("pevents", "SELECT DISTINCT recording_id, time_s AS t FROM pevents WHERE kind = 'offset' AND participant_index > 0"),
    "floor_change": ("fchanges", "SELECT recording_id, time_s AS t, next_holder FROM fchanges"),
    "onset": ("pevents", "SELECT recording_id, time_s AS t, min(participant_index) AS who, count(DISTINCT participant_index) > 1 AS tie FROM pevents WHERE kind = 'onset' GROUP BY 1, 2"),
    "stretch": ("flr", "SELECT recording_id, start_s AS t, solo FROM (SELECT *, lag(solo) OVER (PARTITION BY recording_id ORDER BY ordinal) AS was FROM flr) WHERE solo IS NOT NULL AND (was IS NULL OR was <> solo)"),
    "speech_end": ("flr", "SELECT recording_id, end_s AS t FROM flr WHERE all_known AND speakers > 0"),
}
for _n, (_needs, _body) in _STREAMS.items():
    part(f"s_{_n}", _needs, _body)


def _asof(name: str, columns: str, forward: bool) -> str:
    op = ">=" if forward else "<"
    return f"(SELECT c.recording_id, c.decision_index, {columns} FROM ref0 c ASOF LEFT JOIN s_{name} e ON e.recording_id = c.recording_id AND e.t {op} c.q)"


_TIMES = ("ego_onset", "ego_offset", "other_onset", "other_offset", "floor_change")
_TIMING = "SELECT r.recording_id, r.decision_index, " + ", ".join(
    [f"round(CASE WHEN l_{n}.t >= a - {EPS} THEN r - l_{n}.t END, 6) AS time_since_{n}" for n in _TIMES]
    + [f"round(CASE WHEN n_{n}.t <= b + {EPS} THEN greatest(n_{n}.t - r, 0) END, 6) AS time_to_next_{n}" for n in _TIMES]
    + [
        f"round(CASE WHEN n_onset.t <= b + {EPS} THEN greatest(n_onset.t - r, 0) END, 6) AS time_to_next_speaker_onset",
        f"round(CASE WHEN a IS NOT NULL AND p.speakers > 0 AND p.all_known THEN 0 WHEN l_speech_end.t >= a - {EPS} THEN r - l_speech_end.t END, 6) AS time_since_speaker_activity",
        f"round(CASE WHEN a IS NOT NULL AND r <= z.end_s + {EPS} AND z.start_s > a + {EPS} THEN r - z.start_s END, 6) AS silence_duration",
        "round(r - a, 6) AS time_since_observation_start",
        "round(b - r, 6) AS time_to_observation_end",
    ]
) + " FROM refs r " + " ".join(
    [f"JOIN {_asof(n, 'e.t', False)} l_{n} ON l_{n}.recording_id = r.recording_id AND l_{n}.decision_index = r.decision_index" for n in (*_TIMES, "speech_end")]
    + [f"JOIN {_asof(n, 'e.t', True)} n_{n} ON n_{n}.recording_id = r.recording_id AND n_{n}.decision_index = r.decision_index" for n in (*_TIMES, "onset")]
) + " ASOF LEFT JOIN flr p ON p.recording_id = r.recording_id AND p.start_s < r.q ASOF LEFT JOIN sil z ON z.recording_id = r.recording_id AND z.start_s < r.q"

_LIST = "array_to_string(list_transform({x}, lambda v: coalesce(CAST(v AS VARCHAR), '-')), ',')"
_OTHERS = "CASE WHEN list_contains(codes[2:], 1) THEN true WHEN list_contains(codes[2:], 2) THEN NULL ELSE false END"
_COUNT = "len(list_filter(codes, lambda v: v = 1))"
_VIEWS = {
    "ego_speaking": "CASE WHEN codes[1] <> 2 THEN codes[1] = 1 END",
    "others_active": _OTHERS,
    "joint_speech_state": "CASE WHEN NOT list_contains(codes, 2) THEN codes[1] + 2 * CAST(list_contains(codes[2:], 1) AS INT) END",
    "active_speaker_count": f"CASE WHEN NOT list_contains(codes, 2) THEN {_COUNT} END",
    "floor_holder": f"CASE WHEN NOT list_contains(codes, 2) THEN CASE WHEN {_COUNT} = 0 THEN -1 WHEN {_COUNT} > 1 THEN -2 ELSE list_position(codes, 1) - 1 END END",
}
_CODES = _LIST.format(x="list_transform(codes, lambda w: CASE WHEN w <> 2 THEN w END)")
part(
    "unk_before",
    "pstates",
    f"""SELECT recording_id, unit, min(participant_index) AS lo, max(participant_index) AS hi FROM (
      SELECT *, unnest(range(CAST(floor(start_s / 5) AS BIGINT), CAST(floor(end_s / 5) AS BIGINT) + 1)) AS unit FROM pstates WHERE state = 'UNKNOWN')
      WHERE start_s < unit * CAST(5 AS DOUBLE) - {EPS} AND end_s >= unit * CAST(5 AS DOUBLE) - {EPS} GROUP BY 1, 2""",
)
_EARLY = f"(u.decision_index * 2 + u.place) * CAST(5 AS DOUBLE) <= {EPS}"
_EGO_BAD = f"{_EARLY} OR codes[1] = 2 OR coalesce(b.lo, 1) = 0"
_OTHER_BAD = f"{_EARLY} OR list_contains(codes[2:], 2) OR coalesce(b.hi, 0) > 0"
ORACLE_SQL = {
    "g4_instantaneous_labels": sql(
        "ucodes ccodes",
        "SELECT u.recording_id, u.decision_index, speaker_activity_subframes, " + ", ".join(f"{n}_subframes" for n in _VIEWS) + ", speaker_activity, ego_speaking, others_active FROM (SELECT recording_id, decision_index, string_agg("
        + _CODES + ", '|' ORDER BY place) AS speaker_activity_subframes, " + ", ".join(f"string_agg(coalesce(CAST({v} AS VARCHAR), '-'), ',' ORDER BY place) AS {n}_subframes" for n, v in _VIEWS.items())
        + " FROM ucodes GROUP BY 1, 2) u JOIN (SELECT recording_id, decision_index, " + _CODES + f" AS speaker_activity, {_VIEWS['ego_speaking']} AS ego_speaking, {_OTHERS} AS others_active FROM ccodes) c ON c.recording_id = u.recording_id AND c.decision_index = u.decision_index",
    ),
    "g7_joint_occupancy": sql("occ", f"SELECT recording_id, decision_index, " + ", ".join(f"round(CASE WHEN h <= {EPS} THEN s[{k + 1}] END, 6) AS share_{k}" for k in range(4)) + " FROM occ"),
    "g9_event_units": sql(
        "ucodes pevents fchanges unk_before flr",
        "SELECT u.recording_id, u.decision_index, CAST(u.place AS BIGINT) AS place, " + ", ".join(f"CASE WHEN e.{w}_{k} THEN true WHEN {_EGO_BAD if w == 'ego' else _OTHER_BAD} THEN NULL ELSE false END AS {w}_{k}" for k in ("onset", "offset") for w in ("ego", "other"))
        + f""", CASE WHEN f.p IS NOT NULL THEN true WHEN list_contains(codes, 2) OR {_EARLY} OR h.last_unique IS NULL THEN NULL ELSE false END AS floor_change, CAST(f.p AS BIGINT) AS previous_floor_holder, CAST(f.n AS BIGINT) AS next_floor_holder FROM (SELECT *, (decision_index * 2 + place) * CAST(5 AS DOUBLE) - {EPS} AS edge FROM ucodes) u
        ASOF LEFT JOIN flr h ON h.recording_id = u.recording_id AND h.start_s < u.edge
        LEFT JOIN (SELECT recording_id, CAST(floor((time_s + {EPS}) / 5) AS BIGINT) AS unit, """
        + ", ".join(f"bool_or(kind = '{k}' AND participant_index {'=' if w == 'ego' else '>'} 0) AS {w}_{k}" for k in ("onset", "offset") for w in ("ego", "other"))
        + f""" FROM pevents GROUP BY 1, 2) e ON e.recording_id = u.recording_id AND e.unit = u.decision_index * 2 + u.place
        LEFT JOIN (SELECT recording_id, CAST(floor((time_s + {EPS}) / 5) AS BIGINT) AS unit, min_by(previous_holder, time_s) AS p, max_by(next_holder, time_s) AS n FROM fchanges GROUP BY 1, 2) f ON f.recording_id = u.recording_id AND f.unit = u.decision_index * 2 + u.place
        LEFT JOIN unk_before b ON b.recording_id = u.recording_id AND b.unit = u.decision_index * 2 + u.place""",
    ),
    "g13_timing_labels": sql("refs ref0 flr sil " + " ".join(f"s_{n}" for n in (*_TIMES, "onset", "speech_end")), _TIMING),
    "g16_next_speakers": sql(
        "refs ref0 flr s_onset s_stretch s_floor_change",
        f"""SELECT r.recording_id, r.decision_index, CAST(CASE WHEN o.t <= b + {EPS} AND NOT o.tie THEN o.who END AS BIGINT) AS next_speaker, CAST(CASE WHEN u.t <= b + {EPS} THEN u.solo END AS BIGINT) AS next_unique_speaker,
        CASE WHEN u.t <= b + {EPS} THEN u.solo = p.last_unique END AS current_speaker_continues, CAST(CASE WHEN f.t <= b + {EPS} THEN f.next_holder END AS BIGINT) AS floor_transfer_target
        FROM refs r JOIN {_asof('onset', 'e.t, e.who, e.tie', True)} o ON o.recording_id = r.recording_id AND o.decision_index = r.decision_index JOIN {_asof('stretch', 'e.t, e.solo', True)} u ON u.recording_id = r.recording_id AND u.decision_index = r.decision_index
        JOIN {_asof('floor_change', 'e.t, e.next_holder', True)} f ON f.recording_id = r.recording_id AND f.decision_index = r.decision_index ASOF LEFT JOIN flr p ON p.recording_id = r.recording_id AND p.start_s < r.q""",
    ),
    "g18_future_events": sql(
        "refs ref0 s_onset s_ego_onset s_ego_offset s_other_onset s_other_offset",
        "SELECT r.recording_id, r.decision_index, h AS horizon_s, " + ", ".join(f"CASE WHEN r + h <= b + {EPS} THEN coalesce(x_{n}.t < r + h - {EPS}, false) END AS future_{n}" for n in _TIMES[:4])
        + f", CAST(CASE WHEN r + h <= b + {EPS} THEN CASE WHEN NOT coalesce(x_onset.t < r + h - {EPS}, false) THEN -1 WHEN NOT x_onset.tie THEN x_onset.who END END AS BIGINT) AS future_next_speaker FROM (SELECT *, unnest([10.0::DOUBLE, 50.0::DOUBLE, 100.0::DOUBLE]) AS h FROM refs) r "
        + " ".join(f"JOIN {_asof(n, 'e.t' + (', e.who, e.tie' if n == 'onset' else ''), True)} x_{n} ON x_{n}.recording_id = r.recording_id AND x_{n}.decision_index = r.decision_index" for n in (*_TIMES[:4], "onset")),
    ),
    "g19_ego_solo_share": sql("occ", f"SELECT recording_id, decision_index, round(CASE WHEN h <= {EPS} THEN s[2] END, 6) AS ego_solo_mask_fraction FROM occ"),
}

ORACLE_SQL["g11_onset_context_units"] = sql(
    "ctx",
    f"""SELECT recording_id, CAST(floor(unit / 2) AS BIGINT) AS decision_index, unit % 2 AS place, CAST(previous_unique_speaker AS BIGINT) AS previous_unique_speaker, previous_unique_speaker = 0 AS ego_was_last_unique_speaker, others_at AS others_active_at_ego_onset,
    round(silence_before_s, 6) AS silence_duration_before_ego_onset, simultaneous AS simultaneous_other_onset, onset_type <> 'undetermined' AS ego_onset_context_valid, onset_type AS ego_onset_type
    FROM (SELECT *, CAST(floor((time_s + {EPS}) / 5) AS BIGINT) AS unit FROM ctx WHERE participant_index = 0) QUALIFY row_number() OVER (PARTITION BY recording_id, unit ORDER BY time_s) = 1""",
)
ORACLE_SQL["g12_overlap_units"] = sql(
    "ucodes ovl",
    "SELECT u.recording_id, u.decision_index, CAST(u.place AS BIGINT) AS place, "
    + ", ".join(f"CASE WHEN o.{k} THEN true WHEN list_contains(codes, 2){' OR coalesce(o.undetermined, false)' if k != 'simultaneous_onset' else ''} THEN NULL ELSE false END AS {k}_overlap" for k in ("within", "between", "simultaneous_onset"))
    + f""" FROM ucodes u LEFT JOIN (SELECT recording_id, unit, """
    + ", ".join(f"bool_or(overlap_type = '{k}') AS {k}" for k in ("within", "between", "simultaneous_onset", "undetermined"))
    + f""" FROM (SELECT *, unnest(range(CAST(floor(start_s / 5) AS BIGINT), greatest(CAST(floor(start_s / 5) AS BIGINT) + 1, CAST(ceil(end_s / 5) AS BIGINT)))) AS unit FROM ovl)
    WHERE least(end_s, (unit + 1) * CAST(5 AS DOUBLE)) - greatest(start_s, unit * CAST(5 AS DOUBLE)) > {EPS} GROUP BY 1, 2) o ON o.recording_id = u.recording_id AND o.unit = u.decision_index * 2 + u.place""",
)
ORACLE_SQL["g18_future_states"] = sql(
    "refs flr pstates",
    f"""SELECT r.recording_id, r.decision_index, h AS horizon_s, CAST(CASE WHEN r + h <= b + {EPS} THEN p.ego + 2 * CAST(p.speakers > p.ego AS INT) END AS BIGINT) AS future_joint_speech_state, CAST(CASE WHEN r + h <= b + {EPS} THEN p.holder END AS BIGINT) AS future_floor_holder
    FROM (SELECT *, r + h - {EPS} AS at FROM (SELECT *, unnest([10.0::DOUBLE, 50.0::DOUBLE, 100.0::DOUBLE]) AS h FROM refs)) r
    ASOF LEFT JOIN (SELECT f.recording_id, f.start_s, f.speakers, f.holder, CAST(e.state = 'SPEAKING' AS INT) AS ego FROM flr f JOIN pstates e ON e.recording_id = f.recording_id AND e.ordinal = f.ordinal AND e.participant_index = 0) p ON p.recording_id = r.recording_id AND p.start_s < r.at""".replace(" AS at FROM", " AS point FROM").replace("r.at", "r.point"),
)
part("unk_who", "pstates", PARTS["unk_before"][1].replace("min(participant_index) AS lo, max(participant_index) AS hi", "list(DISTINCT participant_index) AS hid"))
part("ev_who", "pevents", f"SELECT recording_id, CAST(floor((time_s + {EPS}) / 5) AS BIGINT) AS unit, list(DISTINCT participant_index) FILTER (WHERE kind = 'onset') AS onset, list(DISTINCT participant_index) FILTER (WHERE kind = 'offset') AS offset_ FROM pevents GROUP BY 1, 2")
_FLAG = "list_transform(ok, lambda v, i: CASE WHEN coalesce(list_contains({n}, i - 1), false) THEN true WHEN v THEN false END)"
ORACLE_SQL["g9_speaker_event_units"] = sql(
    "ucodes unk_who ev_who",
    "SELECT recording_id, decision_index, CAST(place AS BIGINT) AS place, " + _LIST.format(x=_FLAG.format(n="onset")) + " AS speaker_onset, " + _LIST.format(x=_FLAG.format(n="offset_")) + " AS speaker_offset, " + _LIST.format(x="ok")
    + f""" AS speaker_transition_valid FROM (
      SELECT u.recording_id, u.decision_index, u.place, e.onset, e.offset_, list_transform(codes, lambda c, i: NOT ({_EARLY}) AND c <> 2 AND NOT coalesce(list_contains(b.hid, i - 1), false)) AS ok FROM ucodes u
      LEFT JOIN ev_who e ON e.recording_id = u.recording_id AND e.unit = u.decision_index * 2 + u.place LEFT JOIN unk_who b ON b.recording_id = u.recording_id AND b.unit = u.decision_index * 2 + u.place)""",
)
part("said", "pstates flr", """SELECT recording_id, who, unit, sum(greatest(0, least(end_s, (unit + 1) * CAST(10 AS DOUBLE)) - greatest(start_s, unit * CAST(10 AS DOUBLE)))) AS s FROM (
  SELECT *, unnest(range(CAST(floor(start_s / 10) AS BIGINT), greatest(CAST(floor(start_s / 10) AS BIGINT) + 1, CAST(ceil(end_s / 10) AS BIGINT)))) AS unit FROM (
    SELECT recording_id, participant_index AS who, start_s, end_s FROM pstates WHERE state = 'SPEAKING' UNION ALL SELECT recording_id, -1, start_s, end_s FROM flr WHERE all_known AND speakers >= 2)) GROUP BY 1, 2, 3""")
part("later", "said", f"""SELECT recording_id, decision_index, h, list(who) AS w FROM (SELECT recording_id, unit - j AS decision_index, h, who, sum(s) AS s FROM said,
  (SELECT h, unnest(range(1, n + 1)) AS j FROM (VALUES (10, 1), (50, 5), (100, 10)) t(h, n)) GROUP BY 1, 2, 3, 4 HAVING sum(s) > {EPS}) GROUP BY 1, 2, 3""")
ORACLE_SQL["g18_future_activity"] = sql(
    "refs later",
    f"""SELECT r.recording_id, r.decision_index, CAST(r.h AS DOUBLE) AS horizon_s, CASE WHEN ok THEN {_LIST.format(x="list_transform([0, 1, 2, 3], lambda p: list_contains(l, p))")} END AS future_speaker_activity, CASE WHEN ok THEN list_contains(l, 0) END AS future_ego_activity,
    CASE WHEN ok THEN list_contains(l, 1) OR list_contains(l, 2) OR list_contains(l, 3) END AS future_others_activity, CASE WHEN ok THEN list_contains(l, -1) END AS future_overlap
    FROM (SELECT c.recording_id, c.decision_index, c.h, coalesce(c.r + c.h <= c.b + {EPS}, false) AS ok, coalesce(w, CAST([] AS BIGINT[])) AS l FROM (SELECT *, unnest([10, 50, 100]) AS h FROM refs) c
      LEFT JOIN later f ON f.recording_id = c.recording_id AND f.decision_index = c.decision_index AND f.h = c.h) r""",
)
_COUNTED = {n: v for n, v in _VIEWS.items()}
ORACLE_SQL["l4_label_coverage"] = sql(
    "ucodes ccodes occ",
    " UNION ALL ".join(
        [f"SELECT '{n}_subframes' AS label, count(*) AS units, count({v}) AS known, count(*) - count({v}) AS missing FROM ucodes" for n, v in _COUNTED.items()]
        + ["SELECT 'speaker_activity', count(*), count(*) FILTER (WHERE c <> 2), count(*) FILTER (WHERE c = 2) FROM (SELECT unnest(codes) AS c FROM ccodes)"]
        + [f"SELECT '{n}', count(*), count({_VIEWS[n]}), count(*) - count({_VIEWS[n]}) FROM ccodes" for n in ("ego_speaking", "others_active")]
        + [f"SELECT 'joint_speech_state_occupancy', 4 * count(*), 4 * count(*) FILTER (WHERE h <= {EPS}), 4 * count(*) - 4 * count(*) FILTER (WHERE h <= {EPS}) FROM occ"]
    ),
)


def _long(source: str, stats: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS statistic, CAST({v} AS DOUBLE) AS value FROM {source}" for n, v in stats.items())


def _seven(value: str, name: str) -> dict[str, str]:
    return {f"{name}_q{round(q * 100)}": f"quantile_cont({value}, {q})" for q in lb.SANITY_QUANTILES}


_NEXT = {}
for _n in ("time_to_next_ego_onset", "time_to_next_other_onset"):
    _NEXT |= _seven(_n, _n) | {f"{_n}_censored": f"avg(CAST({_n} IS NULL AS INT))"}
ORACLE_SQL["l5_sanity_statistics"] = sql(
    "ucodes ccodes pevents ctx fchanges trn ovl sil refs ref0 flr " + " ".join(f"s_{n}" for n in (*_TIMES, "onset", "speech_end")),
    f", tm AS ({_TIMING}), uf AS (SELECT len(list_filter(codes, lambda v: v = 1)) AS n FROM ucodes WHERE NOT list_contains(codes, 2)), td AS (SELECT end_s - start_s AS d FROM trn) SELECT statistic, round(value, 3) AS value FROM ("
    + " UNION ALL ".join([
        _long("ccodes", {"cells": "count(*)", "ego_speaking_share": f"avg(CAST({_VIEWS['ego_speaking']} AS INT))", "others_active_share": f"avg(CAST({_OTHERS} AS INT))"}),
        _long("uf", {"overlap_share": "avg(CAST(n >= 2 AS INT))", "silence_share": "avg(CAST(n = 0 AS INT))"}),
        _long("tm", _NEXT),
        _long("pevents", {"onsets": "count(*) FILTER (WHERE kind = 'onset')", "offsets": "count(*) FILTER (WHERE kind = 'offset')", "ego_onsets": "count(*) FILTER (WHERE kind = 'onset' AND participant_index = 0)"}),
        _long("fchanges", {"floor_changes": "count(*)", "overlap_transfer_share": "avg(CAST(fto_s < 0 AS INT))", **_seven("fto_s", "fto")}),
        "SELECT 'onset_' || onset_type, count(*) FROM ctx GROUP BY 1",
        _long("td", {"turns": "count(*)", **_seven("d", "turn")}),
        "SELECT 'overlap_' || overlap_type, count(*) FROM ovl GROUP BY 1",
        "SELECT 'silence_' || CASE WHEN previous_speaker = next_speaker THEN 'pause' WHEN previous_speaker <> next_speaker THEN 'gap' ELSE 'undetermined' END, count(*) FROM sil GROUP BY 1",
    ]) + ")",
)
