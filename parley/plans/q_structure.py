"""Queries on conversational structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import structure as s
from parley.plans.oracle import EPS, sql
from parley.plans.q_state import events, rounded
from parley.sources import canonical as c
from parley.sources.shared import saved

#: Statistics that both engines give to the last bit.
EXACT = tuple(f for f in s.PROFILE_FEATURES if f.endswith(("_mean_s", "_median_s", "_q10_s", "_q90_s")))
RULES = s.Rules(turn_pause_s=30.0, simultaneous_s=5.0, local_gap_s=60.0, local_overlap_s=60.0)


def states(spark, sf_dir):
    e = events(spark, sf_dir)
    return s.participant_states(c.recordings(e), c.participants(e), c.speech(e), c.unknown(e))


def t1_participant_order(spark, sf_dir):
    return rounded(s.order_participants(c.participants(events(spark, sf_dir))).select("recording_id", "participant_id", "participant_index"))


def t2_participant_states(spark, sf_dir):
    return rounded(states(spark, sf_dir))


def t3_floor_holder(spark, sf_dir):
    return rounded(s.floor(states(spark, sf_dir)).select("recording_id", "ordinal", "start_s", "end_s", "speakers", "all_known", "holder"))


def t4_last_unique_speaker(spark, sf_dir):
    return rounded(s.floor(states(spark, sf_dir)).select("recording_id", "ordinal", "last_unique"))


def t5_speaker_events(spark, sf_dir):
    return rounded(s.speaker_events(states(spark, sf_dir)))


def t6_floor_changes(spark, sf_dir):
    return rounded(s.floor_changes(states(spark, sf_dir), RULES).drop("kind", "locality"))


def t7_floor_transfers(spark, sf_dir):
    return rounded(s.floor_changes(states(spark, sf_dir), RULES).select("recording_id", "time_s", "kind", "locality", "fto_s"))


def t8_speech_runs(spark, sf_dir):
    return rounded(s.speech_runs(states(spark, sf_dir)))


def t9_overlaps(spark, sf_dir):
    return rounded(s.overlaps(states(spark, sf_dir), RULES))


def t10_silences(spark, sf_dir):
    return rounded(s.silences(states(spark, sf_dir)))


def t11_turns(spark, sf_dir):
    return rounded(s.turns(states(spark, sf_dir), RULES))


def t12_simultaneous_onsets(spark, sf_dir):
    return rounded(s.simultaneous_onsets(states(spark, sf_dir), RULES))


def t13_onset_contexts(spark, sf_dir):
    return rounded(s.onset_contexts(states(spark, sf_dir), RULES))


def t14_observed_spans(spark, sf_dir):
    return rounded(s.observed_spans(states(spark, sf_dir)))


def t15_events_table(spark, sf_dir):
    out = s.events_table(saved(s.joint(states(spark, sf_dir)), "pieces"), RULES)
    return rounded(out.select("recording_id", "event", "participant_index", "time_s", "onset_type", "simultaneous", "silence_before_s", "previous_holder", "next_holder", "transfer_kind", "locality", "fto_s"))


def t16_segments_table(spark, sf_dir):
    out = s.segments_table(states(spark, sf_dir), RULES)
    return rounded(out.select("recording_id", "segment", "start_s", "end_s", "participant_index", "runs", "pauses_s", "fto_from_previous_s", "initial", "entering", "overlap_type", "previous_speaker", "next_speaker", "silence_type", "start_censored", "end_censored"))


def t18_participant_profiles(spark, sf_dir):
    return rounded(s.profiles(saved(s.joint(states(spark, sf_dir)), "pieces"), RULES), exact=EXACT)


def t17_recordings(spark, sf_dir):
    e = events(spark, sf_dir)
    out = s.recordings_table(c.recordings(e), c.participants(e))
    return rounded(out.withColumn("participant_ids", F.array_join("participant_ids", ",")).drop("week"))


def t17_participants(spark, sf_dir):
    out = s.participants_table(c.participants(events(spark, sf_dir)), s.profiles(saved(s.joint(states(spark, sf_dir)), "pieces"), RULES))
    vector, names = F.col("interaction_profile_features"), F.col("interaction_profile_feature_names")
    at = {n: F.element_at(vector, F.array_position(names, F.lit(n)).cast("int")) for n in ("turn_count", "onset_count", "floor_yields", "speaking_time_s")}
    return rounded(out.select("recording_id", "participant_id", "participant_index", "is_ego", "is_resolved", F.size(vector).alias("features"), *(v.alias(n) for n, v in at.items())))


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] == "t" and k.split("_")[0][1:].isdigit()}

_KIND = f"CASE WHEN abs(fto_s) <= {EPS} THEN 'no_gap_no_overlap' WHEN fto_s > 0 THEN 'gap' ELSE 'overlap' END"
_LOCAL = "CASE WHEN fto_s > 60 THEN 'long_gap' WHEN fto_s < -60 THEN 'long_overlap' ELSE 'local' END"
_SIL = "CASE WHEN previous_speaker = next_speaker THEN 'pause' WHEN previous_speaker <> next_speaker THEN 'gap' ELSE 'undetermined' END"


def _N(column: str) -> str:
    return f"CAST(coalesce({column}, 0) AS DOUBLE)"


def _M(seconds: str) -> str:
    return f"sum(round(({seconds}) * 1e6)) / count({seconds}) / CAST(1e6 AS DOUBLE)"


def _Q(seconds: str, q: float = 0.5) -> str:
    return f"round(quantile_cont(round(({seconds}) * 1e6), {q}), 1) / CAST(1e6 AS DOUBLE)"


ORACLE_SQL = {
    "t1_participant_order": sql("who", "SELECT recording_id, participant_id, CAST(participant_index AS BIGINT) AS participant_index FROM who"),
    "t2_participant_states": sql("pstates", "SELECT recording_id, ordinal, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, CAST(participant_index AS BIGINT) AS participant_index, state FROM pstates"),
    "t3_floor_holder": sql("flr", "SELECT recording_id, ordinal, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, speakers, all_known, CAST(holder AS BIGINT) AS holder FROM flr"),
    "t4_last_unique_speaker": sql("flr", "SELECT recording_id, ordinal, CAST(last_unique AS BIGINT) AS last_unique FROM flr"),
    "t5_speaker_events": sql("pevents", "SELECT recording_id, ordinal, round(time_s, 6) AS time_s, kind, CAST(participant_index AS BIGINT) AS participant_index FROM pevents"),
    "t6_floor_changes": sql("fchanges", "SELECT recording_id, ordinal, round(time_s, 6) AS time_s, CAST(previous_holder AS BIGINT) AS previous_holder, CAST(next_holder AS BIGINT) AS next_holder, round(previous_run_end_s, 6) AS previous_run_end_s, round(next_run_start_s, 6) AS next_run_start_s, round(fto_s, 6) AS fto_s FROM fchanges"),
    "t7_floor_transfers": sql("fchanges", f"SELECT recording_id, round(time_s, 6) AS time_s, {_KIND} AS kind, {_LOCAL} AS locality, round(fto_s, 6) AS fto_s FROM fchanges"),
    "t8_speech_runs": sql("pruns", "SELECT recording_id, CAST(participant_index AS BIGINT) AS participant_index, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, first_piece, last_piece, start_censored, end_censored FROM pruns"),
    "t9_overlaps": sql("ovl", "SELECT recording_id, CAST(initial AS BIGINT) AS initial, CAST(entering AS BIGINT) AS entering, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, overlap_type, CAST(previous_floor_holder AS BIGINT) AS previous_floor_holder, valid FROM ovl"),
    "t10_silences": sql("sil", f"SELECT recording_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, CAST(previous_speaker AS BIGINT) AS previous_speaker, CAST(next_speaker AS BIGINT) AS next_speaker, {_SIL} AS silence_type, {_SIL} <> 'undetermined' AS valid FROM sil"),
    "t11_turns": sql("trn", "SELECT recording_id, CAST(participant_index AS BIGINT) AS participant_index, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, runs, round(pauses_s, 6) AS pauses_s, start_censored, end_censored, CAST(previous_participant AS BIGINT) AS previous_participant, CAST(next_participant AS BIGINT) AS next_participant, round(fto_from_previous_s, 6) AS fto_from_previous_s FROM trn"),
    "t12_simultaneous_onsets": sql("ctx", "SELECT recording_id, ordinal, round(time_s, 6) AS time_s, 'onset' AS kind, CAST(participant_index AS BIGINT) AS participant_index, simultaneous FROM ctx"),
    "t13_onset_contexts": sql("ctx", "SELECT recording_id, ordinal, round(time_s, 6) AS time_s, CAST(participant_index AS BIGINT) AS participant_index, CAST(previous_unique_speaker AS BIGINT) AS previous_unique_speaker, others_before, others_at, round(silence_before_s, 6) AS silence_before_s, simultaneous, onset_type FROM ctx"),
    "t14_observed_spans": sql("flr", "SELECT recording_id, round(min(start_s), 6) AS start_s, round(max(end_s), 6) AS end_s FROM (SELECT *, ordinal - row_number() OVER (PARTITION BY recording_id ORDER BY ordinal) AS g FROM flr WHERE all_known) GROUP BY recording_id, g"),
    "t15_events_table": sql("ctx pevents fchanges", f"""SELECT recording_id, 'onset' AS event, participant_index, round(time_s, 6) AS time_s, onset_type, simultaneous, round(silence_before_s, 6) AS silence_before_s, CAST(NULL AS INT) AS previous_holder, CAST(NULL AS INT) AS next_holder, NULL AS transfer_kind, NULL AS locality, CAST(NULL AS DOUBLE) AS fto_s FROM ctx
      UNION ALL SELECT recording_id, 'offset', participant_index, round(time_s, 6), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM pevents WHERE kind = 'offset'
      UNION ALL SELECT recording_id, 'floor_change', NULL, round(time_s, 6), NULL, NULL, NULL, previous_holder, next_holder, {_KIND}, {_LOCAL}, round(fto_s, 6) FROM fchanges"""),
    "t16_segments_table": sql("pruns trn ovl sil", f"""SELECT recording_id, 'run' AS segment, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, participant_index, CAST(NULL AS BIGINT) AS runs, CAST(NULL AS DOUBLE) AS pauses_s, CAST(NULL AS DOUBLE) AS fto_from_previous_s, CAST(NULL AS INT) AS initial, CAST(NULL AS INT) AS entering,
        NULL AS overlap_type, CAST(NULL AS INT) AS previous_speaker, CAST(NULL AS INT) AS next_speaker, NULL AS silence_type, start_censored, end_censored FROM pruns
      UNION ALL SELECT recording_id, 'turn', round(start_s, 6), round(end_s, 6), participant_index, runs, round(pauses_s, 6), round(fto_from_previous_s, 6), NULL, NULL, NULL, NULL, NULL, NULL, start_censored, end_censored FROM trn
      UNION ALL SELECT recording_id, 'overlap', round(start_s, 6), round(end_s, 6), NULL, NULL, NULL, NULL, initial, entering, overlap_type, NULL, NULL, NULL, NULL, NULL FROM ovl
      UNION ALL SELECT recording_id, 'silence', round(start_s, 6), round(end_s, 6), NULL, NULL, NULL, NULL, NULL, NULL, NULL, previous_speaker, next_speaker, {_SIL}, NULL, NULL FROM sil"""),
    "t17_recordings": sql("recs", """SELECT 'events' AS dataset, recording_id, 'week-' || week(CAST(substr(recording_id, 1, 10) AS DATE)) || substr(recording_id, 14) AS conversation_id, recording_id AS view_id, 'click' AS wearer_id, lo AS start_s, hi AS end_s,
      'click,purchase,signup,view' AS participant_ids, 4 AS participant_count, 0 AS wearer_index, hi - lo AS duration_s FROM recs"""),
    "t17_participants": sql("who pstates trn pevents fchanges floor0", """SELECT recording_id, participant_id, CAST(w.participant_index AS BIGINT) AS participant_index, w.participant_index = 0 AS is_ego, true AS is_resolved, 33 AS features,
      CAST(coalesce(turn_count, 0) AS DOUBLE) AS turn_count, CAST(coalesce(onset_count, 0) AS DOUBLE) AS onset_count, CAST(coalesce(floor_yields, 0) AS DOUBLE) AS floor_yields, round(coalesce(speaking_time_s, 0), 6) AS speaking_time_s
      FROM who w LEFT JOIN (SELECT recording_id, participant_index, count(*) AS turn_count FROM trn GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, participant_index, count(*) FILTER (WHERE kind = 'onset') AS onset_count FROM pevents GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, previous_holder AS participant_index, count(*) AS floor_yields FROM fchanges GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT p.recording_id, participant_index, sum(p.end_s - p.start_s) AS speaking_time_s FROM pstates p JOIN floor0 f USING (recording_id, ordinal) WHERE all_known AND state = 'SPEAKING' GROUP BY 1, 2) USING (recording_id, participant_index)"""),
    "t18_participant_profiles": sql("pstates floor0 pruns trn sil pevents ctx ovl fchanges", f"""SELECT recording_id, CAST(participant_index AS BIGINT) AS participant_index, round(sp, 6) AS speaking_time_s, round(ob, 6) AS observed_duration_s, round(CASE WHEN ob > 0 THEN sp / ob END, 6) AS speaking_ratio,
      {_N("rn")} AS speech_run_count, rm AS run_duration_mean_s, rq AS run_duration_median_s, {_N("tn")} AS turn_count, round(CASE WHEN ob > 0 THEN coalesce(tn, 0) * 60 / ob END, 6) AS turns_per_minute,
      tm AS turn_duration_mean_s, tq AS turn_duration_median_s, round(ts, 6) AS turn_duration_std_s, {_N("sn")} AS pause_count, sm AS pause_duration_mean_s, sq AS pause_duration_median_s,
      {_N("eo")} AS onset_count, {_N("ef")} AS offset_count, {_N("ca")} AS onset_after_silence_count, {_N("cf")} AS onset_floor_transfer_count, {_N("co")} AS onset_overlap_count, {_N("oe")} AS overlaps_entered, {_N("orr")} AS overlaps_received,
      {_N("ow")} AS within_overlaps_entered, {_N("ob2")} AS between_overlaps_entered, {_N("ob2")} AS interruption_like_count, round(ot, 6) AS overlap_time_s, {_N("fn")} AS floor_takes, {_N("yn")} AS floor_yields,
      fm AS fto_take_mean_s, fq[2] AS fto_take_median_s, fq[1] AS fto_take_q10_s, fq[3] AS fto_take_q90_s, lm AS response_latency_mean_s, lq AS response_latency_median_s
      FROM (SELECT p.recording_id, participant_index, coalesce(sum(p.end_s - p.start_s) FILTER (WHERE all_known AND state = 'SPEAKING'), 0) AS sp, coalesce(sum(p.end_s - p.start_s) FILTER (WHERE all_known), 0) AS ob,
          coalesce(sum(p.end_s - p.start_s) FILTER (WHERE all_known AND state = 'SPEAKING' AND speakers > 1), 0) AS ot FROM pstates p JOIN floor0 f USING (recording_id, ordinal) GROUP BY 1, 2)
      LEFT JOIN (SELECT recording_id, participant_index, count(*) AS rn, {_M("end_s - start_s")} AS rm, {_Q("end_s - start_s")} AS rq FROM pruns GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, participant_index, count(*) AS tn, {_M("end_s - start_s")} AS tm, {_Q("end_s - start_s")} AS tq, stddev_pop(end_s - start_s) AS ts FROM trn GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, previous_speaker AS participant_index, count(*) AS sn, {_M("end_s - start_s")} AS sm, {_Q("end_s - start_s")} AS sq FROM sil WHERE previous_speaker = next_speaker GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, participant_index, count(*) FILTER (WHERE kind = 'onset') AS eo, count(*) FILTER (WHERE kind = 'offset') AS ef FROM pevents GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, participant_index, count(*) FILTER (WHERE onset_type = 'after_silence') AS ca, count(*) FILTER (WHERE onset_type = 'floor_transfer') AS cf, count(*) FILTER (WHERE onset_type = 'overlap') AS co FROM ctx GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, entering AS participant_index, count(*) AS oe, count(*) FILTER (WHERE overlap_type = 'within') AS ow, count(*) FILTER (WHERE overlap_type = 'between') AS ob2 FROM ovl GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, initial AS participant_index, count(*) AS orr FROM ovl GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, next_holder AS participant_index, count(*) AS fn, {_M("fto_s")} AS fm, [{_Q("fto_s", 0.1)}, {_Q("fto_s")}, {_Q("fto_s", 0.9)}] AS fq, {_M("CASE WHEN fto_s > 0 THEN fto_s END")} AS lm, {_Q("CASE WHEN fto_s > 0 THEN fto_s END")} AS lq FROM fchanges GROUP BY 1, 2) USING (recording_id, participant_index)
      LEFT JOIN (SELECT recording_id, previous_holder AS participant_index, count(*) AS yn FROM fchanges GROUP BY 1, 2) USING (recording_id, participant_index)"""),
}
