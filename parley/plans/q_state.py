"""Queries on intervals, state timelines and the decision grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import grid, intervals, state
from parley.plans.oracle import EPS, part, sql
from parley.sources import canonical as c
from parley.sources.shared import saved

STEP = 10.0
RP = ["recording_id", "participant_id"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.table(spark, sf_dir, "events")


def rounded(df: DataFrame, places: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, but for `exact` ones, and counts as long, so that both engines show the same."""
    out = []
    for name, kind in df.dtypes:
        if kind == "double" and name not in exact:
            out.append(F.round(name, places).alias(name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(F.col(name).cast("long").alias(name))
        else:
            out.append(F.col(name))
    return df.select(out)


def native(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    return state.native_timeline(c.recordings(e), c.speech(e), c.unknown(e))


def control(spark, sf_dir) -> DataFrame:
    return state.control_timeline(native(spark, sf_dir), STEP)


def _of(e: DataFrame, who: str) -> DataFrame:
    return c.speech(e).filter(F.col("participant_id") == who).select("recording_id", "start_s", "end_s")


def i1_normalize(spark, sf_dir):
    # Five seconds less: what is shorter ends before it starts.
    broken = c.speech(events(spark, sf_dir)).withColumn("end_s", F.col("end_s") - 5.0)
    return rounded(intervals.normalize(broken).groupBy("participant_id").agg(F.count("*").alias("n"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds")))


def i2_merge(spark, sf_dir):
    return rounded(intervals.merge(c.speech(events(spark, sf_dir)), RP, 2.0))


def i3_dilate(spark, sf_dir):
    return rounded(intervals.dilate(c.speech(events(spark, sf_dir)), RP, 3.0))


def i4_clip(spark, sf_dir):
    return rounded(intervals.clip(intervals.normalize(c.speech(events(spark, sf_dir))), F.lit(600.0), F.lit(2400.0)).drop("participant_id"))


def i5_total_duration(spark, sf_dir):
    return rounded(intervals.total_duration(c.speech(events(spark, sf_dir)), RP))


def i6_overlap(spark, sf_dir):
    e = events(spark, sf_dir)
    seg = c.speech(e).filter("end_s > start_s").select("recording_id", "annotation_id", "start_s", "end_s")
    return rounded(intervals.overlap(seg, _of(e, "purchase"), ["recording_id"]))


def i7_subtract(spark, sf_dir):
    e = events(spark, sf_dir)
    return rounded(intervals.subtract(_of(e, "click"), _of(e, "purchase"), ["recording_id"]))


def i8_nearest_offsets(spark, sf_dir):
    e = events(spark, sf_dir)
    seg = c.speech(e).filter("participant_id = 'view'").select("recording_id", "annotation_id", "start_s", "end_s")
    out = intervals.nearest_offsets(seg, _of(e, "purchase"), ["recording_id"])
    return rounded(out.select("recording_id", "annotation_id", F.abs("start_offset_s").alias("start_distance_s"), F.abs("end_offset_s").alias("end_distance_s")))


def i9_pieces(spark, sf_dir):
    return rounded(intervals.pieces(c.speech(events(spark, sf_dir)), ["recording_id"]))


def v1_timed_intervals(spark, sf_dir):
    return rounded(intervals.normalize(c.speech(events(spark, sf_dir))))


def v6_native_timeline(spark, sf_dir):
    return rounded(native(spark, sf_dir).select("recording_id", "native_index", "start_s", "end_s", "state", "annotation_ids"))


def v7_state_durations(spark, sf_dir):
    return rounded(state.durations(native(spark, sf_dir)))


def v8_unknown_reasons(spark, sf_dir):
    return rounded(state.unknown_reasons(native(spark, sf_dir)))


def v9_control_timeline(spark, sf_dir):
    return rounded(control(spark, sf_dir).drop("source_kind", "transform_kind"))


def v10_bridged_gaps(spark, sf_dir):
    return rounded(state.bridged_gaps(native(spark, sf_dir), STEP))


def v11_resolved_transitions(spark, sf_dir):
    return rounded(state.resolved_transitions(native(spark, sf_dir)))


def v12_control_summary(spark, sf_dir):
    return rounded(state.control_summary(native(spark, sf_dir), control(spark, sf_dir), STEP))


def v12_gap_histogram(spark, sf_dir):
    return rounded(state.gap_histogram(state.bridged_gaps(native(spark, sf_dir), STEP), STEP))


def v13_timeline_errors(spark, sf_dir):
    """In a third of the recordings the second interval is empty, in another it ends a second late."""
    hour, second = F.substring("recording_id", 12, 2).cast("int") % 3, F.col("native_index") == 1
    end = F.when(second & (hour == 0), F.col("start_s")).when(second & (hour == 1), F.col("end_s") + 1.0).otherwise(F.col("end_s"))
    return state.timeline_errors(native(spark, sf_dir).withColumn("end_s", end))


def v15_grid_bounds(spark, sf_dir):
    return rounded(grid.bounds(control(spark, sf_dir), STEP).drop("timeline_start_s"))


def v17_state_before_slot(spark, sf_dir):
    return rounded(grid.slots_with_state(control(spark, sf_dir), STEP))


def v18_transitions(spark, sf_dir):
    return rounded(state.transitions(control(spark, sf_dir)))


def v21_action_grid(spark, sf_dir):
    return rounded(grid.action_grid(control(spark, sf_dir), STEP))


def v22_compound_slots(spark, sf_dir):
    out = grid.compound_slots(native(spark, sf_dir), STEP)
    return rounded(out.withColumn("first_s", F.col("times_s")[0]).drop("times_s"))


def v23_sub_step_gaps(spark, sf_dir):
    return rounded(grid.sub_step_gaps(native(spark, sf_dir), STEP))


def v24_grid_summary(spark, sf_dir):
    return rounded(grid.summary(grid.action_grid(control(spark, sf_dir), STEP)))


def v24_timeline_summary(spark, sf_dir):
    return rounded(grid.timeline_summary(saved(native(spark, sf_dir), "native"), STEP))


def v25_compound_patterns(spark, sf_dir):
    return rounded(grid.pattern_counts(native(spark, sf_dir), STEP))


def v26_layer_deltas(spark, sf_dir):
    layers = [grid.timeline_summary(saved(t(spark, sf_dir), "timeline"), STEP) for t in (native, control)]
    return rounded(grid.layer_deltas(*layers))


def v25_grid_statistics(spark, sf_dir):
    return rounded(grid.statistics(grid.action_grid(control(spark, sf_dir), STEP)))


def v26_layer_comparison(spark, sf_dir):
    return rounded(grid.compare_layers(native(spark, sf_dir), control(spark, sf_dir), STEP).drop("invalid_timeline"))


def m23_grid_violations(spark, sf_dir):
    """A sound grid breaks no rule; so each recording's first seven slots are added once more, far after its end, with a fault each."""
    sound = grid.action_grid(control(spark, sf_dir), STEP)
    k, null = F.col("decision_index"), F.lit(None)
    valid = F.when(k == 0, False).when(k <= 5, True).otherwise(F.col("action_valid"))
    action = F.when(k.isin(0, 3, 5), "ONSET").when(k == 1, null).when(k == 2, "NO_EVENT").otherwise(F.col("action"))
    reason = F.when(k == 2, "unknown_state").when(k <= 5, null).otherwise(F.col("mask_reason"))
    time = F.when(k == 3, null).when(k == 5, 1.0).otherwise(F.col("event_time_s"))
    tau = F.when(k == 4, -1.0).when(k == 5, 5.0).when(k == 6, STEP).otherwise(F.col("tau_s"))
    state = F.when(k == 5, "SPEAKING").otherwise(F.col("state_before"))
    faults = sound.filter(k <= 6).select(*(c_ for c_ in sound.columns if c_ not in ("decision_index", "action_valid", "action", "mask_reason", "event_time_s", "tau_s", "state_before")), (k + 1000).alias("decision_index"), valid.alias("action_valid"), action.alias("action"), reason.alias("mask_reason"), time.alias("event_time_s"), tau.alias("tau_s"), state.alias("state_before"))
    return rounded(grid.grid_violations(sound.unionByName(faults), STEP))


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "ivm" and k.split("_")[0][1:].isdigit()}

_DUR = "sum(end_s - start_s)"
ORACLE_SQL = {
    "i1_normalize": sql("ann", "SELECT kind AS participant_id, count(*) AS n, round(sum(end_s - 5.0 - start_s), 6) AS seconds FROM ann WHERE kind <> 'error' AND end_s - CAST(5 AS DOUBLE) > start_s GROUP BY 1"),
    "i2_merge": sql("speech", """SELECT recording_id, participant_id, round(min(start_s), 6) AS start_s, round(max(end_s), 6) AS end_s FROM (
      SELECT *, sum(CASE WHEN reach IS NULL OR start_s > reach + 2 THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, participant_id ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, max(end_s) OVER (PARTITION BY recording_id, participant_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM speech))
      GROUP BY recording_id, participant_id, g"""),
    "i3_dilate": sql("speech", """SELECT recording_id, participant_id, round(min(a), 6) AS start_s, round(max(b), 6) AS end_s FROM (
      SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, participant_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, max(b) OVER (PARTITION BY recording_id, participant_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM (SELECT recording_id, participant_id, start_s - 3 AS a, end_s + 3 AS b FROM speech)))
      GROUP BY recording_id, participant_id, g"""),
    "i4_clip": sql("speech", "SELECT recording_id, round(greatest(start_s, 600), 6) AS start_s, round(least(end_s, 2400), 6) AS end_s, annotation_id FROM speech WHERE least(end_s, 2400) > greatest(start_s, 600)"),
    "i5_total_duration": sql("runs", f"SELECT recording_id, participant_id, round({_DUR}, 6) AS duration_s FROM runs GROUP BY 1, 2"),
    "i6_overlap": sql("speech runs", """SELECT recording_id, annotation_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, round(o, 6) AS overlap_s, round(least(1, o / (end_s - start_s)), 6) AS overlap_ratio
      FROM (SELECT s.recording_id, s.annotation_id, s.start_s, s.end_s, coalesce(sum(CASE WHEN r.start_s IS NOT NULL THEN least(s.end_s, r.end_s) - greatest(s.start_s, r.start_s) END), 0) AS o
        FROM speech s LEFT JOIN runs r ON r.recording_id = s.recording_id AND r.participant_id = 'purchase' AND r.start_s < s.end_s AND r.end_s > s.start_s GROUP BY ALL)"""),
    "i7_subtract": sql("runs", """, t AS (SELECT recording_id, start_s AS t FROM runs WHERE participant_id IN ('click', 'purchase') UNION SELECT recording_id, end_s FROM runs WHERE participant_id IN ('click', 'purchase')),
      p AS (SELECT * FROM (SELECT recording_id, t AS start_s, lead(t) OVER (PARTITION BY recording_id ORDER BY t) AS end_s FROM t) WHERE end_s IS NOT NULL),
      k AS (SELECT p.* FROM p WHERE EXISTS (FROM runs r WHERE r.recording_id = p.recording_id AND r.participant_id = 'click' AND r.start_s < p.end_s AND r.end_s > p.start_s)
        AND NOT EXISTS (FROM runs r WHERE r.recording_id = p.recording_id AND r.participant_id = 'purchase' AND r.start_s < p.end_s AND r.end_s > p.start_s))
      SELECT recording_id, round(min(start_s), 6) AS start_s, round(max(end_s), 6) AS end_s FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY start_s ROWS UNBOUNDED PRECEDING) AS g FROM (
          SELECT *, CASE WHEN lag(end_s) OVER (PARTITION BY recording_id ORDER BY start_s) = start_s THEN 0 ELSE 1 END AS fresh FROM k)) GROUP BY recording_id, g"""),
    "i8_nearest_offsets": sql("ann speech", """SELECT s.recording_id, s.annotation_id, round(min(abs(s.start_s - r.start_s)), 6) AS start_distance_s, round(min(abs(s.end_s - r.end_s)), 6) AS end_distance_s
      FROM (SELECT recording_id, annotation_id, start_s, end_s FROM ann WHERE kind = 'view') s LEFT JOIN speech r ON r.recording_id = s.recording_id AND r.participant_id = 'purchase' GROUP BY 1, 2"""),
    "i9_pieces": sql("speech", """SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY t) - 1 AS ordinal, round(t, 6) AS start_s, round(u, 6) AS end_s FROM (
      SELECT recording_id, t, lead(t) OVER (PARTITION BY recording_id ORDER BY t) AS u FROM (SELECT recording_id, start_s AS t FROM speech UNION SELECT recording_id, end_s FROM speech)) WHERE u IS NOT NULL"""),
    "v1_timed_intervals": sql("speech", "SELECT recording_id, participant_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, annotation_id FROM speech"),
    "v6_native_timeline": sql("native", "SELECT recording_id, native_index, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, state, annotation_ids FROM native"),
    "v7_state_durations": sql("native", """SELECT recording_id, round(sum(d), 6) AS total_s,
      round(coalesce(sum(d) FILTER (WHERE state = 'SPEAKING'), 0), 6) AS speaking_s, count(*) FILTER (WHERE state = 'SPEAKING') AS speaking_rows,
      round(coalesce(sum(d) FILTER (WHERE state = 'SILENT'), 0), 6) AS silent_s, count(*) FILTER (WHERE state = 'SILENT') AS silent_rows,
      round(coalesce(sum(d) FILTER (WHERE state = 'UNKNOWN'), 0), 6) AS unknown_s, count(*) FILTER (WHERE state = 'UNKNOWN') AS unknown_rows,
      count(*) FILTER (WHERE state = 'SILENT' AND d < CAST(0.1 AS DOUBLE)) AS short_silences,
      round(coalesce(sum(d) FILTER (WHERE state = 'SPEAKING'), 0) / sum(d), 6) AS speaking_share, round(coalesce(sum(d) FILTER (WHERE state = 'SILENT'), 0) / sum(d), 6) AS silent_share,
      round(coalesce(sum(d) FILTER (WHERE state = 'UNKNOWN'), 0) / sum(d), 6) AS unknown_share
      FROM (SELECT *, end_s - start_s AS d FROM native) GROUP BY recording_id"""),
    "v8_unknown_reasons": sql("native", "SELECT string_split(id, '#')[1] AS reason, count(*) AS n FROM (SELECT unnest(string_split(annotation_ids, '|')) AS id FROM native WHERE state = 'UNKNOWN') GROUP BY 1"),
    "v9_control_timeline": sql("control", "SELECT recording_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, state, annotation_ids, first_native_index, last_native_index, bridged_gaps, round(bridged_s, 6) AS bridged_s FROM control"),
    "v10_bridged_gaps": sql("flagged", "SELECT recording_id, native_index, round(start_s, 6) AS gap_start_s, round(end_s, 6) AS gap_end_s, round(end_s - start_s, 6) AS gap_s FROM flagged WHERE bridged"),
    "v11_resolved_transitions": sql("native_bounds native_changes", "SELECT recording_id, count(c.after) FILTER (WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN') AS transitions FROM native_bounds LEFT JOIN native_changes c USING (recording_id) GROUP BY 1"),
    "v12_control_summary": sql("native control flagged native_changes control_changes", """SELECT n.recording_id, n.r AS native_rows, round(n.s, 6) AS native_speaking_s, coalesce(nt.t, 0) AS native_transitions,
      c.r AS control_rows, round(c.s, 6) AS control_speaking_s, coalesce(ct.t, 0) AS control_transitions, coalesce(g.n, 0) AS gaps, round(coalesce(g.s, 0), 6) AS gaps_s,
      round(g.q[1], 6) AS gap_min_s, round(g.q[2], 6) AS gap_q05_s, round(g.q[3], 6) AS gap_median_s, round(g.q[4], 6) AS gap_q95_s, round(g.q[5], 6) AS gap_max_s
      FROM (SELECT recording_id, count(*) AS r, coalesce(sum(end_s - start_s) FILTER (WHERE state = 'SPEAKING'), 0) AS s FROM native GROUP BY 1) n
      JOIN (SELECT recording_id, count(*) AS r, coalesce(sum(end_s - start_s) FILTER (WHERE state = 'SPEAKING'), 0) AS s FROM control GROUP BY 1) c USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS t FROM native_changes WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN' GROUP BY 1) nt USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS t FROM control_changes WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN' GROUP BY 1) ct USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS n, sum(end_s - start_s) AS s, quantile_cont(end_s - start_s, [0, 0.05, 0.5, 0.95, 1]) AS q FROM flagged WHERE bridged GROUP BY 1) g USING (recording_id)"""),
    "v12_gap_histogram": sql("flagged", "SELECT CAST(least(greatest(floor((end_s - start_s) / CAST(1 AS DOUBLE)), 0), 9) AS BIGINT) AS bin, count(*) AS n FROM flagged WHERE bridged GROUP BY 1"),
    "v13_timeline_errors": sql("native", f"""SELECT recording_id, CASE WHEN bool_or(end_s <= start_s) THEN 'non-increasing interval' ELSE 'gap or overlap between intervals' END AS error
      FROM (SELECT *, lag(end_s) OVER (PARTITION BY recording_id ORDER BY start_s) AS was FROM (
        SELECT * REPLACE (CASE WHEN native_index = 1 AND CAST(substr(recording_id, 12, 2) AS INT) % 3 = 0 THEN start_s WHEN native_index = 1 AND CAST(substr(recording_id, 12, 2) AS INT) % 3 = 1 THEN end_s + 1 ELSE end_s END AS end_s) FROM native)) GROUP BY 1
      HAVING bool_or(end_s <= start_s) OR coalesce(bool_or(abs(start_s - was) > {EPS}), false)"""),
    "v15_grid_bounds": sql("control", f"""SELECT recording_id, first_index, greatest(0, last - first_index + 1) AS slots,
      round(CASE WHEN last >= first_index THEN greatest(0, first_index * CAST(10 AS DOUBLE) - lo) ELSE 0 END, 6) AS head_s,
      round(CASE WHEN last >= first_index THEN greatest(0, hi - (last + 1) * CAST(10 AS DOUBLE)) ELSE hi - lo END, 6) AS tail_s
      FROM (SELECT recording_id, min(start_s) AS lo, max(end_s) AS hi, CAST(ceil((min(start_s) - {EPS}) / 10) AS BIGINT) AS first_index, CAST(floor((max(end_s) + {EPS}) / 10) - 1 AS BIGINT) AS last
        FROM control GROUP BY 1)"""),
    "v17_state_before_slot": sql("control_slots", "SELECT recording_id, decision_index, state_before FROM control_slots"),
    "v18_transitions": sql("control_changes", "SELECT recording_id, round(time_s, 6) AS time_s, before, after, before <> 'UNKNOWN' AND after <> 'UNKNOWN' AS resolved FROM control_changes"),
    "v21_action_grid": sql("control_grid", "SELECT recording_id, decision_index, decision_time_s, slot_end_s, state_before, action, action_valid, round(event_time_s, 6) AS event_time_s, round(tau_s, 6) AS tau_s, mask_reason FROM control_grid"),
    "v22_compound_slots": sql("native_changes native_bounds", f"""SELECT recording_id, decision_index, count(*) AS changes, string_agg(CASE WHEN after = 'SPEAKING' THEN 'ONSET' ELSE 'OFFSET' END, '>' ORDER BY time_s) AS pattern,
      max_by(after, time_s) AS state_after, round(min(time_s), 6) AS first_s FROM (SELECT *, CAST(floor((time_s + {EPS}) / 10) AS BIGINT) AS decision_index FROM native_changes) JOIN native_bounds USING (recording_id)
      WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN' AND decision_index >= first_index AND decision_index < first_index + slots GROUP BY 1, 2 HAVING count(*) > 1"""),
    "v23_sub_step_gaps": sql("native native_bounds", f"""SELECT recording_id, round(end_s - start_s, 6) AS gap_s, round(start_s, 6) AS offset_s, round(end_s, 6) AS onset_s, a AS offset_slot, b AS onset_slot, a <> b AS cross_slot,
      slots > 0 AND a >= first_index AND b <= first_index + slots - 1 AS within_grid
      FROM (SELECT *, CAST(floor((start_s + {EPS}) / 10) AS BIGINT) AS a, CAST(floor((end_s + {EPS}) / 10) AS BIGINT) AS b, lag(state) OVER w AS was, lead(state) OVER w AS nxt FROM native WINDOW w AS (PARTITION BY recording_id ORDER BY start_s))
      JOIN native_bounds USING (recording_id) WHERE state = 'SILENT' AND was = 'SPEAKING' AND nxt = 'SPEAKING' AND end_s - start_s < 10 - {EPS}"""),
    "v24_grid_summary": sql("control_grid", """SELECT recording_id, count(*) AS slots, count(*) FILTER (WHERE action_valid) AS valid_slots, min(decision_index) AS first_index, max(decision_index) AS last_index,
      count(*) FILTER (WHERE action = 'NO_EVENT') AS no_event, count(*) FILTER (WHERE action = 'ONSET') AS onset, count(*) FILTER (WHERE action = 'OFFSET') AS "offset",
      count(*) FILTER (WHERE state_before = 'SPEAKING') AS before_speaking, count(*) FILTER (WHERE state_before = 'SILENT') AS before_silent, count(*) FILTER (WHERE state_before = 'UNKNOWN') AS before_unknown,
      count(*) FILTER (WHERE mask_reason = 'recording_start') AS recording_start, count(*) FILTER (WHERE mask_reason = 'unknown_state') AS unknown_state,
      count(*) FILTER (WHERE mask_reason = 'unknown_within_slot') AS unknown_within_slot, count(*) FILTER (WHERE mask_reason = 'compound_transition') AS compound_transition, CAST(0 AS BIGINT) AS invalid_timeline
      FROM control_grid GROUP BY 1"""),
    "v25_grid_statistics": sql("control_grid", """SELECT state_before, action, slots, round(valid_share, 6) AS valid_share, round(q[1], 6) AS tau_min_s, round(q[2], 6) AS tau_q05_s, round(q[3], 6) AS tau_median_s, round(q[4], 6) AS tau_q95_s, round(q[5], 6) AS tau_max_s
      FROM (SELECT state_before, coalesce(action, '-') AS action, count(*) AS slots, avg(CAST(action_valid AS DOUBLE)) AS valid_share, quantile_cont(tau_s, [0, 0.05, 0.5, 0.95, 1]) AS q FROM control_grid GROUP BY 1, 2)"""),
    "v26_layer_comparison": sql("native_grid control_grid", """SELECT layer, count(*) AS slots, CAST(count(*) FILTER (WHERE action_valid) AS BIGINT) AS valid_slots,
      count(*) FILTER (WHERE action = 'NO_EVENT') AS no_event, count(*) FILTER (WHERE action = 'ONSET') AS onset, count(*) FILTER (WHERE action = 'OFFSET') AS "offset",
      count(*) FILTER (WHERE state_before = 'SPEAKING') AS before_speaking, count(*) FILTER (WHERE state_before = 'SILENT') AS before_silent, count(*) FILTER (WHERE state_before = 'UNKNOWN') AS before_unknown,
      count(*) FILTER (WHERE mask_reason = 'recording_start') AS recording_start, count(*) FILTER (WHERE mask_reason = 'unknown_state') AS unknown_state,
      count(*) FILTER (WHERE mask_reason = 'unknown_within_slot') AS unknown_within_slot, count(*) FILTER (WHERE mask_reason = 'compound_transition') AS compound_transition
      FROM (SELECT 'native' AS layer, * FROM native_grid UNION ALL SELECT 'control', * FROM control_grid) GROUP BY 1"""),
    "m23_grid_violations": sql("control_grid", """, g AS (SELECT *, lag(decision_index) OVER (PARTITION BY recording_id ORDER BY decision_index) AS was FROM (
        SELECT decision_index, recording_id, state_before, action_valid, mask_reason, action, event_time_s, tau_s FROM control_grid
        UNION ALL SELECT k + 1000, recording_id, CASE WHEN k = 5 THEN 'SPEAKING' ELSE state_before END, CASE WHEN k = 0 THEN false WHEN k <= 5 THEN true ELSE action_valid END, CASE WHEN k = 2 THEN 'unknown_state' WHEN k > 5 THEN mask_reason END,
          CASE WHEN k IN (0, 3, 5) THEN 'ONSET' WHEN k = 1 THEN NULL WHEN k = 2 THEN 'NO_EVENT' ELSE action END, CASE WHEN k = 3 THEN NULL WHEN k = 5 THEN 1 ELSE event_time_s END, CASE k WHEN 4 THEN -1 WHEN 5 THEN 5 WHEN 6 THEN 10 ELSE tau_s END
          FROM (SELECT *, decision_index AS k FROM control_grid WHERE decision_index <= 6)))
      SELECT 'index_not_consecutive' AS rule, count(*) FILTER (WHERE decision_index <> was + 1) AS n FROM g
      UNION ALL SELECT 'masked_with_action', count(*) FILTER (WHERE NOT action_valid AND action IS NOT NULL) FROM g
      UNION ALL SELECT 'valid_without_action', count(*) FILTER (WHERE action_valid AND action IS NULL) FROM g
      UNION ALL SELECT 'valid_with_reason', count(*) FILTER (WHERE action_valid AND mask_reason IS NOT NULL) FROM g
      UNION ALL SELECT 'event_without_time', count(*) FILTER (WHERE action IN ('ONSET', 'OFFSET') AND event_time_s IS NULL) FROM g
      UNION ALL SELECT 'tau_outside_slot', count(*) FILTER (WHERE tau_s < 0 OR tau_s >= 10) FROM g
      UNION ALL SELECT 'onset_while_speaking', count(*) FILTER (WHERE action = 'ONSET' AND state_before = 'SPEAKING' AND tau_s > 1e-9) FROM g"""),
}


def _whole(layer: str) -> str:
    """The SQL of `timeline_summary` for a layer."""
    inside = "s >= first_index AND s < first_index + slots"
    return f"""SELECT b.recording_id, round(CASE WHEN b.slots > 0 THEN greatest(0, b.first_index * CAST(10 AS DOUBLE) - b.lo) ELSE 0 END, 6) AS leading_dropped_s, round(CASE WHEN b.slots > 0 THEN greatest(0, b.hi - (b.first_index + b.slots) * CAST(10 AS DOUBLE)) ELSE b.hi - b.lo END, 6) AS trailing_dropped_s,
      g.first_index, g.last_index, coalesce(g.slots, 0) AS slots, coalesce(g.valid_slots, 0) AS valid_slots, coalesce(g.slots - g.valid_slots, 0) AS masked_slots, coalesce(g.no_event, 0) AS no_event, coalesce(g.onset, 0) AS onset, coalesce(g.off, 0) AS "offset", coalesce(g.onset + g.off, 0) AS represented_transitions,
      coalesce(g.before_speaking, 0) AS before_speaking, coalesce(g.before_silent, 0) AS before_silent, coalesce(g.before_unknown, 0) AS before_unknown, coalesce(g.recording_start, 0) AS recording_start, coalesce(g.unknown_state, 0) AS unknown_state, coalesce(g.unknown_within_slot, 0) AS unknown_within_slot,
      coalesce(g.compound_transition, 0) AS compound_transition, CAST(0 AS BIGINT) AS invalid_timeline, coalesce(m.n, 0) AS source_transitions, coalesce(m.outside, 0) AS transitions_outside_grid, coalesce(c.slots, 0) AS compound_slots, CAST(coalesce(c.changes, 0) AS BIGINT) AS compound_transitions,
      coalesce(p.n, 0) AS short_gaps, coalesce(p.crossing, 0) AS short_gaps_across_slots, coalesce(p.n - p.crossing, 0) AS short_gaps_within_a_slot, coalesce(m.n, 0) - coalesce(g.onset + g.off, 0) - coalesce(m.outside, 0) AS masked_transitions, CAST(NULL AS VARCHAR) AS invalid_timeline_reason
      FROM {layer}_bounds b LEFT JOIN (SELECT recording_id, min(decision_index) AS first_index, max(decision_index) AS last_index, count(*) AS slots, count(*) FILTER (WHERE action_valid) AS valid_slots, count(*) FILTER (WHERE action = 'NO_EVENT') AS no_event, count(*) FILTER (WHERE action = 'ONSET') AS onset, count(*) FILTER (WHERE action = 'OFFSET') AS off,
          count(*) FILTER (WHERE state_before = 'SPEAKING') AS before_speaking, count(*) FILTER (WHERE state_before = 'SILENT') AS before_silent, count(*) FILTER (WHERE state_before = 'UNKNOWN') AS before_unknown, count(*) FILTER (WHERE mask_reason = 'recording_start') AS recording_start, count(*) FILTER (WHERE mask_reason = 'unknown_state') AS unknown_state,
          count(*) FILTER (WHERE mask_reason = 'unknown_within_slot') AS unknown_within_slot, count(*) FILTER (WHERE mask_reason = 'compound_transition') AS compound_transition FROM {layer}_grid GROUP BY 1) g USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS n, count(*) FILTER (WHERE NOT ({inside})) AS outside FROM {layer}_at GROUP BY 1) m USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS slots, sum(n) AS changes FROM (SELECT recording_id, s, count(*) AS n FROM {layer}_at WHERE {inside} GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1) c USING (recording_id)
      LEFT JOIN (SELECT recording_id, count(*) AS n, count(*) FILTER (WHERE floor((start_s + {EPS}) / 10) <> floor((end_s + {EPS}) / 10)) AS crossing FROM (SELECT *, lag(state) OVER w AS was, lead(state) OVER w AS nxt FROM {layer} WINDOW w AS (PARTITION BY recording_id ORDER BY start_s))
        WHERE state = 'SILENT' AND was = 'SPEAKING' AND nxt = 'SPEAKING' AND end_s - start_s < 10 - {EPS} GROUP BY 1) p USING (recording_id)"""


for _layer in ("native", "control"):
    part(f"{_layer}_at", f"{_layer}_changes {_layer}_bounds", f"SELECT c.recording_id, time_s, after, CAST(floor((time_s + {EPS}) / 10) AS BIGINT) AS s, first_index, slots FROM {_layer}_changes c JOIN {_layer}_bounds b USING (recording_id) WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN'")
    part(f"{_layer}_whole", f"{_layer}_at {_layer}_grid {_layer}", _whole(_layer))
ORACLE_SQL["v24_timeline_summary"] = sql("native_whole", "SELECT * FROM native_whole")
ORACLE_SQL["v25_compound_patterns"] = sql("native_at", "SELECT pattern, n AS changes, count(*) AS slots FROM (SELECT string_agg(CASE WHEN after = 'SPEAKING' THEN 'ONSET' ELSE 'OFFSET' END, '>' ORDER BY time_s) AS pattern, CAST(count(*) AS INT) AS n FROM native_at WHERE s >= first_index AND s < first_index + slots GROUP BY recording_id, s HAVING count(*) > 1) GROUP BY 1, 2")
_SUMS = ("compound_slots", "compound_transitions", "source_transitions", "represented_transitions", "masked_transitions", "valid_slots")
ORACLE_SQL["v26_layer_deltas"] = sql(
    "native_whole control_whole",
    " UNION ALL ".join(
        f"SELECT '{n}' AS statistic, CAST((SELECT {e} FROM native_whole) AS BIGINT) AS native, CAST((SELECT {e} FROM control_whole) AS BIGINT) AS control, CAST((SELECT {e} FROM control_whole) - (SELECT {e} FROM native_whole) AS BIGINT) AS delta"
        for n, e in [*((c_, f"sum({c_})") for c_ in _SUMS), ("recordings_with_compound_slot", "count(*) FILTER (WHERE compound_slots > 0)")]
    ),
)
