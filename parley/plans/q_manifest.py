"""Queries on media behind recordings: coverage, dropouts, manifests, and agreement of the label layer with the native one."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import grid, state
from parley.operators import manifest as mf
from parley.operators import media as md
from parley.plans.oracle import PARTS, part, sql
from parley.plans.q_media import RATE, _steps
from parley.plans.q_state import STEP, control, native, rounded
from parley.plans.q_structure import states
from parley.sources import canonical as c


def _probes(spark, sf_dir):
    """A probed file for each user, but for some; audio starts late or ends early in several."""
    users = c.table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()
    u = F.col("u")
    return users.select(
        F.concat(F.lit("Events/240p/"), F.when(u % 13 == 5, "lost-").otherwise(""), u.cast("string"), F.lit(".MP4")).alias("relative_path"),
        (u % 11 != 0).alias("probe_ok"),
        F.when(u % 17 != 0, (u % 5) * F.lit(0.25)).alias("audio_start_s"),
        (F.lit(3600.0) - (u % 4) * F.lit(10.0)).alias("audio_duration_s"),
    )


def _recordings(spark, sf_dir):
    """Recordings with the file of the least user in them, at an offset."""
    e = c.table(spark, sf_dir, "events")
    first = e.groupBy(c.recording().alias("recording_id")).agg(F.min("user_id").alias("u"))
    linked = first.select("recording_id", F.col("u").cast("string").alias("media_key"), mf.frame_offset(F.col("u") % 3 * 15 + 90, F.lit(90)).alias("media_offset_s"))
    return c.recordings(e).join(linked, "recording_id")


def _dropouts(spark, sf_dir):
    """Dropouts of the users' packets; 40 seconds of every second of packet time, so that they reach into the recordings."""
    rows = md.dropout_intervals(_steps(spark, sf_dir), RATE, 0.02)
    return rows.select(F.col("stream").cast("string").alias("media_key"), (F.col("start_s") * 40.0).alias("start_s"), (F.col("end_s") * 40.0).alias("end_s"))


def v2_media_coverage(spark, sf_dir):
    return rounded(mf.media_coverage(_probes(spark, sf_dir)))


def v3_uncovered_media(spark, sf_dir):
    return rounded(mf.uncovered(_recordings(spark, sf_dir), mf.media_coverage(_probes(spark, sf_dir))).drop("participant_id"))


def v4_dropout_unknown(spark, sf_dir):
    return rounded(mf.dropped_out(_recordings(spark, sf_dir), _dropouts(spark, sf_dir)).drop("participant_id"))


def v6_timeline_with_media(spark, sf_dir):
    """The native timeline where time without audio is UNKNOWN as well."""
    e, recs = c.table(spark, sf_dir, "events"), _recordings(spark, sf_dir)
    hidden = c.unknown(e).unionByName(mf.uncovered(recs, mf.media_coverage(_probes(spark, sf_dir)))).unionByName(mf.dropped_out(recs, _dropouts(spark, sf_dir)))
    timeline = state.native_timeline(c.recordings(e), c.speech(e), hidden)
    return rounded(timeline.select("recording_id", "native_index", "start_s", "end_s", "state", "annotation_ids"))


def m17_frame_offset(spark, sf_dir):
    return rounded(_recordings(spark, sf_dir).select("recording_id", "media_key", "media_offset_s"))


def m18_corpus_path(spark, sf_dir):
    """Paths of pages as given, with every eleventh outside its corpus and every thirteenth right at the root."""
    p = F.col("page_id")
    path = F.when(p % 11 == 0, F.concat(F.lit("Elsewhere/"), p.cast("string"))).when(p % 13 == 0, p.cast("string")).otherwise(F.concat(F.lit("Pages/"), (p % 7).cast("string"), F.lit("/"), p.cast("string"), F.lit(".html")))
    return rounded(mf.corpus_path(c.table(spark, sf_dir, "pages").select(F.lit("pages").alias("dataset"), path.alias("relative_path"))))


def _manifest(spark, sf_dir):
    """Orders as recordings with media by their status, with faults set into some rows."""
    k = F.col("o_orderkey")
    name = F.when(k % 101 == 0, " ").when(k % 83 == 0, "1").otherwise(k.cast("string"))
    folder = F.when(k % 53 == 0, "../").when(k % 59 == 0, "C:/").otherwise("240p/")
    video = F.when(F.col("o_orderstatus") != "O", F.concat(folder, k.cast("string"), F.lit(".mp4")))
    audio = F.when((F.col("o_orderstatus") != "F") & (k % 7 != 0), F.concat(F.lit("wav/"), k.cast("string"), F.when(k % 61 == 0, "\\").otherwise(""), F.lit(".wav")))
    return c.table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("dataset"), name.alias("recording_id"), video.alias("video_path"), audio.alias("audio_path"), F.when(k % 89 != 0, k % 3 * F.lit(0.5)).alias("media_offset_s"), (video.isNotNull() & (k % 5 != 0)).alias("video_has_audio")
    )


def m19_manifest_violations(spark, sf_dir):
    known = c.table(spark, sf_dir, "orders").select(F.lit("orders").alias("dataset"), F.col("o_orderkey").cast("string").alias("recording_id"))
    return rounded(mf.manifest_violations(_manifest(spark, sf_dir), known))


def _coverage(spark, sf_dir):
    recs = _recordings(spark, sf_dir)
    files = _probes(spark, sf_dir).select("relative_path", F.lit("video").alias("file_type"), "probe_ok")
    resolved = md.resolve_media(recs, files, "media_key").filter("video_path IS NOT NULL").join(files.select(F.col("relative_path").alias("video_path"), F.col("probe_ok").alias("video_has_audio")), "video_path")
    reasons = recs.filter(F.col("media_key").cast("long") % 2 == 0).select("recording_id", F.lit("no_file").alias("reason"))
    return mf.manifest_coverage(resolved, recs, reasons, grid.action_grid(control(spark, sf_dir), STEP))


def m20_media_coverage(spark, sf_dir):
    return rounded(_coverage(spark, sf_dir)[0])


def m20_unresolved_reasons(spark, sf_dir):
    return rounded(_coverage(spark, sf_dir)[1])


def m22_layer_agreement(spark, sf_dir):
    """In every fifth hour the native timeline's first row ends a second early."""
    early = (F.col("native_index") == 0) & (F.substring("recording_id", 12, 2).cast("int") % 5 == 0)
    altered = native(spark, sf_dir).withColumn("end_s", F.when(early, F.col("end_s") - 1.0).otherwise(F.col("end_s")))
    return rounded(mf.layer_agreement(states(spark, sf_dir), altered).select("recording_id", "native_speaking_s", "native_unknown_s", "agrees"))


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "vm" and k.split("_")[0][1:].isdigit()}

part("mcov", "", """SELECT CASE WHEN u % 13 = 5 THEN 'lost-' ELSE '' END || u AS media_key, u % 11 <> 0 AND u % 17 <> 0 AS probe_ok, CASE WHEN u % 11 <> 0 AND u % 17 <> 0 THEN u % 5 * CAST(0.25 AS DOUBLE) END AS audio_start_s,
  CASE WHEN u % 11 <> 0 AND u % 17 <> 0 THEN u % 5 * CAST(0.25 AS DOUBLE) + (3600 - u % 4 * CAST(10 AS DOUBLE)) END AS audio_end_s FROM (SELECT DISTINCT user_id AS u FROM events)""")
part("mrec", "ann", "SELECT recording_id, CAST(u AS VARCHAR) AS media_key, u % 3 * CAST(15 AS DOUBLE) / 30 AS media_offset_s, u FROM (SELECT recording_id, min(user_id) AS u FROM ann JOIN (SELECT event_id AS i, user_id FROM events) ON i = event_id GROUP BY 1)")
part("munc", "mcov mrec", """SELECT * FROM (SELECT recording_id, CAST(0 AS DOUBLE) AS start_s, CAST(3600 AS DOUBLE) AS end_s, CASE WHEN probe_ok IS NULL THEN 'media_missing' ELSE 'media_unprobed' END AS annotation_id FROM mrec LEFT JOIN mcov USING (media_key) WHERE NOT coalesce(probe_ok, false)
  UNION ALL SELECT recording_id, 0, least(audio_start_s - media_offset_s, 3600), 'media_uncovered' FROM mrec JOIN mcov USING (media_key) WHERE probe_ok AND audio_start_s - media_offset_s > 0
  UNION ALL SELECT recording_id, greatest(audio_end_s - media_offset_s, 0), 3600, 'media_uncovered' FROM mrec JOIN mcov USING (media_key) WHERE probe_ok AND audio_end_s - media_offset_s < 3600) WHERE end_s > start_s""")
part("mdrop", "per mrec", """SELECT * FROM (SELECT recording_id, greatest(0, 40 * (next_pts - error) / CAST(48000 AS DOUBLE) - media_offset_s) AS start_s, least(3600, 40 * next_pts / CAST(48000 AS DOUBLE) - media_offset_s) AS end_s, 'media_audio_dropout' AS annotation_id
  FROM per JOIN mrec ON u = stream WHERE persistent AND error / CAST(48000 AS DOUBLE) >= CAST(0.02 AS DOUBLE)) WHERE end_s > start_s""")
part("guarded", "marks munc mdrop", "SELECT recording_id, round(start_s, 9) AS start_s, round(end_s, 9) AS end_s, annotation_id, bad FROM (SELECT * FROM marks UNION ALL SELECT *, true FROM munc UNION ALL SELECT *, true FROM mdrop)")
part("guarded_cut", "guarded recs", PARTS["cut"][1].replace("FROM marks", "FROM guarded"))
part("guarded_states", "guarded_cut guarded", PARTS["states"][1].replace("FROM cut c LEFT JOIN marks m", "FROM guarded_cut c LEFT JOIN guarded m"))
part("guarded_native", "guarded_states", PARTS["native"][1].replace("FROM states", "FROM guarded_states"))
part("mani", "", """SELECT CASE WHEN o_orderkey % 101 = 0 THEN ' ' WHEN o_orderkey % 83 = 0 THEN '1' ELSE CAST(o_orderkey AS VARCHAR) END AS recording_id, o_orderstatus <> 'O' AS v, o_orderstatus <> 'F' AND o_orderkey % 7 <> 0 AS a, o_orderkey AS k FROM orders""")
_TIMES = "round(start_s, 6) AS start_s, round(end_s, 6) AS end_s"
_RULES = {
    "null_recording_id": "trim(recording_id) = ''", "no_media": "NOT v AND NOT a", "ambiguous_mapping": "copies > 1", "video_path_not_portable": "v AND (k % 53 = 0 OR k % 59 = 0)",
    "audio_path_not_portable": "a AND k % 61 = 0", "null_offset": "k % 89 = 0", "unknown_recording": "recording_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)",
}
ORACLE_SQL = {
    "v2_media_coverage": sql("mcov", "SELECT * FROM mcov"),
    "v3_uncovered_media": sql("munc", f"SELECT recording_id, {_TIMES}, annotation_id FROM munc"),
    "v4_dropout_unknown": sql("mdrop", f"SELECT recording_id, {_TIMES}, annotation_id FROM mdrop"),
    "v6_timeline_with_media": sql("guarded_native", f"SELECT recording_id, native_index, {_TIMES}, state, annotation_ids FROM guarded_native"),
    "m17_frame_offset": sql("mrec", "SELECT recording_id, media_key, media_offset_s FROM mrec"),
    "m18_corpus_path": """SELECT 'pages' AS dataset, relative_path, CASE WHEN below THEN 'Pages' END AS directory, CASE WHEN below THEN substr(relative_path, 7) END AS path, below FROM (
      SELECT page_id % 11 <> 0 AND page_id % 13 <> 0 AS below, CASE WHEN page_id % 11 = 0 THEN 'Elsewhere/' || page_id WHEN page_id % 13 = 0 THEN CAST(page_id AS VARCHAR) ELSE 'Pages/' || page_id % 7 || '/' || page_id || '.html' END AS relative_path FROM pages)""",
    "m19_manifest_violations": sql("mani", ", m AS (SELECT *, count(*) OVER (PARTITION BY recording_id) AS copies FROM mani) " + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS rows, array_to_string(list_sort(list_distinct(list(recording_id)))[:5], ',') AS examples FROM m WHERE {bad} HAVING count(*) > 0" for rule, bad in _RULES.items())),
    "m20_media_coverage": sql("mrec mcov control_grid", """, r AS (SELECT recording_id, u % 11 <> 0 AS ok FROM mrec JOIN mcov USING (media_key)), g AS (SELECT recording_id, count(*) FILTER (WHERE action_valid) AS n FROM control_grid GROUP BY 1),
      m AS (SELECT recording_id, n FROM mrec ANTI JOIN r USING (recording_id) LEFT JOIN g USING (recording_id))
      SELECT (SELECT count(*) FROM r) AS in_manifest, (SELECT count(*) FROM r) AS video, 0 AS audio, (SELECT count(*) FROM r) AS video_only, 0 AS audio_only, 0 AS both, (SELECT count(*) FROM r WHERE ok) AS embedded_audio, (SELECT count(*) FROM r WHERE NOT ok) AS without_usable_audio,
        (SELECT count(*) FROM mrec) AS in_grid, (SELECT count(*) FROM m) AS unresolved, (SELECT count(*) FROM m WHERE n > 0) AS unresolved_with_valid_slots, CASE WHEN (SELECT count(*) FROM m WHERE n > 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS status"""),
    "m20_unresolved_reasons": sql("mrec mcov", "SELECT CASE WHEN u % 2 = 0 THEN 'no_file' ELSE 'not_returned_by_adapter' END AS reason, count(*) AS recordings FROM mrec ANTI JOIN mcov USING (media_key) GROUP BY 1"),
    "m22_layer_agreement": sql("native", """SELECT recording_id, round(coalesce(sum(d) FILTER (WHERE state = 'SPEAKING'), 0), 6) AS native_speaking_s, round(coalesce(sum(d) FILTER (WHERE state = 'UNKNOWN'), 0), 6) AS native_unknown_s,
      NOT bool_or(late AND state <> 'SILENT') AS agrees FROM (SELECT *, native_index = 0 AND CAST(substr(recording_id, 12, 2) AS INT) % 5 = 0 AS late, end_s - start_s - CASE WHEN native_index = 0 AND CAST(substr(recording_id, 12, 2) AS INT) % 5 = 0 THEN 1 ELSE 0 END AS d FROM native) GROUP BY 1"""),
}
