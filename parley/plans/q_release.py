"""Queries on media tables, nested releases, social facts and packet events in context."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import media as md
from parley.operators import packets as pk
from parley.operators import structure as st
from parley.plans.oracle import EPS, part, sql
from parley.plans.q_media import RATE, REFERENCE, THRESHOLD, _series, _steps, packets
from parley.plans.q_state import rounded
from parley.sources import canonical as c


def _files(spark, sf_dir):
    pages = c.table(spark, sf_dir, "pages")
    ending = F.when(F.col("page_id") % 5 == 0, ".MP4").when(F.col("page_id") % 5 == 1, ".wav").when(F.col("page_id") % 5 == 2, ".csv").otherwise(".html")
    stem = F.floor(F.col("page_id") / 5).cast("string")
    folder = F.when(F.col("page_id") % 7 == 3, "__MACOSX/").otherwise("")
    return pages.select(F.concat(F.lit("Corpus"), (F.col("page_id") % 3).cast("string"), F.lit("/"), folder, stem, ending).alias("path"), F.octet_length("html").cast("long").alias("size"))


def s4_file_inventory(spark, sf_dir):
    return rounded(md.inventory(_files(spark, sf_dir)))


def s5_inventory_summary(spark, sf_dir):
    return rounded(md.inventory_summary(md.inventory(_files(spark, sf_dir))))


def _probes(spark, sf_dir):
    e = c.table(spark, sf_dir, "events")
    stream = F.struct
    video = stream(F.lit("video").alias("codec_type"), F.lit("h264").alias("codec_name"), F.lit("30000/1001").alias("avg_frame_rate"), F.lit("0.0").alias("start_time"), F.floor("value").cast("string").alias("duration"))
    audio = stream(F.lit("audio").alias("codec_type"), F.lit("aac").alias("codec_name"), F.lit("0/0").alias("avg_frame_rate"), (F.col("event_id") % 3 * 0.25).cast("string").alias("start_time"), F.format_string("%.2f", "value").alias("duration"))
    streams = F.when(F.col("event_id") % 11 == 0, F.array(video)).otherwise(F.array(audio, video))
    payload = F.when(F.col("event_id") % 13 == 0, "not json").otherwise(F.to_json(F.struct(streams.alias("streams"))))
    return md.probe_table(e.select(F.col("event_id").cast("string").alias("relative_path"), payload.alias("payload")))


def s6_probe_table(spark, sf_dir):
    return rounded(_probes(spark, sf_dir))


def a13_media_quality(spark, sf_dir):
    return rounded(md.quality_flags(_probes(spark, sf_dir)).groupBy("probe_ok", "has_video", "has_audio", "positive_durations", "passed").agg(F.count("*").alias("n")))


def a14_alignment(spark, sf_dir):
    return rounded(md.alignment_summary(md.alignment(_probes(spark, sf_dir)), "probe_ok"))


def a15_missing_files(spark, sf_dir):
    files = md.inventory(_files(spark, sf_dir)).select("relative_path")
    manifest = c.table(spark, sf_dir, "pages").select(F.concat(F.lit("Corpus0/"), F.col("page_id").cast("string"), F.lit(".wav")).alias("relative_path"))
    return manifest.join(files, "relative_path", "left_anti")


def m16_media_resolution(spark, sf_dir):
    docs = c.table(spark, sf_dir, "documents").select("doc_id")
    return rounded(md.resolve_media(docs, md.inventory(_files(spark, sf_dir)), "doc_id"))


def _release(spark, sf_dir):
    """Orders as clips of customers' videos, line items as segments of persons, as one JSON object per video."""
    lines = c.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity")
    segment = F.struct(F.col("l_partkey").cast("double").alias("start_s"), (F.col("l_partkey") + F.col("l_quantity")).alias("end_s"))
    persons = lines.groupBy("l_orderkey", "l_suppkey").agg(F.sort_array(F.collect_list(segment)).alias("segments"))
    clips = persons.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_suppkey").alias("person_id"), "segments")).alias("persons"))
    orders = c.table(spark, sf_dir, "orders").join(clips, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    videos = orders.groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("clip_id"), "persons")).alias("clips"))
    one = F.to_json(F.struct(F.array(F.struct(F.col("o_custkey").alias("video_id"), F.lit("train").alias("split"), "clips")).alias("videos")))
    schema = "videos ARRAY<STRUCT<video_id: BIGINT, split: STRING, clips: ARRAY<STRUCT<clip_id: BIGINT, persons: ARRAY<STRUCT<person_id: BIGINT, segments: ARRAY<STRUCT<start_s: DOUBLE, end_s: DOUBLE>>>>>>>>"
    return videos.select(F.from_json(one, schema).alias("r")).select("r.*")


def c1_flatten_release(spark, sf_dir):
    return rounded(md.release_to_tables(_release(spark, sf_dir))["segments"])


def _interpreted(spark, sf_dir):
    e = pk.episodes(_steps(spark, sf_dir), THRESHOLD)
    s = _series(spark, sf_dir).select("stream", F.col("step").alias("first_step"), (F.col("next_pts") / F.lit(RATE)).alias("time_s"))
    t = _series(spark, sf_dir).select("stream", F.col("step").alias("last_step"), (F.col("next_pts") / F.lit(RATE)).alias("end_s"))
    rows = e.join(s, ["stream", "first_step"]).join(t, ["stream", "last_step"]).withColumn("kind", F.when(F.col("dropout"), "dropout").otherwise("episode"))
    return md.interpret_events(rows, rate=RATE, reference=REFERENCE, skip_samples=1024, period_s=0.5, tolerance_packets=2.0)


def p11_interpreted_events(spark, sf_dir):
    return rounded(_interpreted(spark, sf_dir))


def p12_drift_flags(spark, sf_dir):
    return rounded(md.drift_flags(pk.drift_metrics(_series(spark, sf_dir), RATE, THRESHOLD), 30.0))


def p14_decoded_continuity(spark, sf_dir):
    frames = packets(spark, sf_dir).select("stream", "pts", F.coalesce("duration", F.lit(1024)).alias("nb_samples"))
    return rounded(md.decoded_continuity(frames))


def p19_dropout_intervals(spark, sf_dir):
    return rounded(md.dropout_intervals(_steps(spark, sf_dir), RATE, 0.02))


def _social(spark, sf_dir):
    """Every event as a segment: of whom and of which kind by its type and id, now and then of nobody, and now and then without saying at whom."""
    e = c.table(spark, sf_dir, "events")
    start = c.seconds_of_hour(F.col("ts"))
    person = F.when(F.col("event_id") % 11 == 0, "-1").otherwise(F.col("event_type"))
    kind = F.when(F.col("event_id") % 2 == 0, "talking").otherwise("looking")
    at_me = F.when(F.col("event_id") % 5 != 0, F.col("value") > 35)
    return e.select(c.recording().alias("recording_id"), person.alias("person"), F.nullif(person, F.lit("-1")).alias("participant_id"), kind.alias("kind"), start.alias("start_s"), (start + F.col("value")).alias("end_s"), at_me.alias("is_at_me"), F.col("event_id").alias("source_row"))


def _tracks(spark, sf_dir):
    e = c.table(spark, sf_dir, "events")
    start = c.seconds_of_hour(F.col("ts"))
    size = F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(F.col("value"))
    return e.select(c.recording().alias("recording_id"), F.col("event_type").alias("participant_id"), (F.col("event_id") % 5).cast("string").alias("track_id"), F.floor(start * 30).cast("long").alias("frame"), (F.floor(start * 30) / 30).alias("time_s"), (F.col("event_id") % 100).cast("double").alias("x"), (F.col("event_id") % 50).cast("double").alias("y"), size.alias("width"), (size / 2).alias("height"))


#: Seconds of the units of social labels, and units of a recording.
SOCIAL_S, SOCIAL_UNITS = 10.0, 360


def _social_units(spark, sf_dir):
    e = c.table(spark, sf_dir, "events")
    units = c.recordings(e).select("recording_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SOCIAL_UNITS - 1).cast("long"))).alias("unit"))
    people = st.order_participants(c.participants(e))
    around = st.participant_states(c.recordings(e), c.participants(e), c.speech(e), c.unknown(e))
    return md.social_units(units, people, _social(spark, sf_dir), _tracks(spark, sf_dir), around, c.unknown(e), SOCIAL_S)


def x9_social_units(spark, sf_dir):
    shown = [F.array_join(F.transform(n, lambda v: F.coalesce(v.cast("string"), F.lit("-"))), ",").alias(n) for n in ("looking_at_wearer", "talking_to_wearer", "face_tracked")]
    return rounded(_social_units(spark, sf_dir).select("recording_id", "unit", *shown))


def x10_anyone(spark, sf_dir):
    return rounded(_social_units(spark, sf_dir).select("recording_id", "unit", "anyone_looking_at_wearer", "anyone_talking_to_wearer"))


def x11_face_boxes(spark, sf_dir):
    return rounded(md.box_means(_tracks(spark, sf_dir), 600.0))


def x12_social_segments(spark, sf_dir):
    return rounded(md.social_segments(_social(spark, sf_dir), c.participants(c.table(spark, sf_dir, "events"))).drop("is_at_me"))


def x13_face_tracks(spark, sf_dir):
    return rounded(md.track_summary(_tracks(spark, sf_dir), 30.0))


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "scapxm" and k.split("_")[0][1:].isdigit()}

part("fil", "", """SELECT DISTINCT 'corpus' || page_id % 3 AS dataset, 'Corpus' || page_id % 3 || '/' || (page_id // 5) || CASE page_id % 5 WHEN 0 THEN '.MP4' WHEN 1 THEN '.wav' WHEN 2 THEN '.csv' ELSE '.html' END AS relative_path,
  CASE page_id % 5 WHEN 0 THEN 'video' WHEN 1 THEN 'audio' WHEN 2 THEN 'tabular' ELSE 'other' END AS file_type, first_value(strlen(html)) OVER () AS z, page_id, CAST(strlen(html) AS BIGINT) AS size FROM pages WHERE page_id % 7 <> 3""")
part("prb", "", """SELECT CAST(event_id AS VARCHAR) AS relative_path, event_id % 13 <> 0 AS ok, event_id % 13 <> 0 AND event_id % 11 <> 0 AS aud, round(value, 2) AS v, floor(value) AS vd, event_id % 3 * CAST(0.25 AS DOUBLE) AS sa FROM events""")
part("epi", "per", """SELECT stream, bool_or(persistent) AS dropout, min(step) AS a, max(step) AS b, max(abs(error)) AS ms, max(abs(x)) AS mx, sum(error) AS net FROM (
  SELECT *, sum(error) OVER (PARTITION BY stream, episode ORDER BY step ROWS UNBOUNDED PRECEDING) AS x FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY stream ORDER BY step ROWS UNBOUNDED PRECEDING) AS episode FROM (
      SELECT *, CASE WHEN lag(step) OVER w = step - 1 AND NOT persistent AND NOT lag(persistent) OVER w THEN 0 ELSE 1 END AS fresh FROM per WHERE error <> 0 WINDOW w AS (PARTITION BY stream ORDER BY step))))
  GROUP BY stream, episode HAVING bool_or(persistent) OR max(abs(error)) > 480 OR max(abs(x)) > 480""")
part("itp", "epi ser", """SELECT e.stream, s.next_pts / CAST(48000 AS DOUBLE) AS t, u.next_pts / CAST(48000 AS DOUBLE) AS te, dropout, net, greatest(1, round_even(s.next_pts / CAST(48000 AS DOUBLE) / CAST(0.5 AS DOUBLE), 0)) AS i
  FROM epi e JOIN ser s ON s.stream = e.stream AND s.step = e.a JOIN ser u ON u.stream = e.stream AND u.step = e.b""")
part("soc", "ann", "SELECT recording_id, CASE WHEN event_id % 11 = 0 THEN '-1' ELSE kind END AS person, CASE WHEN event_id % 2 = 0 THEN 'talking' ELSE 'looking' END AS kind, start_s, end_s, CASE WHEN event_id % 5 <> 0 THEN value > 35 END AS is_at_me, event_id AS source_row FROM ann")
part("trk", "ann", "SELECT recording_id, kind AS participant_id, CAST(event_id % 5 AS VARCHAR) AS track_id, CAST(floor(start_s * 30) AS BIGINT) AS frame, floor(start_s * 30) / 30 AS time_s, CAST(event_id % 100 AS DOUBLE) AS x, CAST(event_id % 50 AS DOUBLE) AS y, CASE WHEN event_id % 97 = 0 THEN 0 ELSE value END AS width FROM ann")
part("mrk", "soc trk pstates who", f"""SELECT DISTINCT recording_id, participant_index, mark, unit FROM (
  SELECT recording_id, participant_index, mark, unit, sum(greatest(0, least(end_s, (unit + 1) * CAST(10 AS DOUBLE)) - greatest(start_s, unit * CAST(10 AS DOUBLE)))) AS s FROM (
    SELECT *, unnest(range(CAST(floor(start_s / 10) AS BIGINT), greatest(CAST(floor(start_s / 10) AS BIGINT) + 1, CAST(ceil(end_s / 10) AS BIGINT)))) AS unit FROM (
      SELECT recording_id, participant_index, kind || '_any' AS mark, start_s, end_s FROM soc s JOIN who w USING (recording_id) WHERE w.participant_id = s.person
      UNION ALL SELECT recording_id, participant_index, kind || CASE WHEN is_at_me THEN '_yes' ELSE '_no' END, start_s, end_s FROM soc s JOIN who w USING (recording_id) WHERE w.participant_id = s.person AND is_at_me IS NOT NULL
      UNION ALL SELECT recording_id, participant_index, 'speaking', start_s, end_s FROM pstates WHERE state = 'SPEAKING') WHERE end_s > start_s) GROUP BY 1, 2, 3, 4) WHERE s > {EPS}
  UNION SELECT recording_id, participant_index, 'tracked', CAST(floor((time_s + {EPS}) / 10) AS BIGINT) FROM trk t JOIN who w USING (recording_id, participant_id)""")
part("hid", "unk", f"""SELECT recording_id, unit FROM (SELECT recording_id, unit, sum(least(end_s, (unit + 1) * CAST(10 AS DOUBLE)) - greatest(start_s, unit * CAST(10 AS DOUBLE))) AS s FROM (
  SELECT *, unnest(range(CAST(floor(start_s / 10) AS BIGINT), CAST(ceil(end_s / 10) AS BIGINT))) AS unit FROM unk) GROUP BY 1, 2) WHERE s > {EPS}""")
part("lat", "recs who mrk hid", """SELECT recording_id, unit, participant_index, h.unit IS NULL AS shown, coalesce(bool_or(mark = 'tracked'), false) AS tracked, coalesce(bool_or(mark = 'speaking'), false) AS speaking,
  coalesce(bool_or(mark = 'looking_yes'), false) AS ly, coalesce(bool_or(mark = 'looking_no'), false) AS ln, coalesce(bool_or(mark = 'looking_any'), false) AS la,
  coalesce(bool_or(mark = 'talking_yes'), false) AS ty, coalesce(bool_or(mark = 'talking_no'), false) AS tn, coalesce(bool_or(mark = 'talking_any'), false) AS ta
  FROM (SELECT recording_id, participant_index, unnest(range(0, 360)) AS unit FROM who) u LEFT JOIN mrk m USING (recording_id, unit, participant_index) LEFT JOIN hid h USING (recording_id, unit) GROUP BY 1, 2, 3, 4""")

_ALIGN = "CASE WHEN aud THEN sa + v - vd END"
ORACLE_SQL = {
    "s4_file_inventory": sql("fil", "SELECT dataset, relative_path, file_type, any_value(size) AS size FROM fil GROUP BY 1, 2, 3 HAVING count(*) = 1 UNION ALL SELECT dataset, relative_path, file_type, min(size) FROM fil GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    "s6_probe_table": sql("prb", "SELECT relative_path, ok AS probe_ok, CAST(ok AS BIGINT) AS video_streams, CASE WHEN ok THEN CAST(0 AS DOUBLE) END AS video_start_s, CASE WHEN ok THEN vd END AS video_duration_s, CAST(aud AS BIGINT) AS audio_streams, CASE WHEN aud THEN sa END AS audio_start_s, CASE WHEN aud THEN v END AS audio_duration_s, CASE WHEN ok THEN round(CAST(30000 AS DOUBLE) / 1001, 6) END AS frame_rate FROM prb"),
    "a13_media_quality": sql("prb", "SELECT ok AS probe_ok, ok AS has_video, aud AS has_audio, aud AND v > 0 AND vd > 0 AS positive_durations, aud AND v > 0 AND vd > 0 AS passed, count(*) AS n FROM prb GROUP BY 1, 2, 3, 4, 5"),
    "a14_alignment": sql("prb", f"SELECT ok AS probe_ok, count(*) FILTER (WHERE aud AND sa = 0) AS zero_offsets, count({_ALIGN}) AS n, round(min({_ALIGN}), 6) AS least, round(median({_ALIGN}), 6) AS median, round(max({_ALIGN}), 6) AS most FROM prb GROUP BY 1"),
    "a15_missing_files": sql("fil", "SELECT 'Corpus0/' || page_id || '.wav' AS relative_path FROM pages WHERE 'Corpus0/' || page_id || '.wav' NOT IN (SELECT relative_path FROM fil)"),
    "m16_media_resolution": sql("fil", """, s AS (SELECT regexp_extract(relative_path, '([^/]*?)\\.[^./]*$', 1) AS stem, file_type, count(*) AS n, min(relative_path) AS p FROM (SELECT DISTINCT dataset, relative_path, file_type FROM fil) WHERE file_type IN ('video', 'audio') GROUP BY 1, 2)
      SELECT doc_id, CASE WHEN NOT clash THEN vp END AS video_path, CASE WHEN NOT clash THEN ap END AS audio_path, clash AS ambiguous FROM (
        SELECT d.doc_id, v.p AS vp, a.p AS ap, coalesce(v.n, 0) > 1 OR coalesce(a.n, 0) > 1 AS clash FROM documents d LEFT JOIN s v ON v.stem = CAST(d.doc_id AS VARCHAR) AND v.file_type = 'video' LEFT JOIN s a ON a.stem = CAST(d.doc_id AS VARCHAR) AND a.file_type = 'audio')"""),
    "c1_flatten_release": "SELECT l_orderkey AS clip_id, l_suppkey AS person_id, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_partkey, l_quantity) - 1 AS place, CAST(l_partkey AS DOUBLE) AS start_s, l_partkey + l_quantity AS end_s FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "p11_interpreted_events": sql("itp", """SELECT stream, round(t, 6) AS time_s, CASE WHEN dropout THEN 'dropout' ELSE 'episode' END AS kind,
      CASE WHEN t BETWEEN 0 AND CAST(3072 AS DOUBLE) / 48000 AND te <= CAST(3072 AS DOUBLE) / 48000 THEN 'codec_boundary' WHEN NOT dropout AND abs(t - i * 0.5) <= CAST(2048 AS DOUBLE) / 48000 THEN 'stitch' WHEN dropout THEN 'dropout' WHEN abs(net) <= 480 THEN 'compensated' ELSE 'variation' END AS category,
      CAST(i AS BIGINT) AS boundary_index, round(abs(t - i * 0.5), 6) AS distance_s, abs(t - i * 0.5) <= CAST(2048 AS DOUBLE) / 48000 AS near_boundary, t BETWEEN 0 AND CAST(3072 AS DOUBLE) / 48000 AS early FROM itp"""),
    "p12_drift_flags": sql("met", "SELECT stream, round(d, 6) AS abs_final_drift_ms, d > 1 AS over_1_ms, d > CAST(500 AS DOUBLE) / 30 AS over_half_frame, d > 100 AS over_100_ms, d > 500 AS over_500_ms FROM (SELECT stream, abs(1000 * final_drift / 48000) AS d FROM met)"),
    "p14_decoded_continuity": sql("pkt", "SELECT stream, count(*) AS frames, count(*) FILTER (WHERE g <> 0) AS breaks, coalesce(max(abs(g)), 0) AS max_gap, min(pts) AS first_pts, max(pts) + 1024 AS end_pts, CASE WHEN count(*) < 2 THEN 'insufficient_data' WHEN count(*) FILTER (WHERE g <> 0) > 0 THEN 'gap_or_overlap' ELSE 'continuous' END AS verdict FROM (SELECT *, lead(pts) OVER (PARTITION BY stream ORDER BY pts) - pts - 1024 AS g FROM pkt) GROUP BY 1"),
    "p19_dropout_intervals": sql("per", "SELECT stream, round(next_pts / CAST(48000 AS DOUBLE) - error / 48000, 6) AS start_s, round(next_pts / CAST(48000 AS DOUBLE), 6) AS end_s FROM per WHERE persistent AND error / 48000 >= CAST(0.02 AS DOUBLE)"),
    "x9_social_units": sql("lat", """SELECT recording_id, unit, string_agg(CASE WHEN shown AND (tracked OR ly OR ln) THEN CAST(ly AS VARCHAR) ELSE '-' END, ',' ORDER BY participant_index) AS looking_at_wearer,
      string_agg(CASE WHEN shown AND (ty OR tn) THEN CAST(ty AS VARCHAR) ELSE '-' END, ',' ORDER BY participant_index) AS talking_to_wearer, string_agg(CASE WHEN shown THEN CAST(tracked AS VARCHAR) ELSE '-' END, ',' ORDER BY participant_index) AS face_tracked
      FROM lat GROUP BY 1, 2"""),
    "x10_anyone": sql("lat", """SELECT recording_id, unit, CASE WHEN NOT bool_and(shown) THEN NULL WHEN bool_or(ly) THEN true WHEN bool_or(la OR tracked) AND NOT bool_or((la OR tracked) AND NOT (tracked OR ly OR ln)) THEN false END AS anyone_looking_at_wearer,
      CASE WHEN NOT bool_and(shown) THEN NULL WHEN bool_or(ty) THEN true WHEN bool_or(ta OR speaking) AND NOT bool_or((ta OR speaking) AND NOT (ty OR tn)) THEN false END AS anyone_talking_to_wearer FROM lat GROUP BY 1, 2"""),
    "x11_face_boxes": sql("trk", f"SELECT recording_id, participant_id, CAST(floor((time_s + {EPS}) / 600) AS BIGINT) AS decision_index, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(width), 6) AS width, round(avg(width / 2), 6) AS height, count(*) AS boxes FROM trk GROUP BY 1, 2, 3"),
    "x12_social_segments": sql("soc", "SELECT recording_id, CASE WHEN person IN ('click', 'purchase', 'signup', 'view') THEN person END AS participant_id, person, kind, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, source_row, row_number() OVER (PARTITION BY recording_id ORDER BY start_s, kind, person, source_row) - 1 AS segment_id, person IN ('click', 'purchase', 'signup', 'view') AS resolved FROM soc"),
    "x13_face_tracks": sql("trk", "SELECT recording_id, participant_id, track_id, min(frame) AS first_frame, max(frame) AS last_frame, count(*) AS boxes, round(min(time_s), 6) AS start_s, round(max(time_s) + CAST(1 AS DOUBLE) / 30, 6) AS end_s FROM trk GROUP BY 1, 2, 3"),
}
ORACLE_SQL["s5_inventory_summary"] = sql("fil", "SELECT dataset, file_type, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM (SELECT dataset, relative_path, file_type, min(size) AS size FROM fil GROUP BY 1, 2, 3) GROUP BY 1, 2")
