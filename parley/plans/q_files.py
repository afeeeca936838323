"""Queries on files in and out, scans that outlive failures, codec boundaries, decode cases and regimes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parley.operators import audit, grid, windows
from parley.operators import media as md
from parley.operators import packets as pk
from parley.operators import structure as st
from parley.plans import q_audit, q_structure
from parley.plans.oracle import part, sql
from parley.plans.q_media import RATE, REFERENCE, THRESHOLD, _series, _steps, packets
from parley.plans.q_release import _interpreted
from parley.plans.q_state import STEP, control, rounded
from parley.sources import canonical as c
from parley.sources import facts
from parley.sources import files as fl
from parley.sources import store
from parley.sources.shared import saved

_CSV = "o_orderkey BIGINT, o_comment STRING, o_totalprice DOUBLE, o_orderdate DATE"


def s1_csv_scan(spark, sf_dir):
    """Orders written as CSV, texts with quotes, commas and line ends among them, and read again."""
    path, k = fl.scratch(spark, "s1"), F.col("o_orderkey")
    text = F.when(k % 5 == 0, F.concat(F.lit('say "no", '), F.col("o_orderpriority"))).when(k % 7 == 0, F.concat(F.col("o_orderpriority"), F.lit("\nnext"))).when(k % 11 != 0, F.col("o_orderpriority"))
    rows = c.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("o_comment"), "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    rows.write.csv(path, header=True, quote='"', escape='"')
    return rounded(fl.csv_table(spark, path, _CSV).withColumn("o_orderdate", F.col("o_orderdate").cast("string")))


def s3_nested_json(spark, sf_dir):
    """A JSON document for each customer, of one video with their orders as clips."""
    path = fl.scratch(spark, "s3")
    clip = F.struct(F.col("o_orderkey").alias("clip_id"), F.col("o_totalprice").alias("price"))
    videos = c.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(clip).alias("clips"))
    videos.select(F.to_json(F.struct(F.array(F.struct(F.col("o_custkey").alias("video_id"), "clips")).alias("videos")))).write.text(path)
    read = fl.nested_json(spark, path, "videos ARRAY<STRUCT<video_id: BIGINT, clips: ARRAY<STRUCT<clip_id: BIGINT, price: DOUBLE>>>>", "videos", lines=True)
    return rounded(read.select("video_id", F.explode("clips").alias("c")).select("video_id", "c.*"))


def s4_listed_files(spark, sf_dir):
    """Pages written ten to a file, one folder each, and listed with the digests of the files' contents."""
    path = fl.scratch(spark, "s4")
    pages = c.table(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 10).alias("lot"), F.col("html").alias("value"))
    pages.repartition("lot").sortWithinPartitions("lot", "page_id").select("lot", "value").write.partitionBy("lot").text(path)
    return rounded(md.inventory(md.list_files(spark, path, checksum=True)).select("dataset", "file_type", "size", "sha256"))


def s7_parquet_sink(spark, sf_dir):
    path = fl.scratch(spark, "s7")
    fl.write_table(c.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), path)
    return rounded(spark.read.parquet(path))


def s8_label_store(spark, sf_dir):
    path = fl.scratch(spark, "s8")
    fl.write_labels(grid.action_grid(control(spark, sf_dir), STEP), path, ["recording_id", "decision_index"])
    return rounded(spark.read.parquet(path))


def s8_store_tables(spark, sf_dir):
    """The five tables of the speech labels in a store, as its reader sees them: rows, recordings and how many keys there are."""
    events_ = c.table(spark, sf_dir, "events")
    around = saved(st.joint(q_structure.states(spark, sf_dir)), "pieces")
    each = Window.partitionBy("recording_id", "segment_type").orderBy("start_s", "end_s", "participant_index", "initial", "entering")
    segments = st.segments_table(around, q_structure.RULES).withColumnRenamed("segment", "segment_type").withColumn("segment_id", F.row_number().over(each) - 1)
    tables = {
        "grid": grid.action_grid(control(spark, sf_dir), STEP),
        "events": st.events_table(around, q_structure.RULES).withColumnRenamed("event", "event_type"),
        "segments": segments,
        "participants": st.order_participants(c.participants(events_)),
        "recordings": c.recordings(events_),
    }
    root = fl.scratch(spark, "s8-store")
    store.write_extractor(tables, root, "speech", {"step_s": STEP})
    out = None
    for name in sorted(tables):
        rows = store.read_table(spark, root, "speech", name)
        one = rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.count_distinct("recording_id").alias("recordings"))
        out = one if out is None else out.unionByName(one)
    return rounded(out)


def s9_split_sink(spark, sf_dir):
    path, k = fl.scratch(spark, "s9"), F.col("o_custkey")
    split = F.when(k % 10 == 0, "test").when(k % 10 == 1, "validation").otherwise("train")
    fl.write_splits(c.table(spark, sf_dir, "orders").select("o_orderkey", split.alias("split")), path)
    return rounded(spark.read.parquet(path))


def c7_source_rows(spark, sf_dir):
    rows = c.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return rounded(windows.numbered(rows, "conv_id", "turn").withColumnRenamed("row_number", "source_row"))


def _reading(o_orderkey, o_clerk, **_):
    """The clerk's number over the last digit of the order: fails at zero, and on orders whose clerk is unreadable."""
    return {"number": int(o_clerk), "share": int(o_clerk) // (o_orderkey % 10)}


def a16_population_scan(spark, sf_dir):
    k = F.col("o_orderkey")
    items = c.table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 7 == 3, "none").otherwise(F.col("o_custkey").cast("string")).alias("o_clerk"))
    return rounded(audit.population_scan(items, _reading, "number BIGINT, share BIGINT"))


def a12_cross_source(spark, sf_dir):
    left, right = q_audit._sides(spark, sf_dir)
    return rounded(audit.cross_source(left, right, "k", ["k", "start_s"], 2.0, ["start_s", "end_s"], [1, 2]))


def g20_grid_by_recording(spark, sf_dir):
    rows = grid.action_grid(control(spark, sf_dir), STEP).select("recording_id", "decision_index", "decision_time_s")
    return rounded(grid.by_recording(rows))


def p10_codec_boundary(spark, sf_dir):
    i = F.col("packet_index")
    entry = F.struct(F.lit("Skip Samples").alias("side_data_type"), F.when(i == 0, 1024).otherwise(0).alias("skip_samples"), F.when(i > 0, i % 100).otherwise(0).cast("int").alias("discard_padding"))
    other = F.struct(F.lit("Strings Metadata").alias("side_data_type"), F.lit(7).alias("skip_samples"), F.lit(7).alias("discard_padding"))
    return rounded(pk.codec_boundary(packets(spark, sf_dir).withColumn("side_data_list", F.when(i == 0, F.array(entry)).when(i % 7 == 6, F.array(other, entry)))))


def _files_and_events(spark, sf_dir):
    s = _series(spark, sf_dir)
    lengths = s.groupBy("stream").agg((F.max("next_pts") / F.lit(RATE)).alias("duration_s"))
    regime = F.pmod("stream", F.lit(3)).alias("regime")
    files = pk.drift_metrics(s, RATE, THRESHOLD).join(lengths, "stream").select("*", regime, (F.col("stream") % 10 != 0).alias("probe_ok"))
    starts = s.select("stream", F.col("step").alias("first_step"), (F.col("next_pts") / F.lit(RATE)).alias("time_s"))
    sizes = pk.episodes(_steps(spark, sf_dir), THRESHOLD).join(starts, ["stream", "first_step"]).select("stream", "time_s", "max_step", (F.col("net") / F.lit(RATE)).alias("length_s"))
    return files, _interpreted(spark, sf_dir).select("stream", "time_s", "category", regime).join(sizes, ["stream", "time_s"])


def p16_decode_cases(spark, sf_dir):
    return rounded(pk.decode_cases(*_files_and_events(spark, sf_dir)))


def _regime(spark, sf_dir):
    """Files with their usual packet; every fourth stream has short ones."""
    shorter = packets(spark, sf_dir).withColumn("duration", F.col("duration") * F.when(F.col("stream") % 4 == 0, 0.75).otherwise(1.0))
    return _files_and_events(spark, sf_dir)[0].join(pk.duration_profile(shorter, REFERENCE, THRESHOLD).select("stream", "nominal"), "stream")


def p18_regime_profile(spark, sf_dir):
    return rounded(pk.regime_profile(_regime(spark, sf_dir), REFERENCE))


def p18_profile_windows(spark, sf_dir):
    return rounded(pk.profile_windows(_regime(spark, sf_dir)))


def _clip_facts(spark, sf_dir):
    """Line items as speech of their suppliers in orders; only odd lines' suppliers are listed, and some speech names nobody."""
    n, who = F.col("l_linenumber"), F.col("l_suppkey").cast("string")
    lines = c.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("recording_id"), F.when(n % 5 != 4, who).alias("participant_id"), n.alias("n"), who.alias("who"), "l_quantity", "l_partkey")
    recs = lines.groupBy("recording_id").agg(F.min("who").alias("wearer_id"))
    return recs, lines.filter("n % 2 = 1").select("recording_id", F.col("who").alias("participant_id")), lines


def x14_fact_participants(spark, sf_dir):
    return rounded(facts.participants(*_clip_facts(spark, sf_dir)))


def x14_fact_tokens(spark, sf_dir):
    recs, _, lines = _clip_facts(spark, sf_dir)
    start = F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity") * 1.0)
    rows = facts.named(lines).select("recording_id", "participant_id", F.col("l_partkey").cast("string").alias("text"), start.alias("start_s"), (F.col("n") * 5.0).alias("end_s"), F.col("n").alias("source_row"))
    strange = rows.filter("source_row = 1").withColumn("recording_id", -1 - F.col("recording_id"))  # tokens of recordings that aren't there
    return rounded(facts.tokens(rows.unionByName(strange), recs, "utterance"))


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "scagpx" and k.split("_")[0][1:].isdigit()}

part("fls", "met ser", "SELECT m.*, duration_s, stream % 3 AS regime, variations > 0 AND max_abs_step <= 480 AND max_abs_drift <= 480 AS jitter FROM met m JOIN (SELECT stream, max(next_pts) / CAST(48000 AS DOUBLE) AS duration_s FROM ser GROUP BY 1) USING (stream)")
part("evs", "epi ser", """SELECT e.stream, e.stream % 3 AS regime, t, ms, net, CASE WHEN t <= CAST(3072 AS DOUBLE) / 48000 AND te <= CAST(3072 AS DOUBLE) / 48000 THEN 'codec_boundary' WHEN NOT dropout AND abs(t - greatest(1, round_even(t / CAST(0.5 AS DOUBLE), 0)) * 0.5) <= CAST(2048 AS DOUBLE) / 48000 THEN 'stitch'
  WHEN dropout THEN 'dropout' WHEN abs(net) <= 480 THEN 'compensated' ELSE 'variation' END AS category FROM (SELECT e.*, s.next_pts / CAST(48000 AS DOUBLE) AS t, u.next_pts / CAST(48000 AS DOUBLE) AS te FROM epi e JOIN ser s ON s.stream = e.stream AND s.step = e.a JOIN ser u ON u.stream = e.stream AND u.step = e.b) e""")
part("rgm", "fls pkt", "SELECT f.*, CASE WHEN stream % 4 = 0 THEN CAST(768 AS DOUBLE) ELSE 1024 END AS nominal FROM fls f WHERE stream IN (SELECT stream FROM pkt WHERE duration IS NOT NULL)")


def _side(a: str, b: str, name: str, length: str) -> str:
    q = ", ".join(f"quantile_cont({length}, {x}) FILTER (WHERE NOT cov) AS {name}_uncovered_{n}_s" for x, n in ((0, "min"), (0.05, "q05"), (0.5, "median"), (0.95, "q95"), (1, "max")))
    return f"SELECT count(*) FILTER (WHERE cov) AS {name}_covered, count(*) FILTER (WHERE NOT cov) AS {name}_uncovered, {q} FROM (SELECT *, EXISTS (FROM {b} y WHERE y.k = x.k AND y.a < x.b + 2 AND y.b > x.a - 2 AND y.b > y.a) AS cov FROM {a} x)"


ORACLE_SQL = {
    "s1_csv_scan": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'say "no", ' || o_orderpriority WHEN o_orderkey % 7 = 0 THEN o_orderpriority || chr(10) || 'next' WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_comment,
      round(o_totalprice, 6) AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders""",
    "s3_nested_json": "SELECT o_custkey AS video_id, o_orderkey AS clip_id, round(o_totalprice, 6) AS price FROM orders",
    "s7_parquet_sink": "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events",
    "s8_label_store": sql("control_grid", "SELECT recording_id, decision_index, decision_time_s, slot_end_s, state_before, action, action_valid, round(event_time_s, 6) AS event_time_s, round(tau_s, 6) AS tau_s, mask_reason FROM control_grid"),
    "s9_split_sink": "SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'test' WHEN o_custkey % 10 = 1 THEN 'validation' ELSE 'train' END AS split FROM orders",
    "c7_source_rows": "SELECT conv_id, turn, sha256(coalesce(text, '')) AS text_sha256, row_number() OVER (ORDER BY conv_id, turn) - 1 AS source_row FROM conversations",
    "a16_population_scan": """SELECT o_orderkey, CASE WHEN bad THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS o_clerk, CASE WHEN NOT bad AND o_orderkey % 10 <> 0 THEN o_custkey END AS number, CASE WHEN NOT bad AND o_orderkey % 10 <> 0 THEN o_custkey // (o_orderkey % 10) END AS share,
      NOT bad AND o_orderkey % 10 <> 0 AS probe_ok, CASE WHEN bad THEN 'ValueError: invalid literal for int() with base 10: ''none''' WHEN o_orderkey % 10 = 0 THEN 'ZeroDivisionError: integer division or modulo by zero' END AS probe_error FROM (SELECT *, o_orderkey % 7 = 3 AS bad FROM orders)""",
    "a12_cross_source": sql("lside rside", f""", l AS (SELECT k, a, a + 30 AS b FROM lside WHERE k NOT IN (1, 2) AND a IS NOT NULL), r AS (SELECT k, a, b FROM rside WHERE k NOT IN (1, 2) AND a IS NOT NULL AND b IS NOT NULL)
      SELECT * FROM (SELECT count(*) FILTER (WHERE x AND y) AS shared_keys, count(*) FILTER (WHERE y IS NULL) AS left_only_keys, count(*) FILTER (WHERE x IS NULL) AS right_only_keys FROM (SELECT DISTINCT k, true AS x FROM l) FULL JOIN (SELECT DISTINCT k, true AS y FROM r) USING (k)),
        (SELECT round(avg(CASE WHEN (k, a) IN (SELECT (k, a) FROM r) THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS left_share, count(*) AS left_rows FROM l), (SELECT round(avg(CASE WHEN (k, a) IN (SELECT (k, a) FROM l) THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS right_share, count(*) AS right_rows FROM r),
        ({_side("l", "r", "left", "b - a")}), ({_side("r", "l", "right", "b - a")})"""),
    "x14_fact_participants": """WITH l AS (SELECT l_orderkey AS recording_id, CAST(l_suppkey AS VARCHAR) AS who, l_linenumber AS n FROM lineitem), p AS (SELECT recording_id, who AS participant_id, n % 2 = 1 AS listed, true AS resolved FROM l WHERE n % 2 = 1 OR n % 5 <> 4
      UNION ALL SELECT recording_id, '<unresolved>', false, false FROM l WHERE n % 5 = 4) SELECT recording_id, participant_id, participant_id = wearer AS is_wearer, bool_and(resolved) AS resolved, bool_or(listed) AS listed FROM p JOIN (SELECT recording_id, min(who) AS wearer FROM l GROUP BY 1) USING (recording_id) GROUP BY 1, 2, 3""",
    "x14_fact_tokens": """SELECT recording_id, participant_id, 'utterance' AS unit, text, CASE WHEN ok THEN a END AS start_s, CASE WHEN ok THEN b END AS end_s, ok AS timing_valid, source_row FROM (SELECT *, coalesce(b > a, false) AS ok FROM (
      SELECT l_orderkey AS recording_id, CASE WHEN l_linenumber % 5 <> 4 THEN CAST(l_suppkey AS VARCHAR) ELSE '<unresolved>' END AS participant_id, CAST(l_partkey AS VARCHAR) AS text, CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS a, l_linenumber * CAST(5 AS DOUBLE) AS b, l_linenumber AS source_row FROM lineitem))""",
    "g20_grid_by_recording": sql("control_grid", "SELECT recording_id, decision_index, decision_time_s, row_number() OVER (PARTITION BY recording_id ORDER BY decision_index) - 1 AS place FROM control_grid"),
    "p10_codec_boundary": sql("pkt", "SELECT stream, coalesce(sum(CASE WHEN i = 0 THEN 1024 ELSE 0 END), 0) AS skip_samples, coalesce(sum(CASE WHEN i % 7 = 6 THEN i % 100 ELSE 0 END), 0) AS discard_padding_samples FROM pkt GROUP BY 1"),
    "p16_decode_cases": sql("fls evs", """, f AS (SELECT * FROM fls WHERE stream % 10 <> 0), q AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY regime ORDER BY max_abs_drift, max_abs_step, stream) = 1)
      SELECT reason, regime, stream, round(t, 6) AS time_s FROM (
        SELECT 'regime_start' AS reason, regime, stream, CAST(0 AS DOUBLE) AS t FROM q UNION ALL SELECT 'regime_end', regime, stream, duration_s FROM q
        UNION ALL SELECT * FROM (SELECT 'bounded_jitter', regime, stream, peak_time_s FROM f WHERE jitter ORDER BY variations DESC, stream LIMIT 1)
        UNION ALL SELECT category, regime, stream, t FROM (SELECT * FROM evs WHERE category IN ('stitch', 'codec_boundary') QUALIFY row_number() OVER (PARTITION BY category ORDER BY ms DESC, stream, t) = 1)
        UNION ALL SELECT category, regime, stream, t FROM (SELECT * FROM evs WHERE category = 'compensated' QUALIFY row_number() OVER (PARTITION BY regime ORDER BY ms DESC, stream, t) = 1)
        UNION ALL SELECT category, regime, stream, t FROM (SELECT * FROM evs WHERE category = 'dropout' QUALIFY row_number() OVER (PARTITION BY regime ORDER BY net DESC, stream, t) = 1)
        UNION ALL SELECT * FROM (SELECT 'largest_drift', regime, stream, peak_time_s FROM f ORDER BY max_abs_drift DESC, stream LIMIT 2))"""),
    "p18_regime_profile": sql("rgm", "SELECT CASE WHEN nominal < CAST(972.8 AS DOUBLE) THEN 'dense' ELSE 'sparse' END AS cadence, count(*) AS files, " + ", ".join(
        f"round(quantile_cont({v}, {p / 100}), 6) AS {n}_q{p}" for n, v in (("nominal", "nominal"), ("final_drift_ms", "1000 * final_drift / 48000"), ("max_drift", "max_abs_drift")) for p in (0, 25, 50, 75, 100)) + " FROM rgm GROUP BY 1"),
    "p18_profile_windows": sql("rgm", "SELECT stream, 'start' AS place, CAST(0 AS DOUBLE) AS time_s FROM rgm UNION ALL SELECT stream, 'middle', round(duration_s / 2, 6) FROM rgm UNION ALL SELECT stream, 'max_offset', round(peak_time_s, 6) FROM rgm UNION ALL SELECT stream, 'end', round(duration_s, 6) FROM rgm"),
}
ORACLE_SQL["s8_store_tables"] = sql("control_grid pevents fchanges pruns trn ovl sil recs who", """SELECT 'grid' AS table_name, count(*) AS n, count(DISTINCT recording_id) AS recordings FROM control_grid
  UNION ALL SELECT 'events', count(*), count(DISTINCT recording_id) FROM (SELECT recording_id FROM pevents UNION ALL SELECT recording_id FROM fchanges)
  UNION ALL SELECT 'segments', count(*), count(DISTINCT recording_id) FROM (SELECT recording_id FROM pruns UNION ALL SELECT recording_id FROM trn UNION ALL SELECT recording_id FROM ovl UNION ALL SELECT recording_id FROM sil)
  UNION ALL SELECT 'participants', count(*), count(DISTINCT recording_id) FROM who UNION ALL SELECT 'recordings', count(*), count(DISTINCT recording_id) FROM recs""")
ORACLE_SQL["s4_listed_files"] = """SELECT 'lot=' || lot AS dataset, 'other' AS file_type, CAST(sum(strlen(html) + 1) AS BIGINT) AS size, sha256(string_agg(html || chr(10), '' ORDER BY page_id)) AS sha256
  FROM (SELECT *, page_id // 10 AS lot FROM pages) GROUP BY lot"""
