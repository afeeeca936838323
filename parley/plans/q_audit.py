"""Queries on windows and splits, cleaning and audits."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from parley.operators import audit, grid, windows
from parley.plans.oracle import sql
from parley.plans.q_state import STEP, control, events, rounded
from parley.sources import canonical as c
from parley.sources.shared import saved

SPEC = windows.WindowSpec.of_seconds(STEP, 60.0, 300.0, 100.0)
SEED = "parley"


def _grid(spark, sf_dir):
    return grid.action_grid(control(spark, sf_dir), STEP)


def _index(spark, sf_dir):
    return windows.anchors(_grid(spark, sf_dir), SPEC)


def _upstream(e):
    days = c.recordings(e).select("recording_id", F.substring("recording_id", 9, 2).cast("int").alias("d"))
    names = F.when(F.col("d") % 6 == 0, " Val ").when(F.col("d") % 6 == 2, "TRAIN").otherwise("test")
    return days.select("recording_id", F.when(F.col("d") % 2 == 0, names).alias("split"), F.col("d").alias("source_row"))


def _splits(spark, sf_dir):
    e = events(spark, sf_dir)
    return windows.assign_splits(c.recordings(e), _upstream(e), SEED)


def m2_canonical_order(spark, sf_dir):
    rows = _grid(spark, sf_dir).select("recording_id", "decision_index", "action")
    return rounded(windows.numbered(rows, "recording_id", "decision_index"))


def m3_segments(spark, sf_dir):
    # A hole after each hundred slots.
    moved = _grid(spark, sf_dir).withColumn("decision_index", F.col("decision_index") + F.floor(F.col("decision_index") / 100))
    rows = windows.segments(moved)
    return rounded(rows.groupBy("recording_id", "segment").agg(F.min("decision_index").alias("first_index"), F.count("*").alias("slots")).drop("segment"))


def m4_anchors(spark, sf_dir):
    return rounded(_index(spark, sf_dir).drop("segment"))


def m9_split_names(spark, sf_dir):
    return rounded(_upstream(events(spark, sf_dir)).select("recording_id", windows.normal_split(F.col("split")).alias("split")))


def m11_assigned_splits(spark, sf_dir):
    return rounded(_splits(spark, sf_dir))


def m12_split_leakage(spark, sf_dir):
    return windows.split_leakage(_splits(spark, sf_dir))


def m13_index_summary(spark, sf_dir):
    return rounded(windows.index_summary(_index(spark, sf_dir)))


def m14_index_statistics(spark, sf_dir):
    out = windows.index_statistics(_index(spark, sf_dir), _splits(spark, sf_dir))
    return rounded(out.select(F.coalesce("split", F.lit("all")).alias("split"), F.coalesce("sample_class", F.lit("all")).alias("sample_class"), "anchors", "trainable", "recordings", "mean_future_valid"))


def m15_window_reconstruction(spark, sf_dir):
    out = windows.reconstruct(_grid(spark, sf_dir), SPEC)
    events_in = F.size(F.filter("future", lambda a: a.isin("ONSET", "OFFSET")))
    digests = [F.sha2(F.concat_ws(",", n), 256).alias(f"{n}_sha256") for n in ("context", "future")]
    return rounded(out.select("recording_id", "decision_index", F.size("context").alias("context_steps"), events_in.alias("future_events"), *digests))


def m23_index_violations(spark, sf_dir):
    """The index with faults added: of each recording's first anchor a copy that is twice there, one moved off the grid, one whose flags lie, and splits given twice."""
    index, splits = saved(_index(spark, sf_dir), "index"), _splits(spark, sf_dir).select("recording_id", "conversation_id", "split")
    first = index.filter(F.col("position") == SPEC.min_context - 1)
    moved = first.withColumn("decision_index", F.col("decision_index") + 100_000)
    lies = first.withColumns({"context_steps": F.col("context_steps") + 40, "sample_class": F.when(F.col("sample_class") == "event", "background").otherwise("event"), "trainable": ~F.col("trainable")})
    held = F.substring("recording_id", 9, 2)
    again = splits.filter(held == "03").withColumn("split", F.lit("other"))
    return rounded(windows.index_violations(index.unionByName(moved).unionByName(lies), _grid(spark, sf_dir), splits.filter(held != "04").unionByName(again), SPEC))


def m8_index(spark, sf_dir):
    """The whole index over a grid with a hole after each hundred slots."""
    sound = saved(_grid(spark, sf_dir), "grid")
    holed = sound.withColumn("decision_index", F.col("decision_index") + F.floor(F.col("decision_index") / 100))
    return rounded(windows.build_index(holed, c.recordings(events(spark, sf_dir)), _splits(spark, sf_dir), SPEC))


def m14_context_histogram(spark, sf_dir):
    return rounded(windows.context_histogram(_index(spark, sf_dir), _splits(spark, sf_dir)))


def _orders(spark, sf_dir):
    return c.table(spark, sf_dir, "orders")


def _lines(spark, sf_dir):
    return c.table(spark, sf_dir, "lineitem")


def _labelled(spark, sf_dir):
    docs, labels = c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "labels")
    return docs.select("doc_id", "lang", "source", "n_chars").join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left")


def c2_required_fields(spark, sf_dir):
    return rounded(audit.clean(_labelled(spark, sf_dir), ["quality", "lang"], {"too_short": F.col("n_chars") > 300})[1])


def c3_accounting(spark, sf_dir):
    return rounded(audit.accounting(_labelled(spark, sf_dir), ["quality", "lang"], {"too_short": F.col("n_chars") > 300}))


def c4_positive_boxes(spark, sf_dir):
    e = events(spark, sf_dir)
    size = F.when(F.col("event_id") % 97 == 0, F.lit(0.0)).otherwise(F.col("value"))
    boxes = e.select("event_id", size.alias("width"), (size / 2).alias("height"))
    kept, gone = audit.clean(boxes, [], {"non_positive_box": (F.col("width") > 0) & (F.col("height") > 0)})
    return rounded(kept.agg(F.lit("kept").alias("reason"), F.count("*").alias("n")).unionByName(gone))


def c5_null_report(spark, sf_dir):
    return rounded(audit.null_report(_labelled(spark, sf_dir), ["quality", "toxic", "lang"]))


def c6_one_hot_split(spark, sf_dir):
    o = _orders(spark, sf_dir)
    rows = o.select("o_orderkey", *((F.col("o_orderstatus") == s).alias(n) for s, n in (("F", "train"), ("O", "val"), ("P", "test"))))
    out = audit.one_hot_split(rows, ["train", "val", "test"], ["train", "validation", "test"])
    return rounded(out.groupBy("split", "broken").agg(F.count("*").alias("n")))


def c8_timing_classes(spark, sf_dir):
    t = c.table(spark, sf_dir, "conversations")
    timed, blank = F.col("turn") % 7 != 6, F.trim(F.coalesce("text", F.lit(""))) == ""
    return rounded(audit.domain_counts(t, {"timed": timed, "untimed": ~timed, "untimed_with_text": ~timed & ~blank, "blank": blank}))


def c9_membership(spark, sf_dir):
    o, cust = _orders(spark, sf_dir), c.table(spark, sf_dir, "customer")
    own = o.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(F.count("*").alias("n")).select(F.lit("member").alias("kind"), "n")
    none = cust.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("n")).select(F.lit("without_order").alias("kind"), "n")
    return rounded(own.unionByName(none))


def c10_domain_counts(spark, sf_dir):
    return rounded(audit.domain_counts(_lines(spark, sf_dir), {"returned": F.col("l_returnflag") == "R", "free": F.col("l_tax") == 0, "bulk": F.col("l_quantity") >= 45, "open": F.col("l_linestatus") == "O"}))


def _days(column):
    return F.datediff(F.col(column).cast("date"), F.lit("1990-01-01").cast("date")).cast("double")


def _shipping(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("k"), _days("l_shipdate").alias("end_d"))
    orders = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("k"), _days("o_orderdate").alias("start_d"))
    return lines.join(orders, "k", "left").withColumn("limit_d", F.lit(3800.0))


def a1_temporal_integrity(spark, sf_dir):
    return rounded(audit.temporal_integrity(_shipping(spark, sf_dir), "start_d", "end_d", "limit_d", 5.0))


def a2_entity_reference(spark, sf_dir):
    lines, parts = _lines(spark, sf_dir), c.table(spark, sf_dir, "part")
    # Every seventh line of an order names a part that isn't there.
    lines = lines.withColumn("l_partkey", F.when(F.col("l_linenumber") == 7, -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    return rounded(audit.foreign_key(lines, ["l_partkey"], parts, ["p_partkey"], sentinels=[0, 1, 2]))


def a3_media_reference(spark, sf_dir):
    pages, docs = c.table(spark, sf_dir, "pages"), c.table(spark, sf_dir, "documents")
    media = pages.select(F.concat(F.lit("corpus/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"))
    return rounded(audit.media_reference(docs.withColumn("k", F.pmod("doc_id", F.lit(300))), "k", media, "path"))


def a4_foreign_keys(spark, sf_dir):
    out = None
    for name, child, column, parent, key in (
        ("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
        ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
        ("labels_documents", "labels", "doc_id", "documents", "doc_id"),
    ):
        found = audit.foreign_key(c.table(spark, sf_dir, child), [column], c.table(spark, sf_dir, parent), [key]).select(F.lit(name).alias("relation"), "rows", "orphans")
        out = found if out is None else out.unionByName(found)
    return rounded(out)


_CHECKS = {"price_positive": "o_totalprice > 0", "status_known": "o_orderstatus IN ('F', 'O')", "priority_given": "o_orderpriority IS NOT NULL"}


def a5_table_contract(spark, sf_dir):
    return rounded(audit.contract_failures(_orders(spark, sf_dir), {n: F.expr(e) for n, e in _CHECKS.items()}, ["o_orderkey"]))


def _faulty(spark, sf_dir):
    """Orders, and after each of every hundredth a copy with faults: the key again, no price, a clerk that is no number, a status unheard of."""
    o = _orders(spark, sf_dir).select("o_orderkey", F.col("o_custkey").cast("string").alias("o_clerk"), "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    copies = o.filter(k % 100 == 0).withColumns({"o_clerk": F.when(k % 300 == 0, "none").otherwise(F.col("o_clerk")), "o_totalprice": F.when(k % 200 != 0, -F.col("o_totalprice")), "o_orderstatus": F.when(k % 500 == 0, "X").otherwise(F.col("o_orderstatus"))})
    return o.unionByName(copies)


def a5_failure_cases(spark, sf_dir):
    checks = {"price_positive": ("o_totalprice", F.col("o_totalprice") > 0), "status_known": ("o_orderstatus", F.col("o_orderstatus").isin("F", "O", "P"))}
    return rounded(audit.failure_cases(_faulty(spark, sf_dir), ["o_orderkey"], {"o_clerk": "bigint"}, checks, ["o_totalprice"], [["o_orderkey"]]))


def a6_structural_verdict(spark, sf_dir):
    checks = a5_table_contract(spark, sf_dir).agg(F.bool_and(F.col("failures") == 0).alias("sound")).select(F.lit("contracts").alias("part"), "sound")
    keys = a4_foreign_keys(spark, sf_dir).agg(F.bool_and(F.col("orphans") == 0).alias("sound")).select(F.lit("relations").alias("part"), "sound")
    return checks.unionByName(keys)


def a7_reference_durations(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_quantity", "l_extendedprice")
    out = audit.reference_durations(lines.select("k", "l_quantity"), "k", lines, F.col("l_extendedprice"), ["l_linenumber", "l_extendedprice"])
    return rounded(out.groupBy("k").agg(F.count("*").alias("n"), F.max("reference_s").alias("reference_s")))


def a8_duplicate_identity(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey")
    return rounded(audit.duplicates(rows, ["l_orderkey", "l_linenumber"]))


def a9_source_verdicts(spark, sf_dir):
    report = audit.temporal_integrity(_shipping(spark, sf_dir), "start_d", "end_d", "limit_d", 5.0)
    levels = {"missing": "WARNING", "reversed": "ERROR", "empty": "INFO", "overshoots": "WARNING"}
    found = audit.severities(report, levels).withColumn("source", F.lit("shipping"))
    return audit.source_verdict(found, "source")


def _sides(spark, sf_dir):
    left = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("k"), _days("o_orderdate").alias("start_s")).withColumn("end_s", F.col("start_s") + 30)
    right = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("k"), _days("l_shipdate").alias("start_s"), (_days("l_shipdate") + F.col("l_quantity")).alias("end_s"))
    return left, right


def a10_exact_identity(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return rounded(audit.exact_identity(left, right, ["k", "start_s"]))


def a11_interval_coverage(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return rounded(audit.coverage(left, right, "k", 2.0))


def a12_cross_source_keys(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    a, b = left.select("k").distinct().withColumn("l", F.lit(True)), right.select("k").distinct().withColumn("r", F.lit(True))
    both = a.join(b, "k", "full_outer")
    return rounded(both.agg(F.count_if(F.col("l") & F.col("r")).alias("shared"), F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only")))


def m21_fingerprints(spark, sf_dir):
    """What makes an artifact stale: a row more, one value changed, or a table that is gone; not rows dealt another way."""
    orders, nation, customer = (c.table(spark, sf_dir, n) for n in ("orders", "nation", "customer"))
    events_ = events(spark, sf_dir)
    more = orders.unionByName(orders.agg(*(F.max(x).alias(x) for x in orders.columns)))
    other = nation.withColumn("n_name", F.when(F.col("n_nationkey") == 3, "elsewhere").otherwise(F.col("n_name")))

    def prints(tables):
        parts = [audit.fingerprint(t).select(F.lit(n).alias("artifact"), F.col("n").alias("rows"), F.col("checksum").cast("string").alias("checksum")) for n, t in tables.items()]
        return functools.reduce(lambda a, b: a.unionByName(b), parts)

    recorded = prints({"orders": orders, "nation": nation, "customer": customer, "events": events_})
    current = prints({"orders": more, "nation": other, "customer": customer.repartition(7, "c_custkey")})
    stale = audit.staleness(recorded, current, "artifact", ["rows", "checksum"])
    return recorded.select("artifact", "rows").join(stale, "artifact", "left")


QUERIES = {k: v for k, v in list(globals().items()) if k.split("_")[0][:1] in "acm" and k.split("_")[0][1:].isdigit()}

from parley.plans.oracle import part  # noqa: E402

part(
    "idx",
    "control_grid",
    """SELECT *, CAST(cv AS DOUBLE) / context_steps AS context_valid, CAST(fv AS DOUBLE) / 10 AS future_valid FROM (
      SELECT recording_id, decision_index, seg, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY recording_id, seg) AS n, least(row_number() OVER w, 30) AS context_steps,
        sum(CAST(action_valid AS INT)) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS cv, sum(CAST(action_valid AS INT)) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS fv,
        coalesce(sum(CASE WHEN action IN ('ONSET', 'OFFSET') THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), 0) AS future_events
      FROM (SELECT *, decision_index - row_number() OVER (PARTITION BY recording_id ORDER BY decision_index) AS seg FROM control_grid) WINDOW w AS (PARTITION BY recording_id, seg ORDER BY decision_index))
      WHERE position + 1 >= 6 AND position + 10 < n""",
)
part("upstream", "recs", "SELECT recording_id, d, CASE WHEN d % 2 = 0 THEN CASE WHEN d % 6 = 0 THEN 'validation' WHEN d % 6 = 2 THEN 'train' ELSE 'test' END END AS split FROM (SELECT recording_id, CAST(substr(recording_id, 9, 2) AS INT) AS d FROM recs)")
part("conv", "upstream", "SELECT recording_id, split, 'week-' || CAST(week(CAST(substr(recording_id, 1, 10) AS DATE)) AS VARCHAR) || substr(recording_id, 14) AS conversation_id FROM upstream")
part("fall", "conv", "SELECT conversation_id, CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'validation' ELSE 'test' END AS own FROM (SELECT conversation_id, row_number() OVER (ORDER BY md5('parley:' || conversation_id)) AS r, round_even(count(*) OVER () * CAST(0.8 AS DOUBLE), 0) AS a, round_even(count(*) OVER () * CAST(0.1 AS DOUBLE), 0) AS b FROM (SELECT DISTINCT conversation_id FROM conv WHERE split IS NULL))")
part("splits", "conv fall", "SELECT recording_id, c.conversation_id, coalesce(split, own) AS split, CASE WHEN split IS NULL THEN 'fallback' ELSE 'upstream' END AS split_source FROM conv c LEFT JOIN fall f USING (conversation_id)")
part("labelled", "", "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, CASE WHEN l.quality IS NULL THEN 'missing_quality' WHEN d.lang IS NULL THEN 'missing_lang' WHEN d.n_chars > 300 THEN NULL ELSE 'too_short' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
part("ship", "", "SELECT CAST(date_diff('day', DATE '1990-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS s, CAST(date_diff('day', DATE '1990-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS e FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey")
part("lside", "", "SELECT o_orderkey AS k, CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS a FROM orders")
part("rside", "", "SELECT l_orderkey AS k, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS a, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) + l_quantity AS b FROM lineitem")
part("fk", "", """SELECT 'lineitem_orders' AS relation, (SELECT count(*) FROM lineitem) AS rows, (SELECT count(*) FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey) AS orphans
  UNION ALL SELECT 'orders_customer', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey)
  UNION ALL SELECT 'customer_nation', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer ANTI JOIN nation ON n_nationkey = c_nationkey)
  UNION ALL SELECT 'labels_documents', (SELECT count(*) FROM labels), (SELECT count(*) FROM labels l ANTI JOIN documents d ON d.doc_id = l.doc_id)""")
part("contract", "", """SELECT 'price_positive' AS check_name, count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS failures FROM orders
  UNION ALL SELECT 'status_known', count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false)) FROM orders
  UNION ALL SELECT 'priority_given', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders
  UNION ALL SELECT 'unique_o_orderkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""")

_CLASS = "CASE WHEN future_events > 0 THEN 'event' ELSE 'background' END"
_TRAIN = "context_valid >= CAST(0.9 AS DOUBLE) AND future_valid >= 1"
_INTEGRITY = """count(*) AS rows, count(*) FILTER (WHERE s IS NULL OR e IS NULL) AS missing, CAST(0 AS BIGINT) AS non_finite, count(*) FILTER (WHERE s < 0) AS negative_start, count(*) FILTER (WHERE s > e) AS reversed,
  count(*) FILTER (WHERE s = e) AS empty, quantile_cont(e - s, [0, 0.05, 0.5, 0.95, 1]) AS q, count(*) FILTER (WHERE e - 3800 > 5) AS overshoots, max(e - 3800) FILTER (WHERE e - 3800 > 5) AS max_overshoot, CAST(0 AS BIGINT) AS unresolved"""
ORACLE_SQL = {
    "m2_canonical_order": sql("control_grid", "SELECT recording_id, decision_index, action, row_number() OVER (ORDER BY recording_id, decision_index) - 1 AS row_number FROM control_grid"),
    "m3_segments": sql("control_grid", "SELECT recording_id, min(decision_index) AS first_index, count(*) AS slots FROM (SELECT *, decision_index - row_number() OVER (PARTITION BY recording_id ORDER BY decision_index) AS g FROM (SELECT recording_id, decision_index + decision_index // 100 AS decision_index FROM control_grid)) GROUP BY recording_id, g"),
    "m4_anchors": sql("idx", f"SELECT recording_id, decision_index, position, context_steps, round(context_valid, 6) AS context_valid, round(future_valid, 6) AS future_valid, CAST(future_events AS BIGINT) AS future_events, {_CLASS} AS sample_class, {_TRAIN} AS trainable FROM idx"),
    "m9_split_names": sql("upstream", "SELECT recording_id, split FROM upstream"),
    "m11_assigned_splits": sql("splits", "SELECT * FROM splits"),
    "m12_split_leakage": sql("splits", "SELECT conversation_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM splits GROUP BY 1 HAVING count(DISTINCT split) > 1"),
    "m13_index_summary": sql("idx", f"SELECT recording_id, count(*) AS anchors, count(*) FILTER (WHERE {_TRAIN}) AS trainable, count(*) FILTER (WHERE future_events > 0) AS events, count(DISTINCT seg) AS segments, min(decision_index) AS first_index, max(decision_index) AS last_index, round(avg(context_valid), 6) AS mean_context_valid FROM idx GROUP BY 1"),
    "m14_index_statistics": sql("idx splits", f"SELECT coalesce(split, 'all') AS split, coalesce(sample_class, 'all') AS sample_class, count(*) AS anchors, count(*) FILTER (WHERE trainable) AS trainable, count(DISTINCT recording_id) AS recordings, round(avg(future_valid), 6) AS mean_future_valid FROM (SELECT i.recording_id, s.split, {_CLASS} AS sample_class, {_TRAIN} AS trainable, future_valid FROM idx i JOIN splits s USING (recording_id)) GROUP BY GROUPING SETS ((split, sample_class), (split), ())"),
    "m23_index_violations": sql("idx splits control_grid", f""", i0 AS (SELECT recording_id, decision_index, position, context_steps, context_valid, future_valid, future_events, {_CLASS} AS sample_class, {_TRAIN} AS trainable FROM idx),
        i AS (SELECT * FROM i0 UNION ALL SELECT * REPLACE (decision_index + 100000 AS decision_index) FROM i0 WHERE position = 5
          UNION ALL SELECT * REPLACE (context_steps + 40 AS context_steps, CASE sample_class WHEN 'event' THEN 'background' ELSE 'event' END AS sample_class, NOT trainable AS trainable) FROM i0 WHERE position = 5),
        s AS (SELECT recording_id, conversation_id, split FROM splits WHERE substr(recording_id, 9, 2) <> '04' UNION ALL SELECT recording_id, conversation_id, 'other' FROM splits WHERE substr(recording_id, 9, 2) = '03'),
        g AS (SELECT recording_id, decision_index, row_number() OVER (PARTITION BY recording_id ORDER BY decision_index) AS place FROM control_grid),
        m AS (SELECT i.*, o.place AS own, a.place AS a, b.place AS b, count(*) OVER (PARTITION BY i.recording_id, i.decision_index) AS times FROM i LEFT JOIN g o ON o.recording_id = i.recording_id AND o.decision_index = i.decision_index
          LEFT JOIN g a ON a.recording_id = i.recording_id AND a.decision_index = i.decision_index - i.context_steps + 1 LEFT JOIN g b ON b.recording_id = i.recording_id AND b.decision_index = i.decision_index + 10)
      SELECT 'anchor_not_in_grid' AS rule, count(*) FILTER (WHERE own IS NULL) AS n FROM m
      UNION ALL SELECT 'anchor_twice', count(*) FILTER (WHERE times > 1) FROM m
      UNION ALL SELECT 'context_length', count(*) FILTER (WHERE context_steps < 6 OR context_steps > 30) FROM m
      UNION ALL SELECT 'context_with_holes', count(*) FILTER (WHERE a IS NULL OR own - a + 1 <> context_steps) FROM m
      UNION ALL SELECT 'future_with_holes', count(*) FILTER (WHERE b IS NULL OR b - own <> 10) FROM m
      UNION ALL SELECT 'class_of_events', count(*) FILTER (WHERE (sample_class = 'event') <> (future_events > 0)) FROM m
      UNION ALL SELECT 'trainable_shares', count(*) FILTER (WHERE trainable <> ({_TRAIN})) FROM m
      UNION ALL SELECT 'recording_without_split', count(DISTINCT recording_id) FROM i WHERE recording_id NOT IN (SELECT recording_id FROM s WHERE split IS NOT NULL)
      UNION ALL SELECT 'recording_in_two_splits', count(*) FROM (SELECT recording_id FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1)
      UNION ALL SELECT 'conversation_in_two_splits', count(*) FROM (SELECT conversation_id FROM s WHERE conversation_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)"""),
    "m8_index": sql("control_grid splits", f""", h AS (SELECT *, decision_index + decision_index // 100 AS k FROM control_grid),
        g AS (SELECT *, k - row_number() OVER (PARTITION BY recording_id ORDER BY k) AS seg, row_number() OVER (ORDER BY recording_id, k) - 1 AS anchor_row FROM h),
        d AS (SELECT *, dense_rank() OVER (PARTITION BY recording_id ORDER BY seg) - 1 AS segment_id FROM g),
        i AS (SELECT *, CAST(cv AS DOUBLE) / context_steps AS context_valid, CAST(fv AS DOUBLE) / 10 AS future_valid FROM (SELECT *, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY recording_id, seg) AS n, least(row_number() OVER w, 30) AS context_steps,
          sum(CAST(action_valid AS INT)) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS cv, sum(CAST(action_valid AS INT)) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS fv,
          coalesce(sum(CASE WHEN action IN ('ONSET', 'OFFSET') THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), 0) AS future_events FROM d WINDOW w AS (PARTITION BY recording_id, seg ORDER BY k)) WHERE position + 1 >= 6 AND position + 10 < n)
      SELECT i.recording_id || '#' || k AS sample_id, 'events' AS dataset, i.recording_id, s.conversation_id, i.recording_id AS view_id, 'click' AS wearer_id, s.split, segment_id, k AS anchor_idx, round(decision_time_s, 6) AS anchor_time, anchor_row, context_steps AS max_context_steps, 10 AS future_steps,
        round(context_valid, 6) AS context_valid_ratio, round(future_valid, 6) AS future_valid_ratio, CAST(future_events AS BIGINT) AS future_event_count, {_CLASS} AS sample_class, {_TRAIN} AS is_trainable, s.split_source, 1 AS window_schema_version, 1 AS action_schema_version FROM i JOIN splits s USING (recording_id)"""),
    "m14_context_histogram": sql("idx splits", f"SELECT split, context_steps, count(*) AS anchors, count(*) FILTER (WHERE trainable) AS trainable FROM (SELECT i.recording_id, s.split, context_steps, {_TRAIN} AS trainable FROM idx i JOIN splits s USING (recording_id)) GROUP BY 1, 2"),
    "m15_window_reconstruction": sql("idx", """, read AS (SELECT recording_id, decision_index, sha256(array_to_string(list(coalesce(action, 'masked')) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), ',')) AS context_sha256, sha256(array_to_string(list(coalesce(action, 'masked')) OVER (w ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), ',')) AS future_sha256
        FROM (SELECT *, decision_index - row_number() OVER (PARTITION BY recording_id ORDER BY decision_index) AS seg FROM control_grid) WINDOW w AS (PARTITION BY recording_id, seg ORDER BY decision_index))
      SELECT recording_id, decision_index, context_steps, CAST(future_events AS BIGINT) AS future_events, context_sha256, future_sha256 FROM idx JOIN read USING (recording_id, decision_index)"""),
    "c2_required_fields": sql("labelled", "SELECT reason, count(*) AS n FROM labelled WHERE reason IS NOT NULL GROUP BY 1"),
    "c3_accounting": sql("labelled", "SELECT count(*) AS source, count(*) FILTER (WHERE reason IS NULL) AS kept, count(reason) AS dropped, true AS balanced FROM labelled"),
    "c4_positive_boxes": "SELECT CASE WHEN event_id % 97 <> 0 AND value > 0 THEN 'kept' ELSE 'non_positive_box' END AS reason, count(*) AS n FROM events GROUP BY 1",
    "c5_null_report": sql("labelled", "SELECT 'quality' AS column_name, count(*) FILTER (WHERE quality IS NULL) AS nulls FROM labelled UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM labelled UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM labelled UNION ALL SELECT 'any', count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL OR lang IS NULL) FROM labelled"),
    "c6_one_hot_split": "SELECT CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'validation' WHEN 'P' THEN 'test' END AS split, o_orderstatus NOT IN ('F', 'O', 'P') AS broken, count(*) AS n FROM orders GROUP BY 1, 2",
    "c8_timing_classes": "SELECT 'timed' AS domain, count(*) FILTER (WHERE turn % 7 <> 6) AS n FROM conversations UNION ALL SELECT 'untimed', count(*) FILTER (WHERE turn % 7 = 6) FROM conversations UNION ALL SELECT 'untimed_with_text', count(*) FILTER (WHERE turn % 7 = 6 AND trim(coalesce(text, '')) <> '') FROM conversations UNION ALL SELECT 'blank', count(*) FILTER (WHERE trim(coalesce(text, '')) = '') FROM conversations",
    "c9_membership": "SELECT 'member' AS kind, count(*) AS n FROM orders SEMI JOIN customer ON c_custkey = o_custkey UNION ALL SELECT 'without_order', count(*) FROM customer ANTI JOIN orders ON c_custkey = o_custkey",
    "c10_domain_counts": "SELECT 'returned' AS domain, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem UNION ALL SELECT 'free', count(*) FILTER (WHERE l_tax = 0) FROM lineitem UNION ALL SELECT 'bulk', count(*) FILTER (WHERE l_quantity >= 45) FROM lineitem UNION ALL SELECT 'open', count(*) FILTER (WHERE l_linestatus = 'O') FROM lineitem",
    "a1_temporal_integrity": sql("ship", f"SELECT * EXCLUDE (q), q[1] AS duration_min, q[2] AS duration_p05, q[3] AS duration_median, q[4] AS duration_p95, q[5] AS duration_max FROM (SELECT {_INTEGRITY} FROM ship)"),
    "a2_entity_reference": "SELECT count(*) AS rows, count(*) FILTER (WHERE l_partkey IN (0, 1, 2)) AS sentinels, count(*) FILTER (WHERE l_partkey NOT IN (0, 1, 2) AND p_partkey IS NULL) AS orphans FROM (SELECT CASE WHEN l_linenumber = 7 THEN -l_partkey ELSE l_partkey END AS l_partkey FROM lineitem) LEFT JOIN part ON p_partkey = l_partkey",
    "a3_media_reference": "SELECT CAST(k AS VARCHAR) AS media_key, count(*) AS n FROM (SELECT doc_id % 300 AS k FROM documents) WHERE k NOT IN (SELECT page_id FROM pages) GROUP BY 1",
    "a4_foreign_keys": sql("fk", "SELECT * FROM fk"),
    "a5_table_contract": sql("contract", "SELECT * FROM contract"),
    "a5_failure_cases": """WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS clerk, o_totalprice AS price, o_orderstatus AS status FROM orders
        UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 300 = 0 THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END, CASE WHEN o_orderkey % 200 <> 0 THEN -o_totalprice END, CASE WHEN o_orderkey % 500 = 0 THEN 'X' ELSE o_orderstatus END FROM orders WHERE o_orderkey % 100 = 0)
      SELECT o_orderkey, 'not_null' AS check_name, 'o_totalprice' AS column_name, CAST(NULL AS VARCHAR) AS failure_case FROM t WHERE price IS NULL
      UNION ALL SELECT o_orderkey, 'type_bigint', 'o_clerk', clerk FROM t WHERE TRY_CAST(clerk AS BIGINT) IS NULL
      UNION ALL SELECT o_orderkey, 'price_positive', 'o_totalprice', CAST(price AS VARCHAR) FROM t WHERE price <= 0
      UNION ALL SELECT o_orderkey, 'status_known', 'o_orderstatus', status FROM t WHERE status NOT IN ('F', 'O', 'P')
      UNION ALL SELECT o_orderkey, 'unique', 'o_orderkey', CAST(o_orderkey AS VARCHAR) FROM t WHERE o_orderkey IN (SELECT o_orderkey FROM t GROUP BY 1 HAVING count(*) > 1)""",
    "a6_structural_verdict": sql("fk contract", "SELECT 'contracts' AS part, bool_and(failures = 0) AS sound FROM contract UNION ALL SELECT 'relations', bool_and(orphans = 0) FROM fk"),
    "a7_reference_durations": "SELECT l_orderkey AS k, count(*) AS n, round(min_by(l_extendedprice, (l_linenumber, l_extendedprice)), 6) AS reference_s FROM lineitem GROUP BY 1",
    "a8_duplicate_identity": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, copies FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1",
    "a9_source_verdicts": sql("ship", "SELECT 'shipping' AS source, CASE WHEN reversed > 0 THEN 'blocked' WHEN missing > 0 OR overshoots > 0 THEN 'usable_with_caveats' ELSE 'usable' END AS verdict FROM (SELECT " + _INTEGRITY + " FROM ship)"),
    "a10_exact_identity": sql("lside rside", """SELECT round((SELECT avg(CASE WHEN EXISTS (FROM rside r WHERE r.k = l.k AND r.a = l.a) THEN 1.0 ELSE 0.0 END) FROM lside l), 6) AS left_share, (SELECT count(*) FROM lside) AS left_rows,
      round((SELECT avg(CASE WHEN EXISTS (FROM lside l WHERE r.k = l.k AND r.a = l.a) THEN 1.0 ELSE 0.0 END) FROM rside r), 6) AS right_share, (SELECT count(*) FROM rside) AS right_rows"""),
    "a11_interval_coverage": sql("lside rside", "SELECT k, a AS start_s, a + 30 AS end_s, EXISTS (FROM rside r WHERE r.k = l.k AND r.b > r.a AND r.a < l.a + 30 + 2 AND r.b > l.a - 2) AS covered FROM lside l"),
    "a12_cross_source_keys": "SELECT count(*) FILTER (WHERE l AND r) AS shared, count(*) FILTER (WHERE r IS NULL) AS left_only, count(*) FILTER (WHERE l IS NULL) AS right_only FROM (SELECT DISTINCT o_orderkey AS k, true AS l FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS k, true AS r FROM lineitem) USING (k)",
    "m21_fingerprints": "SELECT 'orders' AS artifact, (SELECT count(*) FROM orders) AS rows, 'rows,checksum' AS reasons UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 'checksum' UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), NULL UNION ALL SELECT 'events', (SELECT count(*) FROM events), 'missing'",
}
