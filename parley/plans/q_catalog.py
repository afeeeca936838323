"""Queries on the catalog of labels: what each recording's annotations support."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import catalog
from parley.plans.oracle import part, sql
from parley.plans.q_state import rounded
from parley.sources import canonical as c


def _facts(spark, sf_dir):
    """What each recording provides, told by its events: speech, words, social segments, tracks, media and what is known of its people."""
    e, odd = c.table(spark, sf_dir, "events"), F.col("event_id") % 2 == 1
    kind = F.col("event_type")
    fact = (
        F.when(kind == "click", "speech")
        .when(kind == "signup", F.when(odd, "words").otherwise("transcript"))
        .when(kind == "purchase", F.when(odd, "social.looking").otherwise("social.talking"))
        .when(kind == "view", F.when(odd, "face_tracks").otherwise("media.video"))
        .when(F.col("value") > 30, "media.audio")
        .otherwise(F.when(odd, "meta.host").otherwise("meta.background"))
    )
    return e.select(c.recording().alias("dataset"), fact.alias("fact"))


def _made(support):
    return support.filter("supported AND length(label) % 2 = 0").select("dataset", "label")


def l1_catalog(spark, sf_dir):
    """The labels that some recording can have, with how many can."""
    support = catalog.support_matrix(_facts(spark, sf_dir))
    return rounded(support.groupBy("label").agg(F.array_join(F.first("modalities"), ",").alias("modalities"), F.count_if("supported").alias("recordings")))


def l2_support_matrix(spark, sf_dir):
    support = catalog.support_matrix(_facts(spark, sf_dir))
    return rounded(support.select("dataset", "label", "supported", F.array_join("missing", ",").alias("missing")))


def l3_selected_labels(spark, sf_dir):
    """Of audio and text labels on turns, text and timing those that each recording supports."""
    chosen = catalog.select_labels(["turns.*", "text.*", "timing.*", "next_speaker.next_speaker"], ["audio", "text"]).names
    support = catalog.support_matrix(_facts(spark, sf_dir), [x for x in catalog.LABELS if x.name in chosen])
    return rounded(support.filter("supported").select("dataset", "label"))


def l6_modality_counts(spark, sf_dir):
    support = catalog.support_matrix(_facts(spark, sf_dir))
    return rounded(catalog.modality_counts(support, _made(support)))


QUERIES = {k: v for k, v in list(globals().items()) if k[:1] == "l" and k.split("_")[0][1:].isdigit()}

part("fct", "ann", """SELECT DISTINCT recording_id AS dataset, CASE kind WHEN 'click' THEN 'speech' WHEN 'signup' THEN CASE WHEN event_id % 2 = 1 THEN 'words' ELSE 'transcript' END WHEN 'purchase' THEN CASE WHEN event_id % 2 = 1 THEN 'social.looking' ELSE 'social.talking' END
  WHEN 'view' THEN CASE WHEN event_id % 2 = 1 THEN 'face_tracks' ELSE 'media.video' END ELSE CASE WHEN value > 30 THEN 'media.audio' WHEN event_id % 2 = 1 THEN 'meta.host' ELSE 'meta.background' END END AS fact FROM ann""")
part("lab", "", "SELECT * FROM (VALUES " + ", ".join(f"('{x.name}', CAST({list(x.modalities)} AS VARCHAR[]), CAST({list(x.requires)} AS VARCHAR[]))" for x in catalog.LABELS) + ") t(label, modalities, requires)")
part("sup", "fct lab", "SELECT dataset, label, modalities, list_sort(list_filter(requires, lambda r: NOT list_contains(has, r))) AS missing FROM (SELECT dataset, list(fact) AS has FROM fct GROUP BY 1), lab")
ORACLE_SQL = {
    "l1_catalog": sql("sup", "SELECT label, any_value(array_to_string(modalities, ',')) AS modalities, count(*) FILTER (WHERE len(missing) = 0) AS recordings FROM sup GROUP BY 1"),
    "l2_support_matrix": sql("sup", "SELECT dataset, label, len(missing) = 0 AS supported, array_to_string(missing, ',') AS missing FROM sup"),
    "l3_selected_labels": sql("sup", "SELECT dataset, label FROM sup WHERE len(missing) = 0 AND (split_part(label, '.', 1) IN ('turns', 'text', 'timing') OR label = 'next_speaker.next_speaker')"),
    "l6_modality_counts": sql("sup", "SELECT dataset, m AS modality, count(*) AS registered, count(*) FILTER (WHERE ok) AS supported, count(*) FILTER (WHERE ok AND length(label) % 2 = 0) AS materialized FROM (SELECT dataset, label, len(missing) = 0 AS ok, unnest(modalities) AS m FROM sup) GROUP BY 1, 2"),
}
