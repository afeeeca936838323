"""Canonical conversation facts from an event table: a recording is an hour of one group of users, participants are event types.

So recordings grow in number with the time and the users that a table covers, and stay of one size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR_S = 3600.0
#: Users whose events are one recording.
GROUP_USERS = 500
WEARER = "click"
PARTICIPANTS = ("click", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds_of_hour(ts: Column) -> Column:
    """Seconds since the full hour with microseconds, whatever the session's time zone."""
    local = ts.cast("timestamp_ntz")
    micros = (F.minute(local) * 60).cast("long") * 1_000_000 + (F.date_part(F.lit("SECOND"), local) * 1_000_000).cast("long")
    return micros.cast("double") / F.lit(1e6)


def group() -> Column:
    return F.floor(F.coalesce("user_id", F.lit(0)) / GROUP_USERS).cast("string")


def recording() -> Column:
    """The hour and the group of users, as in 2024-01-31-23/0."""
    return F.concat_ws("/", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd-HH"), group())


def annotations(events: DataFrame) -> DataFrame:
    """(recording_id, kind, start_s, end_s, event_id, value): each event as an interval of `value` seconds."""
    start = seconds_of_hour(F.col("ts"))
    return events.select(recording().alias("recording_id"), F.col("event_type").alias("kind"), start.alias("start_s"), (start + F.col("value")).alias("end_s"), "event_id", "value")


def speech(events: DataFrame) -> DataFrame:
    rows = annotations(events).filter("kind <> 'error'")
    return rows.select("recording_id", F.col("kind").alias("participant_id"), "start_s", "end_s", F.concat_ws("#", "kind", F.col("event_id").cast("string")).alias("annotation_id"))


def unknown(events: DataFrame) -> DataFrame:
    """Regions without trusted annotation; they hold for everyone."""
    rows = annotations(events).filter("kind = 'error'")
    return rows.select("recording_id", F.lit(None).cast("string").alias("participant_id"), "start_s", "end_s", F.concat_ws("#", "kind", F.col("event_id").cast("string")).alias("annotation_id"))


def recordings(events: DataFrame) -> DataFrame:
    hours = events.select(recording().alias("recording_id"), F.weekofyear(F.col("ts").cast("timestamp_ntz")).alias("week"), group().alias("group")).distinct()
    return hours.select(
        F.lit("events").alias("dataset"),
        "recording_id",
        F.concat(F.lit("week-"), F.col("week").cast("string"), F.lit("/"), F.col("group")).alias("conversation_id"),
        F.col("recording_id").alias("view_id"),
        F.lit(WEARER).alias("wearer_id"),
        F.lit(0.0).alias("start_s"),
        F.lit(HOUR_S).alias("end_s"),
    )


def participants(events: DataFrame) -> DataFrame:
    ids = F.explode(F.array(*(F.lit(p) for p in PARTICIPANTS)))
    out = recordings(events).select("recording_id", ids.alias("participant_id"))
    return out.withColumn("is_wearer", F.col("participant_id") == WEARER).withColumn("resolved", F.lit(True))
