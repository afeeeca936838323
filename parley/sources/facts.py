"""Label facts from annotation tables: who takes part, speech without a known speaker, and timed tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the participant that stands for speech without a speaker.
UNRESOLVED = "<unresolved>"


def participants(recordings: DataFrame, persons: DataFrame, speech: DataFrame) -> DataFrame:
    """(recording_id, participant_id, is_wearer, resolved, listed): listed persons, speakers who aren't, and one unresolved where speech names nobody."""
    key = ["recording_id", "participant_id"]
    listed = persons.select(*key).filter("participant_id IS NOT NULL").distinct().withColumn("listed", F.lit(True))
    heard = speech.select("recording_id", F.coalesce("participant_id", F.lit(UNRESOLVED)).alias("participant_id"), F.col("participant_id").isNotNull().alias("resolved")).groupBy(*key).agg(F.bool_or("resolved").alias("resolved"))
    met = listed.join(heard, key, "full_outer").join(recordings.select("recording_id", "wearer_id"), "recording_id")
    return met.select(*key, F.coalesce(F.col("participant_id") == F.col("wearer_id"), F.lit(False)).alias("is_wearer"), F.coalesce("resolved", F.lit(True)).alias("resolved"), F.coalesce("listed", F.lit(False)).alias("listed"))


def named(speech: DataFrame) -> DataFrame:
    """Speech where nobody is named given to the unresolved participant."""
    return speech.withColumn("participant_id", F.coalesce("participant_id", F.lit(UNRESOLVED)))


def tokens(rows: DataFrame, recordings: DataFrame, unit: str) -> DataFrame:
    """Transcripts of the given recordings as tokens of a unit; times that are missing or reversed are null and not valid."""
    kept = rows.join(recordings.select("recording_id"), "recording_id", "left_semi")
    timed = F.coalesce(F.col("end_s") > F.col("start_s"), F.lit(False))
    return kept.select("recording_id", "participant_id", F.lit(unit).alias("unit"), "text", F.when(timed, F.col("start_s")).alias("start_s"), F.when(timed, F.col("end_s")).alias("end_s"), timed.alias("timing_valid"), "source_row")
