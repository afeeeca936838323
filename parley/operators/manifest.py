"""Media of recordings: what their audio covers, what it leaves UNKNOWN, portable manifests, and agreement between layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.intervals import clip
from parley.operators.state import SPEAKING, UNKNOWN

#: Why time without audio is UNKNOWN.
MISSING, UNPROBED, UNCOVERED, DROPOUT = "media_missing", "media_unprobed", "media_uncovered", "media_audio_dropout"
#: Fixed value: why a recording has no media where nothing else is known.
NOT_RETURNED = "not_returned_by_adapter"


def stem(path: Column) -> Column:
    """A path's file name without its last ending."""
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def frame_offset(start_frame: Column, clip_frame: Column, fps: float = 30.0) -> Column:
    """Seconds from a clip's own zero to that of the media it was cut from."""
    return (start_frame - clip_frame) / F.lit(fps)


def media_coverage(probes: DataFrame) -> DataFrame:
    """(media_key, probe_ok, audio_start_s, audio_end_s) by file stem; not ok and without times if any of them is missing.

    Of several files with one stem the last by path counts.
    """
    rows = probes.groupBy(stem(F.col("relative_path")).alias("media_key")).agg(F.max_by(F.struct("probe_ok", "audio_start_s", "audio_duration_s"), "relative_path").alias("m"))
    usable = F.coalesce(F.col("m.probe_ok"), F.lit(False)) & F.col("m.audio_start_s").isNotNull() & F.col("m.audio_duration_s").isNotNull()
    return rows.select(
        "media_key", usable.alias("probe_ok"), F.when(usable, F.col("m.audio_start_s")).alias("audio_start_s"), F.when(usable, F.col("m.audio_start_s") + F.col("m.audio_duration_s")).alias("audio_end_s")
    )


def _region(low: Column, high: Column, why: Column) -> Column:
    return F.struct(low.alias("start_s"), high.alias("end_s"), why.alias("annotation_id"))


def uncovered(recordings: DataFrame, coverage: DataFrame) -> DataFrame:
    """(recording_id, participant_id, start_s, end_s, annotation_id): time of each recording that its media's audio doesn't cover.

    Recordings have media_key and media_offset_s: media time is recording time plus the offset. All is uncovered where
    media are missing or couldn't be probed. Regions hold for everyone.
    """
    met = recordings.join(coverage, "media_key", "left")
    start, end = F.col("start_s"), F.col("end_s")
    opens, closes = F.col("audio_start_s") - F.col("media_offset_s"), F.col("audio_end_s") - F.col("media_offset_s")
    whole = F.when(F.col("probe_ok").isNull(), MISSING).when(~F.col("probe_ok"), UNPROBED)
    head = F.when(opens > start, _region(start, F.least(opens, end), F.lit(UNCOVERED)))
    tail = F.when(closes < end, _region(F.greatest(closes, start), end, F.lit(UNCOVERED)))
    regions = F.when(whole.isNotNull(), F.array(_region(start, end, whole))).otherwise(F.array_compact(F.array(head, tail)))
    rows = met.select("recording_id", F.lit(None).cast("string").alias("participant_id"), F.explode(regions).alias("r"))
    return rows.select("recording_id", "participant_id", "r.*").filter("end_s > start_s")


def dropped_out(recordings: DataFrame, dropouts: DataFrame) -> DataFrame:
    """The part of each dropout (media_key, start_s, end_s in media time) that lies in a recording, in recording time, as UNKNOWN for everyone."""
    window = recordings.select("recording_id", "media_key", "media_offset_s", F.col("start_s").alias("_low"), F.col("end_s").alias("_high"))
    met = dropouts.select("media_key", "start_s", "end_s").join(window, "media_key")
    met = met.withColumn("start_s", F.col("start_s") - F.col("media_offset_s")).withColumn("end_s", F.col("end_s") - F.col("media_offset_s"))
    cut = clip(met, F.col("_low"), F.col("_high"))
    return cut.select("recording_id", F.lit(None).cast("string").alias("participant_id"), "start_s", "end_s", F.lit(DROPOUT).alias("annotation_id"))


def unmeasured(coverage: DataFrame, measured: DataFrame) -> DataFrame:
    """Probed media without a measured packet timeline: where there are any, dropouts of a timeline can't be declared complete."""
    return coverage.filter("probe_ok").select("media_key").join(measured.select("media_key"), "media_key", "left_anti")


def corpus_path(raw: DataFrame) -> DataFrame:
    """(dataset, relative_path) rows with the corpus directory and the path below it; both null, and `below` false, unless the first folder is the dataset in any case."""
    parts = F.filter(F.split("relative_path", "/"), lambda p: (p != "") & (p != "."))
    below = F.coalesce((F.size(parts) > 1) & (F.lower(parts[0]) == F.col("dataset")) & ~F.startswith("relative_path", F.lit("/")), F.lit(False))
    return raw.withColumn("directory", F.when(below, parts[0])).withColumn("path", F.when(below, F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "/"))).withColumn("below", below)


def portable(path: Column) -> Column:
    """Whether a path is relative, non-empty, with forward slashes, without a drive or home, and never climbs."""
    return (path != "") & (path == F.trim(path)) & ~path.contains("\\") & ~path.rlike(r"^(~|.:|/)") & ~path.rlike(r"(^|/)\.\.(/|$)")


def manifest_violations(manifest: DataFrame, known: DataFrame, examples: int = 5) -> DataFrame:
    """(rule, rows, examples): every rule that manifest rows break, with the first recordings that do.

    Rules: null or blank ids, neither path, repeated (dataset, recording_id), paths that aren't portable, no offset, and
    recordings that the canonical data (`known`: dataset, recording_id) lack.
    """
    def blank(name: str) -> Column:
        return F.coalesce(F.trim(name) == "", F.lit(True))

    key = ["dataset", "recording_id"]
    copies = manifest.groupBy(*key).agg(F.count("*").alias("_copies"))
    rows = manifest.join(copies.select(*(F.col(k).alias(f"_{k}") for k in key), "_copies"), F.col("dataset").eqNullSafe(F.col("_dataset")) & F.col("recording_id").eqNullSafe(F.col("_recording_id")), "left")
    rows = rows.join(known.select(*key, F.lit(True).alias("_known")).distinct(), key, "left")
    rules = {
        "null_dataset": blank("dataset"),
        "null_recording_id": blank("recording_id"),
        "no_media": F.col("video_path").isNull() & F.col("audio_path").isNull(),
        "ambiguous_mapping": F.col("_copies") > 1,
        "video_path_not_portable": ~portable(F.col("video_path")),
        "audio_path_not_portable": ~portable(F.col("audio_path")),
        "null_offset": F.col("media_offset_s").isNull(),
        "unknown_recording": F.col("_known").isNull(),
    }
    broken = rows.select(F.col("recording_id").alias("id"), F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())))).alias("rule"))
    # Rows are counted per id first, and of the distinct ids only the least few of each rule are kept.
    counts = broken.groupBy("rule", "id").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_r", F.row_number().over(Window.partitionBy("rule").orderBy(F.col("id").asc_nulls_last())))
    return ranked.groupBy("rule").agg(F.sum("n").alias("rows"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("_r") <= examples, F.col("id")))), ",").alias("examples"))


def manifest_coverage(manifest: DataFrame, canonical: DataFrame, reasons: DataFrame, grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of counts with a verdict, and (reason, recordings) of recordings of the canonical data without media.

    It fails if one of these has valid slots in the grid: the grid then claims what no media can back.
    """
    names = canonical.select("recording_id").distinct()
    video, audio, inside = F.col("video_path").isNotNull(), F.col("audio_path").isNotNull(), F.coalesce(F.col("video_has_audio"), F.lit(False))
    counts = manifest.agg(
        F.count("*").alias("in_manifest"), F.count_if(video).alias("video"), F.count_if(audio).alias("audio"), F.count_if(video & ~audio).alias("video_only"), F.count_if(~video & audio).alias("audio_only"),
        F.count_if(video & audio).alias("both"), F.count_if(inside).alias("embedded_audio"), F.count_if(~audio & ~inside).alias("without_usable_audio"),
    )
    valid = grid.groupBy("recording_id").agg(F.count_if("action_valid").alias("_valid"))
    missing = names.join(manifest.select("recording_id"), "recording_id", "left_anti").join(valid, "recording_id", "left").join(reasons.select("recording_id", "reason"), "recording_id", "left")
    left = missing.agg(F.count("*").alias("unresolved"), F.count_if(F.col("_valid") > 0).alias("unresolved_with_valid_slots"))
    out = counts.crossJoin(names.agg(F.count("*").alias("in_grid"))).crossJoin(left)  # one row each
    verdict = F.when(F.col("unresolved_with_valid_slots") > 0, "FAIL").otherwise("PASS")
    return out.withColumn("status", verdict), missing.groupBy(F.coalesce("reason", F.lit(NOT_RETURNED)).alias("reason")).agg(F.count("*").alias("recordings"))


def layer_agreement(states: DataFrame, native: DataFrame, tolerance_s: float = 1e-6) -> DataFrame:
    """(recording_id, seconds of both layers, agrees): the wearer's SPEAKING and UNKNOWN seconds in the pieces against the native timeline; a recording that either lacks doesn't agree."""
    def seconds(rows: DataFrame, name: str) -> DataFrame:
        length = F.col("end_s") - F.col("start_s")
        return rows.groupBy("recording_id").agg(*(F.coalesce(F.sum(F.when(F.col("state") == s, length)), F.lit(0.0)).alias(f"{name}_{s.lower()}_s") for s in (SPEAKING, UNKNOWN)))

    met = seconds(states.filter("participant_index = 0"), "label").join(seconds(native, "native"), "recording_id", "full_outer")
    near = [F.coalesce(F.abs(F.col(f"label_{s}_s") - F.col(f"native_{s}_s")) <= tolerance_s, F.lit(False)) for s in ("speaking", "unknown")]
    return met.withColumn("agrees", near[0] & near[1])
