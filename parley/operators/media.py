"""Media tables: inventory, probe payloads, alignment checks, manifests, packet events in context; social facts and tracks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.ranks import with_quantiles
from parley.operators.state import EPS, SPEAKING

#: File extensions by type, and names that are never listed.
FILE_TYPES = {"mp4": "video", "mov": "video", "mkv": "video", "avi": "video", "wav": "audio", "flac": "audio", "mp3": "audio", "m4a": "audio", "csv": "tabular", "parquet": "tabular", "json": "structured_data"}
SKIPPED = r"(^|/)(\.DS_Store|Thumbs\.db|\._[^/]*|__MACOSX(/.*)?)$"

#: Fixed format: the parts of a probe payload that are read.
PROBE = "streams ARRAY<STRUCT<codec_type: STRING, codec_name: STRING, avg_frame_rate: STRING, start_time: STRING, duration: STRING>>, format STRUCT<duration: STRING>"


def list_files(spark: SparkSession, root: str, checksum: bool = False) -> DataFrame:
    """(path, size, sha256) of all files below a folder, paths from there on; contents are read only if a checksum is asked for.

    Each file is hashed in the task that reads it, and only the digest leaves it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    digest = F.sha2("content", 256) if checksum else F.lit(None).cast("string")
    below = F.regexp_replace("path", F.lit("^.*?" + re.escape(root.split(":", 1)[-1].strip("/")) + "/"), F.lit(""))
    return files.select(below.alias("path"), F.col("length").alias("size"), digest.alias("sha256"))


def inventory(files: DataFrame) -> DataFrame:
    """(dataset, relative_path, file_type, size) of listed files, and their sha256 if it was listed: the first folder, lower case, is the dataset."""
    kept = files.filter(~F.col("path").rlike(SKIPPED) & (F.col("path") != "") & (F.col("size") >= 0))
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    kind = F.coalesce(F.create_map(*(F.lit(x) for pair in FILE_TYPES.items() for x in pair))[extension], F.lit("other"))
    return kept.select(F.lower(F.split_part("path", F.lit("/"), F.lit(1))).alias("dataset"), F.col("path").alias("relative_path"), kind.alias("file_type"), "size", *(["sha256"] if "sha256" in files.columns else [])).dropDuplicates(["dataset", "relative_path"])


def inventory_summary(files: DataFrame) -> DataFrame:
    return files.groupBy("dataset", "file_type").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def _rate(text: Column) -> Column:
    parts = F.split(text, "/")
    low = F.try_element_at(parts, F.lit(2)).cast("double")
    return F.when(low.isNull(), parts[0].cast("double")).when(low != 0, parts[0].cast("double") / low)


def probe_table(payloads: DataFrame) -> DataFrame:
    """One row per payload (relative_path, payload): first video and audio stream, frame rate, starts and durations; a payload that can't be read is not ok."""
    parsed = payloads.withColumn("_p", F.from_json("payload", PROBE))

    def of_kind(kind: str) -> Column:
        return F.filter("_p.streams", lambda s: s["codec_type"] == kind)

    first = {k: F.try_element_at(of_kind(k), F.lit(1)) for k in ("video", "audio")}
    out = [F.col("relative_path"), F.col("_p.streams").isNotNull().alias("probe_ok")]
    for kind, stream in first.items():
        out.append(F.greatest(F.coalesce(F.size(of_kind(kind)), F.lit(0)), F.lit(0)).alias(f"{kind}_streams"))
        out += [stream["start_time"].cast("double").alias(f"{kind}_start_s"), stream["duration"].cast("double").alias(f"{kind}_duration_s")]
    return parsed.select(*out, _rate(first["video"]["avg_frame_rate"]).alias("frame_rate"))


def quality_flags(probes: DataFrame) -> DataFrame:
    """Probe ok, has video, has audio, positive durations; and whether all pass."""
    flags = {"has_video": F.col("video_streams") > 0, "has_audio": F.col("audio_streams") > 0, "positive_durations": F.coalesce((F.col("video_duration_s") > 0) & (F.col("audio_duration_s") > 0), F.lit(False))}
    out = probes.withColumns(flags)
    return out.withColumn("passed", F.col("probe_ok") & F.col("has_video") & F.col("has_audio") & F.col("positive_durations"))


def alignment(probes: DataFrame) -> DataFrame:
    """Audio less video: start, duration and end, and the size of the last."""
    end = {k: F.col(f"{k}_start_s") + F.col(f"{k}_duration_s") for k in ("audio", "video")}
    out = probes.withColumn("start_offset_s", F.col("audio_start_s") - F.col("video_start_s")).withColumn("duration_delta_s", F.col("audio_duration_s") - F.col("video_duration_s"))
    out = out.withColumn("audio_end_s", end["audio"]).withColumn("video_end_s", end["video"]).withColumn("end_delta_s", end["audio"] - end["video"])
    return out.withColumn("abs_end_delta_s", F.abs("end_delta_s"))


def alignment_summary(aligned: DataFrame, by: str) -> DataFrame:
    """Per group: files that start together, files with an end difference, and its least, median and greatest value."""
    counts = aligned.groupBy(by).agg(F.count_if(F.col("start_offset_s") == 0).alias("zero_offsets"), F.count("end_delta_s").alias("n"))
    out = with_quantiles(counts, aligned.select(by, F.col("end_delta_s").alias("_q")), [by], ["_q"], (0.0, 0.5, 1.0))
    return out.select(by, "zero_offsets", "n", *(F.col("_q")[k].alias(x) for k, x in enumerate(("least", "median", "most"))))


def resolve_media(recordings: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Each recording's video and audio path by file stem; `ambiguous` where a stem has several files of one kind, and then no path."""
    stem = F.regexp_extract("relative_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    found = files.filter(F.col("file_type").isin("video", "audio")).groupBy(stem.alias("_stem"), "file_type").agg(F.count("*").alias("n"), F.min("relative_path").alias("path"))
    wide = found.groupBy("_stem").pivot("file_type", ["video", "audio"]).agg(F.first("n").alias("n"), F.first("path").alias("path"))
    out = recordings.join(wide, F.col(key).cast("string") == F.col("_stem"), "left")
    clash = (F.coalesce("video_n", F.lit(0)) > 1) | (F.coalesce("audio_n", F.lit(0)) > 1)
    return out.select(*recordings.columns, F.when(~clash, F.col("video_path")).alias("video_path"), F.when(~clash, F.col("audio_path")).alias("audio_path"), clash.alias("ambiguous"))


def interpret_events(events: DataFrame, *, rate: float, reference: float, skip_samples: int, period_s: float, tolerance_packets: float) -> DataFrame:
    """Events (time_s, end_s, kind of `episode`, `dropout` or `packet`, category) relabelled by where they lie.

    An episode or dropout within the priming of the codec is its boundary, whatever else it is. Else an episode near a
    whole multiple of the period, the first one at least, is a stitch. Multiples are rounded half to even.
    """
    early_s = (skip_samples + 2 * reference) / rate
    index = F.greatest(F.lit(1.0), F.bround(F.col("time_s") / F.lit(period_s)))
    distance = F.abs(F.col("time_s") - index * F.lit(period_s))
    near = distance <= F.lit(tolerance_packets * reference / rate)
    early = F.col("time_s").between(0, early_s)
    codec = F.col("kind").isin("episode", "dropout") & early & (F.col("end_s") <= early_s) & F.lit(skip_samples > 0)
    category = F.when(codec, "codec_boundary").when((F.col("kind") == "episode") & near, "stitch").otherwise(F.col("category"))
    return events.select("stream", "time_s", "kind", category.alias("category"), index.cast("long").alias("boundary_index"), distance.alias("distance_s"), near.alias("near_boundary"), early.alias("early"))


def drift_flags(metrics: DataFrame, fps: float) -> DataFrame:
    """Whether the final drift passes 1 ms, half a frame, 100 ms and 500 ms, strictly."""
    size = F.abs("final_drift_ms")
    return metrics.select("stream", size.alias("abs_final_drift_ms"), (size > 1).alias("over_1_ms"), (size > 500 / fps).alias("over_half_frame"), (size > 100).alias("over_100_ms"), (size > 500).alias("over_500_ms"))


def decoded_continuity(frames: DataFrame) -> DataFrame:
    """Per stream of decoded frames: gaps between a frame's end and the next one's start, span, and a verdict."""
    order = Window.partitionBy("stream").orderBy("pts")
    gap = F.lead("pts").over(order) - F.col("pts") - F.col("nb_samples")
    rows = frames.filter("pts IS NOT NULL AND nb_samples IS NOT NULL").withColumn("_gap", gap)
    out = rows.groupBy("stream").agg(F.count("*").alias("frames"), F.count_if(F.col("_gap") != 0).alias("breaks"), F.coalesce(F.max(F.abs("_gap")), F.lit(0)).alias("max_gap"), F.min("pts").alias("first_pts"), F.max(F.col("pts") + F.col("nb_samples")).alias("end_pts"))
    return out.withColumn("verdict", F.when(F.col("frames") < 2, "insufficient_data").when(F.col("breaks") > 0, "gap_or_overlap").otherwise("continuous"))


def dropout_intervals(steps: DataFrame, rate: float, least_s: float) -> DataFrame:
    """[time - length, time) of each dropout of `least_s` or more."""
    length = F.col("error") / F.lit(rate)
    end = F.col("next_pts") / F.lit(rate)
    rows = steps.filter("persistent").filter(length >= least_s)
    return rows.select("stream", (end - length).alias("start_s"), end.alias("end_s"))


_FRAMES = "start_frame long, end_frame long, video_start_time double, video_end_time double, video_start_frame long, video_end_frame long"
#: The collections of a release besides persons and segments, with the columns that are kept; what a release lacks is null.
_COLLECTIONS = {
    "missing_voice_segments": "person string, start_time double, end_time double",
    "transcriptions": "transcription string, start_time_sec double, end_time_sec double, person_id string, video_start_time double, video_start_frame long, video_end_time double, video_end_frame long",
    "social_segments_talking": f"start_time double, end_time double, {_FRAMES}, person string, target string, is_at_me boolean",
    "social_segments_looking": f"start_time double, end_time double, {_FRAMES}, person string, target string, is_at_me boolean",
    "tracking_paths": "track_id string, unmapped_frames_count long, unmapped_frames array<long>, suspect boolean",
    "track": "x double, y double, width double, height double, video_frame long, frame long",
}
_RENAMED = {("missing_voice_segments", "person"): "person_id", ("track", "frame"): "clip_frame"}


def _fields(rows: DataFrame, column: str) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in rows.schema[column].dataType.fields}


def _entries(rows: DataFrame, column: str, name: str, keys: Sequence[str]) -> DataFrame:
    """`keys` and the columns of each entry of the collection `name` in the struct `column`, as the release types them."""
    declared = T.StructType.fromDDL(_COLLECTIONS[name])
    given = name in _fields(rows, column)
    items = F.col(column)[name] if given else F.lit(None).cast(T.ArrayType(declared))
    found = rows.select(*keys, F.explode(items).alias("_e"))
    held = _fields(found, "_e")
    return found.select(*keys, *((F.col("_e")[f.name] if f.name in held else F.lit(None).cast(f.dataType)).alias(_RENAMED.get((name, f.name), f.name)) for f in declared))


def release_to_tables(release: DataFrame) -> dict[str, DataFrame]:
    """The nine tables of nested videos > clips > persons > (segments, tracking_paths > track) and of the lists of each clip.

    A null or absent collection is empty. An entry's `person` is person_id in missing_voice_segments, a point's `frame`
    is clip_frame; single values of clips, persons and segments besides those named below stay as they are.
    """
    clips = release.select(F.explode("videos").alias("v")).select("v.video_id", "v.split", F.explode("v.clips").alias("c"))
    of_clip = clips.select("video_id", "c.clip_id", "c")
    persons = of_clip.select("video_id", "clip_id", F.explode("c.persons").alias("p")).select("video_id", "clip_id", "p.person_id", "p")
    segments = persons.select("clip_id", "person_id", F.posexplode("p.segments").alias("place", "s"))

    def others(rows: DataFrame, column: str, *taken: str) -> list[Column]:
        return [F.col(column)[f].alias({"camera_wearer": "is_camera_wearer"}.get(f, f)) for f, kind in _fields(rows, column).items() if f not in taken and not isinstance(kind, T.ArrayType)]

    out = {
        "clips": clips.select("video_id", "split", "c.clip_id", *others(clips, "c", "clip_id", "video_id", "split")),
        "persons": persons.select("clip_id", "person_id", *others(persons, "p", "person_id")),
        "segments": segments.select("clip_id", "person_id", "place", "s.start_s", "s.end_s", *others(segments, "s", "start_s", "end_s", "person")),
    }
    for name in ("missing_voice_segments", "transcriptions", "social_segments_talking", "social_segments_looking"):
        out[name] = _entries(of_clip, "c", name, ["clip_id"])
    paths = ["clip_id", "person_id"]
    out["tracking_paths"] = _entries(persons, "p", "tracking_paths", paths)
    if "tracking_paths" in _fields(persons, "p"):
        tracks = persons.select(*paths, F.explode("p.tracking_paths").alias("t")).select(*paths, "t.track_id", "t")
    else:
        tracks = _entries(persons, "p", "tracking_paths", paths).select(*paths, "track_id", F.struct("track_id").alias("t"))
    out["tracks"] = _entries(tracks, "t", "track", [*paths, "track_id"])
    return out


def box_means(tracks: DataFrame, step_s: float) -> DataFrame:
    """Mean face box per cell and participant."""
    cell = F.floor((F.col("time_s") + F.lit(EPS)) / F.lit(step_s)).cast("long")
    return tracks.groupBy("recording_id", "participant_id", cell.alias("decision_index")).agg(*(F.avg(c).alias(c) for c in ("x", "y", "width", "height")), F.count("*").alias("boxes"))


def track_summary(tracks: DataFrame, fps: float) -> DataFrame:
    """Per face track: first and last frame, boxes, start, and end one frame after the last."""
    return tracks.groupBy("recording_id", "participant_id", "track_id").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.count("*").alias("boxes"), F.min("time_s").alias("start_s"), (F.max("time_s") + F.lit(1 / fps)).alias("end_s"))


def social_segments(social: DataFrame, participants: DataFrame) -> DataFrame:
    """Segments numbered per recording by start, kind, person and source row, with the participant where the person is one."""
    order = Window.partitionBy("recording_id").orderBy("start_s", "kind", "person", "source_row")
    who = participants.select("recording_id", "participant_id", F.lit(True).alias("_known"))
    met = social.withColumn("segment_id", F.row_number().over(order) - 1).join(who, ["recording_id", "participant_id"], "left")
    return met.withColumn("resolved", F.coalesce("_known", F.lit(False))).withColumn("participant_id", F.when(F.col("_known"), F.col("participant_id"))).drop("_known")


#: What a participant may do in a unit, one bit each.
_SOCIAL = {name: 1 << i for i, name in enumerate(("looking_any", "looking_yes", "looking_no", "talking_any", "talking_yes", "talking_no", "speaking", "tracked", "hidden"))}


def social_units(units: DataFrame, people: DataFrame, social: DataFrame, tracks: DataFrame, states: DataFrame, unknown: DataFrame, width_s: float) -> DataFrame:
    """Every unit with what each participant does to the wearer in it, as arrays in the order of participants, and whether anyone does.

    `units` are (recording_id, unit) of `width_s` seconds, `people` (recording_id, participant_id, participant_index), `states` of
    `structure.participant_states`, `unknown` the recording's own unknown intervals. A participant looks at the wearer where a
    positive segment lies, doesn't where its face is tracked or a negative one lies, and else is unknown; it talks to the wearer by segments alone.
    Anyone does if one does; nobody does if somebody is concerned (tracked or in a segment; for talking, speaking or
    in a segment) and all of those are known not to. Where the recording is hidden for longer than EPS, everything is
    null. Segments and boxes of nobody in particular take no part.
    """
    # Everything is dealt by recording before it is spread over units; a fixed number of partitions isn't coalesced.
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["recording_id", "participant_id", "participant_index", "mark", "start_s", "end_s"]
    nobody, nowhere = F.lit(None).cast("int").alias("participant_index"), F.lit(None).cast("string").alias("participant_id")
    said = F.when(F.col("is_at_me"), "yes").when(~F.col("is_at_me"), "no")
    names = F.array_compact(F.array(F.concat_ws("_", "kind", F.lit("any")), F.concat(F.col("kind"), F.lit("_"), said)))
    bits = F.create_map(*(F.lit(x) for pair in _SOCIAL.items() for x in pair))
    kinds = F.explode(F.transform(names, lambda n: bits[n]))
    spans = social.filter(F.col("kind").isin("looking", "talking") & F.col("participant_id").isNotNull()).select("recording_id", "participant_id", nobody, kinds.alias("mark"), "start_s", "end_s")
    speaks = states.filter(F.col("state") == SPEAKING).select("recording_id", nowhere, F.col("participant_index").cast("int").alias("participant_index"), F.lit(_SOCIAL["speaking"]).alias("mark"), "start_s", "end_s")
    boxes = tracks.filter("participant_id IS NOT NULL").select("recording_id", "participant_id", nobody, F.lit(_SOCIAL["tracked"]).alias("mark"), F.col("time_s").alias("start_s"), F.col("time_s").alias("end_s"))
    gone = unknown.select("recording_id", nowhere, nobody, F.lit(_SOCIAL["hidden"]).alias("mark"), "start_s", "end_s")
    marks = spans.unionByName(speaks).unionByName(boxes).unionByName(gone).select(*columns).repartition(parts, "recording_id")
    who = people.groupBy("recording_id").agg(F.collect_list(F.struct("participant_id", F.col("participant_index").cast("int").alias("participant_index"))).alias("_who"))
    index = F.coalesce("participant_index", F.get(F.filter("_who", lambda p: p["participant_id"] == F.col("participant_id")), F.lit(0))["participant_index"])
    marks = marks.join(who.hint("merge"), "recording_id", "left").select("recording_id", index.alias("participant_index"), "mark", "start_s", "end_s").filter(F.col("participant_index").isNotNull() | (F.col("mark") == _SOCIAL["hidden"]))
    width, boxed = F.lit(width_s), F.floor((F.col("start_s") + F.lit(EPS)) / F.lit(width_s))
    first, last = F.floor(F.col("start_s") / width), F.ceil(F.col("end_s") / width) - 1
    tracked = F.col("mark") == _SOCIAL["tracked"]
    at = F.when(tracked, F.array(boxed)).when(F.col("end_s") > F.col("start_s"), F.sequence(first, F.greatest(first, last)))
    part = F.least("end_s", (F.col("unit") + 1) * width) - F.greatest("start_s", F.col("unit") * width)
    found = marks.select("*", F.explode(at).alias("unit")).groupBy("recording_id", "unit", "participant_index", "mark").agg(F.sum(F.greatest(F.lit(0.0), part)).alias("_seconds"))
    found = found.filter(tracked | (F.col("_seconds") > EPS)).groupBy("recording_id", "unit", "participant_index").agg(F.bit_or("mark").alias("marks"))
    each_one = F.when(F.col("participant_index").isNotNull(), F.struct("participant_index", "marks"))
    found = found.groupBy("recording_id", "unit").agg(F.map_from_entries(F.collect_list(each_one)).alias("_marks"), F.bool_or(F.col("participant_index").isNull()).alias("_hidden"))
    size = people.groupBy("recording_id").agg(F.count("*").cast("int").alias("_people"))
    lattice = units.join(size, "recording_id").join(found, ["recording_id", "unit"], "left")
    each = F.when(F.col("_people") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("_people") - 1, F.lit(0))), lambda p: F.coalesce(F.try_element_at("_marks", p), F.lit(0))))
    lattice = lattice.withColumn("_each", each).withColumn("_shown", ~F.coalesce("_hidden", F.lit(False)))

    def has(m: Column, mark: str) -> Column:
        return m.bitwiseAND(F.lit(_SOCIAL[mark])) != 0

    def known(kind: str, m: Column) -> Column:
        seen = has(m, f"{kind}_yes") | has(m, f"{kind}_no")
        return seen | has(m, "tracked") if kind == "looking" else seen

    def concerned(kind: str, m: Column) -> Column:
        return has(m, f"{kind}_any") | has(m, "tracked" if kind == "looking" else "speaking")

    def own(kind: str) -> Column:
        return F.transform("_each", lambda m: F.when(F.col("_shown") & known(kind, m), has(m, f"{kind}_yes")))

    def anyone(kind: str) -> Column:
        yes = F.exists("_each", lambda m: has(m, f"{kind}_yes"))
        no = F.exists("_each", lambda m: concerned(kind, m)) & F.forall("_each", lambda m: ~concerned(kind, m) | (known(kind, m) & ~has(m, f"{kind}_yes")))
        return F.when(F.col("_shown") & yes, True).when(F.col("_shown") & no, False)

    return lattice.select(
        "recording_id", "unit", own("looking").alias("looking_at_wearer"), own("talking").alias("talking_to_wearer"),
        F.transform("_each", lambda m: F.when(F.col("_shown"), has(m, "tracked"))).alias("face_tracked"),
        anyone("looking").alias("anyone_looking_at_wearer"), anyone("talking").alias("anyone_talking_to_wearer"),
    )
