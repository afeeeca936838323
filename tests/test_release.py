"""Nested releases: every collection becomes a table."""

import json

from parley.operators import media as md

SEGMENTS = "segments array<struct<start_s double, end_s double>>"
SOCIAL = "array<struct<start_time double, end_time double, person string, target string, is_at_me boolean>>"
PATHS = "tracking_paths array<struct<track_id string, suspect boolean, track array<struct<x double, y double, frame long>>>>"
CLIP = f"""clip_id long, valid boolean, persons array<struct<person_id long, camera_wearer boolean, {SEGMENTS}, {PATHS}>>, missing_voice_segments array<struct<person string, start_time double, end_time double>>,
 transcriptions array<struct<transcription string, person_id string>>, social_segments_talking {SOCIAL}, social_segments_looking {SOCIAL}"""


def tables(spark, clips, clip):
    from pyspark.sql import functions as F

    schema = f"videos array<struct<video_id long, split string, clips array<struct<{clip}>>>>"
    rows = spark.createDataFrame([(json.dumps({"videos": [{"video_id": 1, "split": "train", "clips": clips}]}),)], "j string")
    return {k: [r.asDict() for r in v.collect()] for k, v in md.release_to_tables(rows.select(F.from_json("j", schema).alias("r")).select("r.*")).items()}


def test_a_release_gives_nine_tables(spark):
    social = {"start_time": 0, "end_time": 1, "person": "2", "target": "0", "is_at_me": True}
    track = [{"x": 1, "y": 2, "frame": 7}, {"x": 3, "y": 4, "frame": 8}]
    person = {"person_id": 2, "camera_wearer": False, "segments": [{"start_s": 0, "end_s": 1}], "tracking_paths": [{"track_id": "t", "suspect": True, "track": track}, {"track_id": "u"}]}
    full = {"clip_id": 5, "valid": True, "persons": [person], "missing_voice_segments": [{"person": "2", "start_time": 3, "end_time": 4}], "transcriptions": [{"transcription": "hi", "person_id": "2"}]}
    full |= {"social_segments_talking": [social], "social_segments_looking": [social, social]}
    out = tables(spark, [full, {"clip_id": 6, "persons": None}], CLIP)
    counts = {"clips": 2, "persons": 1, "segments": 1, "missing_voice_segments": 1, "transcriptions": 1, "social_segments_talking": 1, "social_segments_looking": 2, "tracking_paths": 2, "tracks": 2}
    assert {k: len(v) for k, v in out.items()} == counts
    assert out["missing_voice_segments"] == [{"clip_id": 5, "person_id": "2", "start_time": 3.0, "end_time": 4.0}]
    assert out["transcriptions"][0]["transcription"] == "hi" and out["social_segments_talking"][0]["target"] == "0" and out["persons"][0]["is_camera_wearer"] is False
    assert [(r["clip_id"], r["person_id"], r["track_id"], r["x"], r["clip_frame"], r["width"]) for r in out["tracks"]] == [(5, 2, "t", 1.0, 7, None), (5, 2, "t", 3.0, 8, None)]


def test_absent_collections_are_empty(spark):
    out = tables(spark, [{"clip_id": 5, "persons": [{"person_id": 2, "segments": [{"start_s": 0, "end_s": 1}]}]}], f"clip_id long, persons array<struct<person_id long, {SEGMENTS}>>")
    assert len(out) == 9 and {k for k, v in out.items() if v} == {"clips", "persons", "segments"}
    assert list(out["segments"][0]) == ["clip_id", "person_id", "place", "start_s", "end_s"]
