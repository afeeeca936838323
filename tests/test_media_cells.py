"""Media coverage, manifests, scans and cell features on known cases and against plain loops."""

import numpy as np
import pytest

from parley.operators import audit, packets, signal
from parley.operators import manifest as mf
from parley.operators import text as tx
from parley.sources import files as fl

RECORDING = "recording_id string, media_key string, media_offset_s double, start_s double, end_s double"


def test_uncovered_media(spark):
    probes = spark.createDataFrame(
        [("c/a.mp4", True, 1.0, 5.0), ("c/b.mp4", False, 0.0, 9.0), ("c/d.mp4", True, None, 9.0), ("c/e.mp4", True, 50.0, 5.0), ("c/f.mp4", True, 0.0, 99.0)],
        "relative_path string, probe_ok boolean, audio_start_s double, audio_duration_s double",
    )
    recs = spark.createDataFrame([(k, k, 0.5, 0.0, 10.0) for k in "abcdef"], RECORDING)
    got = sorted((r.recording_id, r.start_s, r.end_s, r.annotation_id) for r in mf.uncovered(recs, mf.media_coverage(probes)).collect())
    assert got == [
        ("a", 0.0, 0.5, "media_uncovered"), ("a", 5.5, 10.0, "media_uncovered"), ("b", 0.0, 10.0, "media_unprobed"), ("c", 0.0, 10.0, "media_missing"),
        ("d", 0.0, 10.0, "media_unprobed"), ("e", 0.0, 10.0, "media_uncovered"),
    ]


def test_dropouts_are_clipped_to_the_recording(spark):
    recs = spark.createDataFrame([("a", "m", 5.0, 0.0, 10.0), ("b", "m", 100.0, 0.0, 10.0)], RECORDING)
    drops = spark.createDataFrame([("m", 4.0, 6.0), ("m", 14.0, 18.0), ("m", 15.0, 15.0), ("x", 6.0, 7.0)], "media_key string, start_s double, end_s double")
    assert sorted((r.recording_id, r.start_s, r.end_s) for r in mf.dropped_out(recs, drops).collect()) == [("a", 0.0, 1.0), ("a", 9.0, 10.0)]
    measured = spark.createDataFrame([("m",)], "media_key string")
    coverage = spark.createDataFrame([("m", True), ("n", True), ("o", False)], "media_key string, probe_ok boolean")
    assert [r.media_key for r in mf.unmeasured(coverage, measured).collect()] == ["n"]


@pytest.mark.parametrize(("path", "fine"), [("a/b.mp4", True), ("", False), (" a", False), ("a\\b", False), ("~/a", False), ("C:/a", False), ("/a", False), ("../a", False), ("a/../b", False), ("a..b/c", True)])
def test_portable_paths(spark, path, fine):
    assert spark.createDataFrame([(path,)], "p string").select(mf.portable(mf.F.col("p")).alias("ok")).first().ok is fine


def test_manifest_violations(spark):
    rows = [("d", "1", "a.mp4", None, 0.0), ("d", "1", None, "a.wav", 0.0), ("d", "2", None, None, None), (None, " ", "/x.mp4", None, 1.0), ("d", "9", "b.mp4", None, 0.0)]
    manifest = spark.createDataFrame(rows, "dataset string, recording_id string, video_path string, audio_path string, media_offset_s double")
    known = spark.createDataFrame([("d", "1"), ("d", "2")], "dataset string, recording_id string")
    got = {r["rule"]: (r["rows"], r["examples"]) for r in mf.manifest_violations(manifest, known).collect()}
    assert got == {
        "ambiguous_mapping": (2, "1"), "no_media": (1, "2"), "null_offset": (1, "2"), "null_dataset": (1, " "), "null_recording_id": (1, " "),
        "video_path_not_portable": (1, " "), "unknown_recording": (2, " ,9"),
    }
    assert mf.manifest_violations(manifest.limit(0), known).count() == 0


def test_corpus_path(spark):
    rows = spark.createDataFrame([("egg", "Egg/240p/x.MP4"), ("egg", "Egg"), ("egg", "Other/x"), ("egg", "/Egg/x")], "dataset string, relative_path string")
    assert [(r.directory, r.path, r.below) for r in mf.corpus_path(rows).collect()] == [("Egg", "240p/x.MP4", True), (None, None, False), (None, None, False), (None, None, False)]


def test_scan_keeps_failures_as_rows(spark):
    items = spark.createDataFrame([(1, "4"), (2, "x"), (0, "4"), (3, None)], "n int, text string")
    got = {r.n: (r.out, r.probe_ok, (r.probe_error or "").split(":")[0]) for r in audit.population_scan(items, lambda n, text: {"out": int(text) // n}, "out bigint").collect()}
    assert got == {1: (4, True, ""), 2: (None, False, "ValueError"), 0: (None, False, "ZeroDivisionError"), 3: (None, False, "TypeError")}


def test_codec_boundary_counts_only_skips(spark):
    kind = "stream long, packet_index long, side_data_list array<struct<side_data_type:string,skip_samples:int,discard_padding:int>>"
    rows = [(1, 0, [("Skip Samples", 1024, None), ("Other", 9, 9)]), (1, 1, None), (1, 2, [("Skip Samples", 0, 300)]), (2, 0, None)]
    got = sorted(map(tuple, packets.codec_boundary(spark.createDataFrame(rows, kind)).collect()))
    assert got == [(1, 1024, 300), (2, 0, 0)]


def test_utterances_take_the_turn_they_share_most_with(spark):
    turns = spark.createDataFrame([("r", "a", 0.0, 2.0), ("r", "a", 3.0, 6.0), ("r", "a", 7.0, 9.0), ("r", "b", 0.0, 9.0)], "recording_id string, participant_id string, start_s double, end_s double")
    rows = [("r", "a", 0, 1.0, 5.0, True), ("r", "a", 1, 2.0, 3.0, True), ("r", "a", 2, 5.0, 8.0, True), ("r", "a", 3, 0.0, 1.0, False), ("r", "c", 4, 0.0, 1.0, True), ("r", "a", 5, 0.0, 9.0, True)]
    said = spark.createDataFrame(rows, "recording_id string, participant_id string, source_row int, start_s double, end_s double, timing_valid boolean")
    got = {r.source_row: (r.turn, r.shared_s) for r in tx.utterances_to_turns(said, turns).collect()}
    assert got == {0: (2, 2.0), 1: (None, 0.0), 2: (2, 1.0), 4: (None, 0.0), 5: (2, 3.0)}


def _plain(frame, before):
    """The measures pixel by pixel."""
    h, w, _ = frame.shape
    px = [[tuple(int(v) for v in frame[y, x]) for x in range(w)] for y in range(h)]
    flat = [p for row in px for p in row]
    mean = [sum(p[k] for p in flat) / len(flat) for k in range(3)]
    luma = [[0.2126 * r + 0.7152 * g + 0.0722 * b for r, g, b in row] for row in px]
    every = [v for p in flat for v in p]
    middle = sum(every) / len(every)
    contrast = (sum((v - middle) ** 2 for v in every) / len(every)) ** 0.5
    saturation = sum((max(p) - min(p)) / max(p) if max(p) else 0 for p in flat) / len(flat)
    edge = [luma[y - 1][x] + luma[y + 1][x] + luma[y][x - 1] + luma[y][x + 1] - 4 * luma[y][x] for y in range(1, h - 1) for x in range(1, w - 1)]
    blur = sum((e - sum(edge) / len(edge)) ** 2 for e in edge) / len(edge)
    bins = [tuple(v // 64 for v in p) for p in flat]
    usual = min(set(bins), key=lambda b: (-bins.count(b), b))
    gap = None if before is None else sum(abs(int(a) - int(b)) for a, b in zip(frame.ravel(), before.ravel())) / frame.size
    return [*mean, sum(map(sum, luma)) / len(flat), contrast, saturation, blur, *((u + 0.5) * 64 for u in usual), gap]


def test_frame_features_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    frames = [rng.integers(0, 256, (4, 5, 3), dtype=np.uint8) for _ in range(11)]
    frames[4][:] = 0
    rows = [("r", k, 4, 5, bytearray(f.tobytes())) for k, f in enumerate(frames) if k != 7] + [("r", 20, 4, 5, bytearray(b"short")), ("s", 0, 4, 5, None)]
    found = signal.frame_features(spark.createDataFrame(rows, "recording_id string, frame long, height int, width int, rgb binary"), chunk=3)
    got = {(r.recording_id, r.frame): [r[f] for f in signal.FRAME_FEATURES] for r in found.collect()}
    assert len(got) == len(rows)
    for k, f in enumerate(frames):
        if k != 7:
            want = _plain(f, frames[k - 1] if k not in (0, 8) else None)
            assert got["r", k] == pytest.approx(want, abs=1e-9), k
    assert got["r", 20] == got["s", 0] == [None] * 11
    cells = spark.createDataFrame([("r", k) for k in range(3)], "recording_id string, decision_index long")
    made = {r.decision_index: r for r in signal.video_cells(found.filter("frame < 20"), cells, 4).collect()}
    assert [made[k].frame_valid for k in range(3)] == [True, False, False]
    assert made[0].red == pytest.approx(np.mean([f[..., 0].mean() for f in frames[:4]])) and made[1].red is None


def test_pitch_of_cells(spark):
    rows = [("r", 0.1, 100.0, True), ("r", 0.2, 200.0, True), ("r", 0.3, 0.0, True), ("r", 0.4, float("nan"), True), ("r", 0.5, 900.0, False), ("r", 1.1, 0.0, True), ("r", 2.1, 50.0, True)]
    frames = spark.createDataFrame(rows, "recording_id string, time_s double, f0 double, mask boolean")
    cells = spark.createDataFrame([("r", 0, 0.5), ("r", 1, 0.5), ("r", 2, 0.4), ("r", 3, 1.0)], "recording_id string, decision_index long, fraction double")
    got = {r.decision_index: (r.f0_median, r.voiced_share) for r in signal.pitch_cells(frames, cells, 1.0, 0.5).collect()}
    assert got == {0: (150.0, 0.5), 1: (None, 0.0), 2: (None, None), 3: (None, None)}


def test_csv_and_json_keep_what_was_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b", c'), (2, "x\ny"), (3, None)], "id long, text string")
    rows.write.csv(str(tmp_path / "c"), header=True, quote='"', escape='"')
    assert sorted(map(tuple, fl.csv_table(spark, str(tmp_path / "c"), "id LONG, text STRING").collect())) == [(1, 'a "b", c'), (2, "x\ny"), (3, None)]
    (tmp_path / "r.json").write_text('{"videos": [\n {"id": 1},\n {"id": 2}]}')
    assert [r.id for r in fl.nested_json(spark, str(tmp_path / "r.json"), "videos ARRAY<STRUCT<id: INT>>", "videos").collect()] == [1, 2]
