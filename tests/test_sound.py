"""Measures of sound against plain loops over samples."""

import numpy as np
import pytest

from parley.operators import signal as sg
from parley.operators.state import SILENT, SPEAKING, UNKNOWN

RATE, STEP, N = 8.0, 4.0, 32


def cells(spark):
    r = np.random.default_rng(5)
    rows = [("r", k, r.normal(size=N).astype(np.float32).tolist()) for k in range(6)]
    rows[3] = ("r", 3, rows[3][2][:20])
    rows += [("r", 6, [0.0] * N), ("r", 7, None), ("r", 8, []), ("r", 9, [None, *([1.0] * (N - 1))]), ("s", 6, [-0.0 if k % 2 else 0.0 for k in range(N)]), ("s", 8, [1.0] * N), ("s", 9, [1.0] * N)]
    return rows, spark.createDataFrame(rows, "recording_id string, decision_index long, samples array<float>")


def measured(x):
    x = np.array(x, float)
    size = np.abs(np.fft.rfft(x * np.hanning(N)))
    f = np.fft.rfftfreq(N, 1 / RATE)
    total = size.sum()
    centre = sum(a * b for a, b in zip(size, f, strict=True)) / total if total else None
    width = np.sqrt(sum(a * (b - centre) ** 2 for a, b in zip(size, f, strict=True)) / total) if total else None
    crossings = sum(np.signbit(a) != np.signbit(b) for a, b in zip(x, x[1:])) / (N - 1)
    return [np.sqrt(sum(v * v for v in x) / N), crossings, centre, width, np.quantile(np.abs(x), 0.2)], size / total if total else None


def test_cells_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(sg, "AT_ONCE", 3 * N)
    rows, df = cells(spark)
    grid = spark.createDataFrame([(r, k) for r, k, _ in rows] + [("r", 10), ("none", 0)], "recording_id string, decision_index long")
    out = {(x.recording_id, x.decision_index): x for x in sg.audio_grid(sg.audio_cells(df, RATE, STEP), grid).collect()}
    assert len(out) == len(rows) + 2
    spectra = {}
    for r, k, samples in rows:
        x = out[r, k]
        if samples is None or len(samples) != N or None in samples:
            assert not x.audio_valid and not x.spectral_valid and x.rms is None and x.noise_proxy is None and x.flux is None
            continue
        want, spectra[r, k] = measured(samples)
        assert x.audio_valid and x.spectral_valid == (spectra[r, k] is not None)
        assert [x.rms, x.zero_crossing_rate, x.spectral_centroid, x.spectral_bandwidth, x.noise_proxy] == [None if w is None else pytest.approx(w, abs=1e-12) for w in want]
        was = spectra.get((r, k - 1))
        assert x.flux == (None if was is None or spectra[r, k] is None else pytest.approx(np.linalg.norm(spectra[r, k] - was), abs=1e-12))
    assert not out["none", 0].audio_valid and not out["r", 10].audio_valid
    assert sg.audio_grid(sg.audio_cells(df.filter("false"), RATE, STEP), grid.filter("false")).count() == 0


def test_levels_under_the_mask_equal_a_plain_loop(spark):
    r = np.random.default_rng(6)
    edges = np.unique(np.concatenate([[0.0, 24.0], np.round(r.uniform(0, 24, 25), 3), [8.0, 8.125, 12.0]]))
    pieces, states = [], []
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        one = [SPEAKING if r.random() < 0.7 else SILENT, [SILENT, SILENT, SPEAKING, UNKNOWN][int(r.integers(4)) if k % 6 == 0 else 0]]
        pieces.append((a, b, one == [SPEAKING, SILENT]))
        states += [("r", k, a, b, p, s) for p, s in enumerate(one)]
    given = spark.createDataFrame(states, "recording_id string, ordinal long, start_s double, end_s double, participant_index int, state string")
    samples = [r.normal(size=N).tolist() for _ in range(6)]
    samples[4] = [0.0] * N
    fraction = [0.5, 0.5, 0.2, 0.5, 0.5, None]
    sound = spark.createDataFrame([("r", k, x, f) for k, (x, f) in enumerate(zip(samples, fraction, strict=True))] + [("r", 9, [1.0] * N, 1.0)], "recording_id string, decision_index long, samples array<double>, fraction double")
    masks = sg.solo_ranges(given, RATE, STEP)
    out = {x.decision_index: x.level_db for x in sg.masked_level(sound.join(masks, ["recording_id", "decision_index"], "left"), RATE, STEP, 0.4).collect()}
    for k, x in enumerate(samples):
        kept = [v for i, v in enumerate(x) if any(s and a <= k * STEP + i / RATE + 1e-9 < b for a, b, s in pieces)]
        if not kept or fraction[k] is None or fraction[k] < 0.4:
            assert out[k] is None
        else:
            level = np.sqrt(np.mean(np.square(kept)))
            assert out[k] == pytest.approx(20 * np.log10(level) if level > 0 else -120.0)
    assert out[9] is None and sum(v is not None for v in out.values()) >= 2
