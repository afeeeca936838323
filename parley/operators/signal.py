"""Signal features of cells of samples and of video frames, on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from parley.operators import structure as st
from parley.operators.state import EPS


#: Samples that numpy works on at once.
AT_ONCE = 1 << 20
#: Level of digital silence.
SILENCE_DB = -120.0


def _laid_out(samples: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All samples end to end as doubles, nulls as NaN, and where each cell begins (one more entry for the end). A null cell is empty."""
    lists = pc.fill_null(samples, pa.scalar([], samples.type))
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), offsets


def _typed(cells: DataFrame, keys: Sequence[str], columns: dict[str, tuple[str, pa.DataType]]) -> tuple[str, pa.Schema]:
    """The schema of the keys and further columns, for Spark and for Arrow."""
    fields = cells.select(*keys).schema
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{n} {sql}" for n, (sql, _) in columns.items()])
    return ddl, pa.schema([*to_arrow_schema(fields), *(pa.field(n, t) for n, (_, t) in columns.items())])


def audio_cells(cells: DataFrame, rate: float, step_s: float, keys: Sequence[str] = ("recording_id", "decision_index")) -> DataFrame:
    """Each cell of samples with its level (rms), zero crossings, spectral centroid and bandwidth, noise proxy, validity and normalised spectrum.

    A cell is complete if it has the `rate * step_s` samples of a step, none of them null; others are invalid, and all their
    measures null. Without energy a cell is valid but has no spectrum. All complete cells of a batch are one matrix. Signs are those
    of the bits, so -0.0 crosses zero; the noise proxy is the 20 % quantile of magnitudes.
    """
    n = round(rate * step_s)
    double = ("double", pa.float64())
    columns = {"rms": double, "zero_crossing_rate": double, "spectral_centroid": double, "spectral_bandwidth": double, "noise_proxy": double, "spectral_valid": ("boolean", pa.bool_()), "audio_valid": ("boolean", pa.bool_()), "spectrum": ("array<double>", pa.list_(pa.float64()))}
    ddl, schema = _typed(cells, keys, columns)
    window, frequency = np.hanning(n), np.fft.rfftfreq(n, 1 / rate)

    def measures(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        magnitude = np.abs(np.fft.rfft(frames * window, axis=1))
        energy = magnitude.sum(axis=1)
        spectral = energy > 0
        shares = magnitude / np.where(spectral, energy, 1)[:, None]
        centre = shares @ frequency
        width = np.sqrt(((frequency - centre[:, None]) ** 2 * shares).sum(axis=1))
        crossings = np.diff(np.signbit(frames), axis=1).mean(axis=1) if n > 1 else np.zeros(len(frames))
        values = np.column_stack([np.sqrt((frames**2).mean(axis=1)), crossings, np.where(spectral, centre, np.nan), np.where(spectral, width, np.nan), np.quantile(np.abs(frames), 0.2, axis=1)])
        return values, spectral, shares

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, AT_ONCE // max(n, 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                flat, offsets = _laid_out(batch.column("samples"))
                holes = np.concatenate([[0], np.cumsum(np.isnan(flat))])
                valid = (np.diff(offsets) == n) & (np.diff(holes[offsets]) == 0) & (n > 0)
                values, spectral = np.full((batch.num_rows, 5), np.nan), np.zeros(batch.num_rows, bool)
                spectra = [None] * batch.num_rows
                if valid.any():
                    rows = np.flatnonzero(valid)
                    values[rows], spectral[rows], shares = measures(flat[np.repeat(valid, np.diff(offsets))].reshape(-1, n))
                    for row, share in zip(rows, shares, strict=True):
                        spectra[row] = share if spectral[row] else None
                shown = [pa.array(c, pa.float64(), from_pandas=True) for c in values.T]
                yield pa.record_batch([*(batch.column(k) for k in keys), *shown, pa.array(spectral), pa.array(valid), pa.array(spectra, pa.list_(pa.float64()))], schema=schema)

    return cells.select(*keys, "samples").mapInArrow(work, ddl)


def audio_grid(measured: DataFrame, grid: DataFrame) -> DataFrame:
    """Every cell of the grid with its measures of `audio_cells` and its `flux`: the distance of its spectrum to that of the cell before it.

    Cells without samples are invalid. Flux is null unless both cells have a spectrum and follow each other.
    """
    key = ["recording_id", "decision_index"]
    rows = grid.select(*key).join(measured, key, "left")
    order = Window.partitionBy("recording_id").orderBy("decision_index")
    was = F.when(F.lag("decision_index").over(order) == F.col("decision_index") - 1, F.lag("spectrum").over(order))
    gap = F.sqrt(F.aggregate(F.zip_with("spectrum", was, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("flux", F.when(was.isNotNull() & F.col("spectrum").isNotNull(), gap))
    return rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("audio_valid", "spectral_valid")}).drop("spectrum")


def solo_ranges(states: DataFrame, rate: float, step_s: float) -> DataFrame:
    """(recording_id, decision_index, ranges): of each cell in which the wearer alone speaks, everyone being known, the samples of it, as (first, end).

    Sample i of a cell is at its start plus i / rate, and lies in a piece if that starts by then (within EPS) and ends later.
    Pieces become bounds of samples, so that no sample is a row.
    """
    solo = st.floor(states).filter("all_known AND solo = 0").select("recording_id", "start_s", "end_s")
    step, n = F.lit(step_s), round(rate * step_s)
    first, last = F.floor((F.col("start_s") - EPS) / step), F.floor(F.col("end_s") / step)
    cell = solo.withColumn("decision_index", F.explode(F.sequence(F.greatest(first, F.lit(0)), F.greatest(last, F.lit(0))))).withColumn("_t", F.col("decision_index") * step)

    def bound(at: str) -> Column:
        return F.least(F.greatest(F.ceil((F.col(at) - F.lit(EPS) - F.col("_t")) * F.lit(rate)), F.lit(0)), F.lit(n)).cast("int")

    cut = cell.select("recording_id", "decision_index", bound("start_s").alias("first"), bound("end_s").alias("end")).filter("end > first")
    return cut.groupBy("recording_id", "decision_index").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("ranges"))


def masked_level(cells: DataFrame, rate: float, step_s: float, least_share: float) -> DataFrame:
    """(recording_id, decision_index, level_db): decibels below full scale of the samples within `ranges` (first, end) of each cell.

    Null where the cell is incomplete, has no range, or its `fraction` under the mask is null or below `least_share`; SILENCE_DB for digital silence.
    """
    n = round(rate * step_s)
    keys = ("recording_id", "decision_index")
    ddl, schema = _typed(cells, keys, {"level_db": ("double", pa.float64())})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, AT_ONCE // max(n, 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                flat, offsets = _laid_out(batch.column("samples"))
                squares = np.append(flat**2, 0.0)  # so that a range may end where the samples do
                ranges = pc.fill_null(batch.column("ranges"), pa.scalar([], batch.schema.field("ranges").type))
                cell = np.repeat(np.arange(batch.num_rows), pc.list_value_length(ranges).to_numpy(zero_copy_only=False))
                parts = ranges.flatten()
                share = batch.column("fraction").cast(pa.float64()).to_numpy(zero_copy_only=False)
                whole_cell = np.diff(offsets) == n
                kept = whole_cell[cell]
                first, end = (parts.field(f).to_numpy(zero_copy_only=False)[kept] for f in ("first", "end"))
                cell = cell[kept]
                bounds = np.column_stack([offsets[cell] + first, offsets[cell] + end]).reshape(-1)
                sums = np.add.reduceat(squares, bounds)[::2] if len(bounds) else np.zeros(0)
                count = np.bincount(cell, end - first, batch.num_rows)
                mean = np.bincount(cell, sums, batch.num_rows) / np.maximum(count, 1)
                level = np.where(mean > 0, 10 * np.log10(np.where(mean > 0, mean, 1)), SILENCE_DB)
                level[~((count > 0) & (share >= least_share - 1e-9))] = np.nan
                yield pa.record_batch([*(batch.column(k) for k in keys), pa.array(level, pa.float64(), from_pandas=True)], schema=schema)

    return cells.select(*keys, "samples", "ranges", "fraction").mapInArrow(work, ddl)


def pitch_cells(frames: DataFrame, cells: DataFrame, step_s: float, least_share: float) -> DataFrame:
    """(recording_id, decision_index, f0_median, voiced_share) for every cell, from the pitch frames (time_s, f0, mask) under the mask.

    Cells (recording_id, decision_index, fraction) whose masked fraction is below `least_share`, or that have no masked
    frame, are null. A frame is voiced if its f0 is finite and positive.
    """
    cell = F.floor(F.col("time_s") / F.lit(step_s) + F.lit(1e-9)).cast("long")
    voiced = F.when((F.col("f0") > 0) & (F.col("f0") < float("inf")) & ~F.isnan("f0"), F.col("f0"))
    found = frames.filter("mask").groupBy("recording_id", cell.alias("decision_index")).agg(F.percentile(voiced, F.lit(0.5)).alias("_median"), (F.count(voiced) / F.count("*")).alias("_share"))
    enough = F.col("fraction") >= least_share - 1e-9
    met = cells.join(found, ["recording_id", "decision_index"], "left")
    return met.select("recording_id", "decision_index", F.when(enough, F.col("_median")).alias("f0_median"), F.when(enough, F.col("_share")).alias("voiced_share"))


#: The measures of a video frame, in order.
FRAME_FEATURES = ("red", "green", "blue", "brightness", "contrast", "saturation", "blur", "dominant_red", "dominant_green", "dominant_blue", "difference")
#: Levels of each channel that dominant colours are counted in, and the weights of luma.
LEVELS, LUMA = 4, (0.2126, 0.7152, 0.0722)


def _of_frame(frame: np.ndarray, previous: np.ndarray | None) -> list[float | None]:
    """FRAME_FEATURES of a height x width x 3 array of bytes; frames under three pixels high or wide have no blur."""
    rgb = frame.astype(np.float64)
    luma = rgb @ np.asarray(LUMA)
    high = rgb.max(axis=2)
    saturation = np.where(high > 0, (high - rgb.min(axis=2)) / np.where(high > 0, high, 1), 0).mean()
    edges = luma[:-2, 1:-1] + luma[2:, 1:-1] + luma[1:-1, :-2] + luma[1:-1, 2:] - 4 * luma[1:-1, 1:-1]
    bins = frame.astype(np.int64) * LEVELS // 256
    usual = int(np.bincount(((bins[..., 0] * LEVELS + bins[..., 1]) * LEVELS + bins[..., 2]).ravel(), minlength=LEVELS**3).argmax())
    colour = [((usual // LEVELS**k) % LEVELS + 0.5) * 256 / LEVELS for k in (2, 1, 0)]
    blur = float(edges.var()) if edges.size else None
    return [*map(float, rgb.mean(axis=(0, 1))), float(luma.mean()), float(rgb.std()), float(saturation), blur, *colour, None if previous is None else float(np.abs(rgb - previous).mean())]


def frame_features(frames: DataFrame, chunk: int = 256) -> DataFrame:
    """(recording_id, frame, FRAME_FEATURES) of video frames (recording_id, frame, height, width, rgb: bytes by row).

    Chunks of neighbouring frames go to one task each, with the frame before the chunk as well, so that a long recording
    is spread; the difference is null for a frame whose predecessor is missing or of another size. Frames whose bytes
    don't fit their size have null features.
    """
    part = F.floor(F.col("frame") / chunk)
    last = F.col("frame") % chunk == chunk - 1
    dealt = frames.select("recording_id", "frame", "height", "width", "rgb", F.explode(F.when(last, F.array(part, part + 1)).otherwise(F.array(part))).alias("_chunk"))

    def work(table: pa.Table) -> pa.Table:
        rows, before, owner = [], None, table.column("_chunk")[0].as_py()
        for at in np.argsort(table.column("frame").to_numpy(), kind="stable"):
            row = {c: table.column(c)[int(at)].as_py() for c in ("recording_id", "frame", "height", "width", "rgb")}
            fits = row["rgb"] is not None and row["height"] and row["width"] and len(row["rgb"]) == 3 * row["height"] * row["width"]
            pixels = np.frombuffer(row["rgb"], np.uint8).reshape(row["height"], row["width"], 3) if fits else None
            follows = before is not None and pixels is not None and before[1] is not None and before[0] == row["frame"] - 1 and before[1].shape == pixels.shape
            if row["frame"] // chunk == owner:
                found = _of_frame(pixels, before[1] if follows else None) if fits else [None] * len(FRAME_FEATURES)
                rows.append({"recording_id": row["recording_id"], "frame": row["frame"], **dict(zip(FRAME_FEATURES, found, strict=True))})
            before = row["frame"], pixels
        kinds = [("recording_id", table.schema.field("recording_id").type), ("frame", pa.int64()), *((f, pa.float64()) for f in FRAME_FEATURES)]
        return pa.Table.from_pylist(rows, schema=pa.schema(kinds))

    kind = frames.schema["recording_id"].dataType.simpleString()
    schema = f"recording_id {kind}, frame long, " + ", ".join(f"{f} double" for f in FRAME_FEATURES)
    return dealt.withColumn("frame", F.col("frame").cast("long")).groupBy("recording_id", "_chunk").applyInArrow(work, schema)


def video_cells(features: DataFrame, cells: DataFrame, per_cell: int) -> DataFrame:
    """Means of the features over the frames of each cell; null and `frame_valid` false unless all `per_cell` frames are there."""
    cell = F.floor(F.col("frame") / per_cell).cast("long")
    found = features.groupBy("recording_id", cell.alias("decision_index")).agg(F.count("*").alias("_n"), *(F.avg(f).alias(f) for f in FRAME_FEATURES))
    whole = F.coalesce(F.col("_n") == per_cell, F.lit(False))
    met = cells.join(found, ["recording_id", "decision_index"], "left")
    return met.select("recording_id", "decision_index", *(F.when(whole, F.col(f)).alias(f) for f in FRAME_FEATURES), whole.alias("frame_valid"))
