"""Audio packet timelines: container consistency, clock drift of decoded samples, dropouts and episodes.

A packet is (stream, packet_index, pts, duration) in ticks. One tick is `per_tick` samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.ranks import with_quantiles

#: Fixed value: a candidate persists if its offset keeps this share of its excess.
PERSISTENCE = 0.5


def _order() -> Window:
    return Window.partitionBy("stream").orderBy("packet_index")


def coverage(packets: DataFrame) -> DataFrame:
    """Per stream: packets, shares with time, duration and both, steps of the present times that don't advance, and whether all do."""
    present = packets.filter("pts IS NOT NULL").withColumn("_step", F.col("pts") - F.lag("pts").over(_order()))
    steps = present.groupBy("stream").agg(F.count_if(F.col("_step") <= 0).alias("bad_steps"), F.count("_step").alias("_steps"))
    share = {n: F.avg(c.cast("double")) for n, c in (("pts_share", F.col("pts").isNotNull()), ("duration_share", F.col("duration").isNotNull()), ("both_share", F.col("pts").isNotNull() & F.col("duration").isNotNull()))}
    out = packets.groupBy("stream").agg(F.count("*").alias("packets"), *(v.alias(n) for n, v in share.items())).join(steps, "stream", "left")
    bad, n = F.coalesce("bad_steps", F.lit(0)), F.coalesce("_steps", F.lit(0))
    return out.select("stream", "packets", *share, bad.alias("bad_steps"), ((n > 0) & (bad == 0)).alias("monotonic"))


def clock_errors(packets: DataFrame, per_tick: float = 1.0) -> DataFrame:
    """(stream, packet_index, error_samples): next time less time and duration, where neighbouring packets have both times."""
    rows = packets.withColumn("_next", F.lead("pts").over(_order())).withColumn("_adjacent", F.lead("packet_index").over(_order()) == F.col("packet_index") + 1)
    rows = rows.filter("_adjacent AND pts IS NOT NULL AND _next IS NOT NULL AND duration IS NOT NULL")
    return rows.select("stream", "packet_index", ((F.col("_next") - F.col("pts") - F.col("duration")) * F.lit(per_tick)).alias("error_samples"))


def clock_metrics(errors: DataFrame) -> DataFrame:
    e = F.col("error_samples")
    return errors.groupBy("stream").agg(F.count("*").alias("steps"), F.count_if(e > 0).alias("gaps"), F.count_if(e < 0).alias("overlaps"), F.max(F.abs(e)).alias("max_abs_error"))


def duration_profile(packets: DataFrame, reference: float, threshold: float, per_tick: float = 1.0) -> DataFrame:
    """Per stream: most frequent duration (the smallest on ties), median, median absolute deviation, the fence for long ones and how many pass it."""
    rows = packets.filter("duration IS NOT NULL").select("stream", (F.col("duration") * F.lit(per_tick)).alias("d"))
    rank = Window.partitionBy("stream").orderBy(F.col("n").desc(), "d")
    usual = rows.groupBy("stream", "d").agg(F.count("*").alias("n")).withColumn("_r", F.row_number().over(rank)).filter("_r = 1").select("stream", F.col("d").alias("nominal"))
    middle = rows.groupBy("stream").agg(F.percentile("d", F.lit(0.5)).alias("median"), F.min("d").alias("shortest"), F.max("d").alias("longest"), F.count_distinct("d").alias("distinct_durations"))
    spread = rows.join(middle.select("stream", "median"), "stream").groupBy("stream").agg(F.percentile(F.abs(F.col("d") - F.col("median")), F.lit(0.5)).alias("mad"))
    fences = middle.join(spread, "stream").withColumn("fence", F.greatest(F.col("median") + F.greatest(6 * F.col("mad"), 0.5 * F.col("median")), F.lit(reference + threshold)))
    long_ = rows.join(fences.select("stream", "fence"), "stream").groupBy("stream").agg(F.count_if(F.col("d") > F.col("fence")).alias("long_durations"), F.count_if(F.abs(F.col("d") - reference) > 1e-12).alias("variations"))
    return fences.join(usual, "stream").join(long_, "stream")


def drift_series(packets: DataFrame, reference: float, per_tick: float = 1.0) -> DataFrame:
    """(stream, packet_index, step, next_pts, error, drift): each step's error against the decoded frame size, and their running sum."""
    rows = packets.withColumn("next_pts", F.lead("pts").over(_order())).withColumn("_adjacent", F.lead("packet_index").over(_order()) == F.col("packet_index") + 1)
    rows = rows.filter("_adjacent AND pts IS NOT NULL AND next_pts IS NOT NULL").withColumn("error", (F.col("next_pts") - F.col("pts")) * F.lit(per_tick) - F.lit(reference))
    drift = F.sum("error").over(_order().rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("stream", "packet_index", (F.row_number().over(_order()) - 1).alias("step"), "next_pts", "error", drift.alias("drift"))


def drift_metrics(series: DataFrame, rate: float, threshold: float) -> DataFrame:
    """Per stream: steps that vary, greatest and p95 step, final and greatest drift with the time of its first peak, and jitter flags (strict)."""
    size, away = F.abs("error"), F.abs("drift")
    out = series.groupBy("stream").agg(
        F.count("*").alias("steps"),
        F.count_if(size > 1e-12).alias("variations"),
        F.max(size).alias("max_abs_step"),
        F.percentile(size, F.lit(0.95)).alias("p95_abs_step"),
        F.max_by("drift", "step").alias("final_drift"),
        F.max(away).alias("max_abs_drift"),
        F.max_by("next_pts", F.struct(away, -F.col("step"))).alias("_peak"),
    )
    out = out.withColumn("peak_time_s", F.col("_peak") / F.lit(rate)).drop("_peak")
    jitter = F.col("variations") > 0
    return out.withColumn("final_drift_ms", 1000 * F.col("final_drift") / F.lit(rate)).withColumn("jitter", jitter).withColumn(
        "bounded_jitter", jitter & (F.col("max_abs_step") <= threshold) & (F.col("max_abs_drift") <= threshold)
    ).withColumn("transient_offset", F.col("max_abs_drift") > threshold).withColumn("final_offset", F.abs("final_drift") > threshold)


def persistence(series: DataFrame, threshold: float, window: int) -> DataFrame:
    """Every step with `candidate` (error over the threshold) and `persistent`: whether the drift gained there keeps half of the excess over the next `window` steps."""
    ahead = _order().rowsBetween(0, window)
    low, base = F.min("drift").over(ahead), F.col("drift") - F.col("error")
    last = F.count("*").over(Window.partitionBy("stream")) - 1
    rows = series.withColumn("candidate", F.col("error") > threshold)
    rows = rows.withColumn("truncated", F.col("candidate") & (F.col("step") + window > last))
    return rows.withColumn("persistent", F.col("candidate") & (low - base >= PERSISTENCE * F.col("error")))


def clock_events(packets: DataFrame, per_tick: float = 1.0) -> DataFrame:
    """One row for each clock error that isn't zero."""
    return clock_errors(packets, per_tick).filter("error_samples <> 0").withColumn("kind", F.when(F.col("error_samples") > 0, "gap").otherwise("overlap"))


def episodes(steps: DataFrame, threshold: float) -> DataFrame:
    """Runs of consecutive steps that vary, cut around each persistent one, which is a dropout of its own; runs that stay within the threshold go."""
    varied = steps.filter(F.abs("error") > 1e-12)
    w = Window.partitionBy("stream").orderBy("step")
    fresh = F.when((F.lag("step").over(w) == F.col("step") - 1) & ~F.col("persistent") & ~F.lag("persistent").over(w), 0).otherwise(1)
    varied = varied.withColumn("_new", fresh).withColumn("episode", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy("stream", "episode").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    varied = varied.withColumn("_excursion", F.sum("error").over(within))
    out = varied.groupBy("stream", "episode").agg(
        F.bool_or("persistent").alias("dropout"), F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count("*").alias("steps"),
        F.max(F.abs("error")).alias("max_step"), F.max(F.abs("_excursion")).alias("max_excursion"), F.sum("error").alias("net"), F.min("error").alias("_least"), F.max("error").alias("_most"),
    )
    direction = F.when(F.col("_least") > 0, "gap").when(F.col("_most") < 0, "overlap").otherwise("mixed")
    category = F.when(F.col("dropout"), "dropout").when(F.abs("net") <= threshold, "compensated").otherwise("variation")
    out = out.filter(F.col("dropout") | (F.col("max_step") > threshold) | (F.col("max_excursion") > threshold))
    return out.select("stream", "dropout", "first_step", "last_step", "steps", "max_step", "max_excursion", "net", direction.alias("direction"), category.alias("category"))


def modal(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most frequent value (the smallest on ties) and how many rows differ from it."""
    w = Window.partitionBy(key)
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_r", F.row_number().over(w.orderBy(F.col("n").desc(), value))).withColumn("_all", F.sum("n").over(w))
    return ranked.filter("_r = 1").select(key, F.col(value).alias("mode"), (F.col("_all") - F.col("n")).alias("others"))


def frame_sizes(frames: DataFrame, key: str, value: str, marked: int = 960) -> DataFrame:
    """Per key: its frames' usual size (the smallest on ties), every size with its frames in order, how many differ from the usual one, and how many are of the `marked` size.

    Frames without a size don't count.
    """
    counts = frames.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    sizes = F.sort_array(F.collect_list(F.struct(F.col(value).alias("size"), "n")))
    usual = F.min_by(F.col(value), F.struct(-F.col("n"), F.col(value)))
    out = counts.groupBy(key).agg(usual.alias("mode"), sizes.alias("distribution"), F.sum("n").alias("frames"), F.max("n").alias("_most"), F.coalesce(F.sum(F.when(F.col(value) == marked, F.col("n"))), F.lit(0)).alias("marked"))
    return out.select(key, "mode", "distribution", "frames", (F.col("frames") - F.col("_most")).alias("others"), "marked")


def top_per_group(rows: DataFrame, keys: list[str], by: Column, n: int, ties: list[str]) -> DataFrame:
    """The n rows of each group with the greatest `by`, ties in the order given."""
    w = Window.partitionBy(*keys).orderBy(by.desc(), *ties)
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def population(metrics: DataFrame, by: list[str], value: str, limits: tuple[float, ...]) -> DataFrame:
    """Per group: streams, seven quantiles of a measure, and how many pass each limit."""
    counts = metrics.groupBy(*by).agg(F.count("*").alias("streams"), *(F.count_if(F.col(value) > x).alias(f"over_{x:g}".replace(".", "_")) for x in limits))
    out = with_quantiles(counts, metrics.select(*by, F.col(value).alias("_q")), by, ["_q"], (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))
    return out.select("*", *(F.col("_q")[k].alias(f"q{p}") for k, p in enumerate((0, 5, 25, 50, 75, 95, 100)))).drop("_q")


def codec_boundary(packets: DataFrame) -> DataFrame:
    """Per stream the samples that side data (an array of side_data_type, skip_samples, discard_padding) skips and discards; 0 where there are none."""
    entries = F.filter("side_data_list", lambda s: s["side_data_type"] == "Skip Samples")

    def total(name: str) -> Column:
        values = F.transform(entries, lambda s: F.coalesce(s[name].cast("long"), F.lit(0)))
        return F.coalesce(F.sum(F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))

    return packets.groupBy("stream").agg(total("skip_samples").alias("skip_samples"), total("discard_padding").alias("discard_padding_samples"))


def decode_cases(files: DataFrame, events: DataFrame) -> DataFrame:
    """(reason, regime, stream, time_s): the few windows whose decoding checks the reading of the packets.

    Files (stream, regime, probe_ok, duration_s and drift metrics): start and end of the quietest of each regime, the
    bounded jitter with most variations, the two greatest drifts. Events (stream, regime, category, max_step, length_s,
    time_s): the greatest of each of stitch and codec_boundary, and per regime the compensated one with the greatest step
    and the longest dropout. Ties go to the smaller stream, then to the earlier event.
    """
    good = files.filter("probe_ok")

    def best(rows: DataFrame, keys: list[str], reason: Column, time: Column, n: int, *order: Column) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order, "stream", "_time")
        return rows.withColumn("_time", time).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).select(reason.alias("reason"), "regime", "stream", F.col("_time").alias("time_s"))

    def top(rows: DataFrame, reason: str, n: int, *order: Column) -> DataFrame:
        return rows.orderBy(*order, "stream").limit(n).select(F.lit(reason).alias("reason"), "regime", "stream", F.col("peak_time_s").alias("time_s"))

    quiet = (F.col("max_abs_drift").asc(), F.col("max_abs_step").asc())
    kind = F.col("category")
    out = best(good, ["regime"], F.lit("regime_start"), F.lit(0.0), 1, *quiet)
    for more in (
        best(good, ["regime"], F.lit("regime_end"), F.col("duration_s"), 1, *quiet),
        top(good.filter("bounded_jitter"), "bounded_jitter", 1, F.col("variations").desc()),
        best(events.filter(kind.isin("stitch", "codec_boundary")), ["category"], kind, F.col("time_s"), 1, F.col("max_step").desc()),
        best(events.filter(kind == "compensated"), ["regime"], kind, F.col("time_s"), 1, F.col("max_step").desc()),
        best(events.filter(kind == "dropout"), ["regime"], kind, F.col("time_s"), 1, F.col("length_s").desc()),
        top(good, "largest_drift", 2, F.col("max_abs_drift").desc()),
    ):
        out = out.unionByName(more)
    return out


def cadence(reference: float) -> Column:
    """dense where the usual packet is shorter than 95 % of the reference, else sparse."""
    return F.when(F.col("nominal") < 0.95 * reference, "dense").otherwise("sparse")


def regime_profile(files: DataFrame, reference: float) -> DataFrame:
    """Per cadence of a regime's files: how many, and quartiles of the usual packet, of the final drift and of the greatest one."""
    stats = {"nominal": "nominal", "final_drift_ms": "final_drift_ms", "max_drift": "max_abs_drift"}
    rows = files.select(cadence(reference).alias("cadence"), *(F.col(c).alias(f"_{n}") for n, c in stats.items()))
    counts = rows.groupBy("cadence").agg(F.count("*").alias("files"))
    out = with_quantiles(counts, rows, ["cadence"], [f"_{n}" for n in stats], (0.0, 0.25, 0.5, 0.75, 1.0))
    return out.select("cadence", "files", *(F.col(f"_{n}")[k].alias(f"{n}_q{p}") for n in stats for k, p in enumerate((0, 25, 50, 75, 100))))


def profile_windows(files: DataFrame) -> DataFrame:
    """(stream, place, time_s): start, middle, peak of the drift, and end of each file."""
    times = {"start": F.lit(0.0), "middle": F.col("duration_s") / 2, "max_offset": F.col("peak_time_s"), "end": F.col("duration_s")}
    return files.select("stream", F.explode(F.array(*(F.struct(F.lit(n).alias("place"), t.alias("time_s")) for n, t in times.items()))).alias("w")).select("stream", "w.*")
