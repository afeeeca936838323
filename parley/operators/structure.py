"""Conversational structure in native time: pieces, floor, runs, turns, overlaps, silences, onset contexts.

A piece is a maximal span in which every participant's state is constant. `null` stands for an unknown speaker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.intervals import clip, merge
from parley.operators.state import EPS, SILENT, SPEAKING, UNKNOWN
from parley.sources.shared import stacked

#: No holder, and several at once.
NONE, MULTIPLE = -1, -2
REC = ["recording_id"]


@dataclass(frozen=True)
class Rules:
    """Seconds that the rules on turns, overlaps and transfers take."""

    turn_pause_s: float = 0.3
    simultaneous_s: float = 0.2
    local_gap_s: float = 3.0
    local_overlap_s: float = 3.0


def _by(*keys: str) -> Window:
    return Window.partitionBy("recording_id", *keys).orderBy("ordinal")


def order_participants(participants: DataFrame) -> DataFrame:
    """Participants with `participant_index`: the wearer, then numeric ids by number, other ids, and the unresolved last."""
    number = F.expr("try_cast(participant_id AS bigint)")
    rank = F.when(F.col("is_wearer"), 0).when(~F.col("resolved"), 3).when(number.isNotNull(), 1).otherwise(2)
    order = Window.partitionBy("recording_id").orderBy(rank, number, "participant_id")
    return participants.withColumn("participant_index", F.row_number().over(order) - 1)


def participant_states(recordings: DataFrame, participants: DataFrame, speech: DataFrame, unknown: DataFrame) -> DataFrame:
    """(recording_id, ordinal, start_s, end_s, participant_index, state): each piece once per participant. UNKNOWN wins.

    An unknown region without participant holds for all. Intervals are shuffled once, by recording alone and before they are
    spread over participants; all that follows, here and in windows over a recording, stays in its partition.
    """
    people = order_participants(participants).groupBy("recording_id").agg(F.collect_list(F.struct("participant_id", "participant_index")).alias("_who"))
    window = recordings.select("recording_id", F.col("start_s").alias("_low"), F.col("end_s").alias("_high")).join(people, "recording_id")
    columns = ["recording_id", "participant_id", "start_s", "end_s"]
    marks = recordings.select("recording_id", F.lit(None).cast("string").alias("participant_id"), "start_s", "end_s", F.lit("whole").alias("mark"))
    for rows, name in ((speech.filter("participant_id IS NOT NULL"), SPEAKING), (unknown, UNKNOWN)):
        marks = marks.unionByName(rows.select(*columns, F.lit(name).alias("mark")))
    # A fixed number of partitions isn't coalesced: the rows are few here, but many once spread.
    parts = int(recordings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = clip(marks.repartition(parts, "recording_id").join(window.hint("merge"), "recording_id"), F.col("_low"), F.col("_high"))
    named = F.filter("_who", lambda p: F.col("participant_id").isNull() | (p["participant_id"] == F.col("participant_id")))
    spread = met.select("recording_id", F.size("_who").alias("_people"), "mark", "start_s", "end_s", F.explode(named).alias("_p"))
    own = merge(spread.withColumn("_owner", F.col("_p.participant_index")), ["recording_id", "_people", "_owner", "mark"])

    # Both ends of a united interval are edges for everyone, and steps for its owner.
    def step(name: str, by: int) -> Column:
        return F.when((F.col("mark") == name) & (F.col("_owner") == F.col("participant_index")), by).otherwise(0)

    ends = own.select("*", F.explode(F.sequence(F.lit(0), F.col("_people") - 1)).alias("participant_index"))
    edges = F.array(*(F.struct(F.col(at).alias("start_s"), step(SPEAKING, by).alias("spoken"), step(UNKNOWN, by).alias("hidden")) for at, by in (("start_s", 1), ("end_s", -1))))
    ends = ends.select("recording_id", "participant_index", F.explode(edges).alias("e")).select("recording_id", "participant_index", "e.*")
    ends = ends.groupBy("recording_id", "participant_index", "start_s").agg(F.sum("spoken").alias("spoken"), F.sum("hidden").alias("hidden"))
    order = Window.partitionBy("recording_id", "participant_index").orderBy("start_s")
    spoken, hidden = (F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)) > 0 for c in ("spoken", "hidden"))
    state = F.when(hidden, UNKNOWN).when(spoken, SPEAKING).otherwise(SILENT).alias("state")
    rows = ends.select("recording_id", (F.row_number().over(order) - 1).alias("ordinal"), "start_s", F.lead("start_s").over(order).alias("end_s"), "participant_index", state)
    return rows.filter("end_s IS NOT NULL")


def by_participant(states: DataFrame) -> DataFrame:
    """Each piece once per participant with what its neighbours are: from states, or from the rows of `joint`.

    `was` and `next` are the participant's states before and after, `ended_s` when it last spoke before the piece, `began_s`
    when it last was not speaking; `run` and `bad` count its pieces so far that aren't SPEAKING and that are UNKNOWN.
    """
    if "who" in states.columns:
        return states.select("*", F.explode("who").alias("_w")).drop("who").select("*", "_w.*").drop("_w")
    # By start, which is the order of ordinals and the one in which states come.
    w = Window.partitionBy("recording_id", "participant_index").orderBy("start_s")
    so_far, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    spoken = F.col("state") == SPEAKING
    return states.select(
        "recording_id",
        "ordinal",
        "start_s",
        "end_s",
        "participant_index",
        "state",
        F.lag("state").over(w).alias("was"),
        F.lead("state").over(w).alias("next"),
        F.last(F.when(spoken, F.col("end_s")), ignorenulls=True).over(before).alias("ended_s"),
        F.coalesce(F.last(F.when(~spoken, F.col("end_s")), ignorenulls=True).over(before), F.first("start_s").over(so_far)).alias("began_s"),
        F.count_if(~spoken).over(so_far).alias("run"),
        F.count_if(F.col("state") == UNKNOWN).over(so_far).alias("bad"),
    )


def joint(states: DataFrame) -> DataFrame:
    """One row per piece: the floor, what stood before and comes after, and `who`, the rows of `by_participant` in their order.

    All functions here take these rows in place of states: write them once where several read them. `span` and `quiet` number
    the observed spans and the joint silences; `heard` is the last piece so far that isn't silent.
    """
    if "who" in states.columns:
        return states
    each = ["participant_index", "state", "was", "next", "ended_s", "began_s", "run", "bad"]
    rows = by_participant(states).groupBy("recording_id", "ordinal").agg(
        F.first("start_s").alias("start_s"),
        F.first("end_s").alias("end_s"),
        F.count_if(F.col("state") == SPEAKING).alias("speakers"),
        F.count_if(F.col("state") == UNKNOWN).alias("unknowns"),
        F.min(F.when(F.col("state") == SPEAKING, F.col("participant_index"))).alias("_one"),
        F.sort_array(F.collect_list(F.struct(*each))).alias("who"),
    )
    count, known = F.col("speakers"), F.col("unknowns") == 0
    rows = rows.withColumn("all_known", known).withColumn("holder", F.when(count == 0, NONE).when(count > 1, MULTIPLE).otherwise(F.col("_one")))
    rows = rows.withColumn("solo", F.when(known & (count == 1), F.col("_one"))).drop("_one")
    w = _by()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    silent = F.col("all_known") & (count == 0)
    # The last speaker alone; an unknown piece counts as one that nobody spoke in.
    last = F.last(F.when(~F.col("all_known") | F.col("solo").isNotNull(), F.struct("solo")), ignorenulls=True).over(so_far)["solo"]
    heard = F.last(F.when(~silent, F.struct("end_s", "all_known")), ignorenulls=True).over(so_far)
    rows = rows.withColumns({"last_unique": last, "heard": heard, "span": F.count_if(~F.col("all_known")).over(so_far), "quiet": F.count_if(~silent).over(so_far)})
    before = {"was_holder": "last_unique", "was_solo": "solo", "was_speakers": "speakers", "was_unknowns": "unknowns", "was_heard": "heard"}
    return rows.withColumns({n: F.lag(c).over(w) for n, c in before.items()} | {"next_solo": F.lead("solo").over(w)})


def floor(states: DataFrame) -> DataFrame:
    """One row per piece: speakers, whether all are known, who holds the floor (-1 none, -2 several), who alone spoke last.

    The last unique speaker carries over silence and overlap and is forgotten at UNKNOWN.
    """
    return joint(states).select("recording_id", "ordinal", "start_s", "end_s", "speakers", "all_known", "holder", "solo", "last_unique")


def speaker_events(states: DataFrame) -> DataFrame:
    """(recording_id, ordinal, time_s, kind, participant_index): onsets and offsets with both sides known; ordinal is the piece that begins there."""
    was = F.col("was")
    kind = F.when((was == SILENT) & (F.col("state") == SPEAKING), "onset").when((was == SPEAKING) & (F.col("state") == SILENT), "offset")
    rows = by_participant(states).withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("recording_id", "ordinal", F.col("start_s").alias("time_s"), "kind", "participant_index")


def _runs(states: DataFrame) -> DataFrame:
    return by_participant(states).filter(F.col("state") == SPEAKING).groupBy("recording_id", "participant_index", "run").agg(
        F.min("start_s").alias("start_s"),
        F.max("end_s").alias("end_s"),
        F.min("ordinal").alias("first_piece"),
        F.max("ordinal").alias("last_piece"),
        (F.coalesce(F.min_by("was", "ordinal"), F.lit(UNKNOWN)) == UNKNOWN).alias("start_censored"),
        (F.coalesce(F.max_by("next", "ordinal"), F.lit(UNKNOWN)) == UNKNOWN).alias("end_censored"),
        F.min("bad").alias("_bad"),
    ).drop("run")


def speech_runs(states: DataFrame) -> DataFrame:
    """Maximal speech of each participant; an end that touches UNKNOWN or the recording's edge is censored."""
    return _runs(states).drop("_bad")


def floor_changes(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Changes of the last unique speaker between two known ones: the runs that frame them, the floor-transfer offset, its kind and locality."""
    def of(who: str, column: str) -> Column:
        return F.filter("who", lambda p: p["participant_index"] == F.col(who))[0][column]

    rows = joint(states).filter("was_holder IS NOT NULL AND last_unique IS NOT NULL AND was_holder <> last_unique")
    rows = rows.select(
        "recording_id",
        "ordinal",
        F.col("last_unique").alias("next_holder"),
        F.col("was_holder").alias("previous_holder"),
        F.col("start_s").alias("time_s"),
        of("was_holder", "ended_s").alias("previous_run_end_s"),
        of("last_unique", "began_s").alias("next_run_start_s"),
    )
    rows = rows.withColumn("fto_s", F.col("next_run_start_s") - F.col("previous_run_end_s"))
    return rows.withColumn("kind", transfer_kind(F.col("fto_s"))).withColumn("locality", transfer_locality(F.col("fto_s"), rules))


def transfer_kind(fto: Column) -> Column:
    return F.when(F.abs(fto) <= EPS, "no_gap_no_overlap").when(fto > 0, "gap").otherwise("overlap")


def transfer_locality(fto: Column, rules: Rules) -> Column:
    return F.when(fto > rules.local_gap_s, "long_gap").when(fto < -rules.local_overlap_s, "long_overlap").otherwise("local")


def overlaps(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Each run that begins inside another participant's run: the two, the time shared, its type and whether that is certain.

    Equal starts count once, the lower index being the initial one. The initial run is spread over its pieces and meets
    the entering run at that run's first piece, so the work is bounded by pieces.
    """
    runs = speech_runs(states)
    initial = runs.select("recording_id", F.struct("participant_index", "start_s", "end_s", "first_piece", "start_censored", "end_censored").alias("i"), F.explode(F.sequence("first_piece", "last_piece")).alias("piece"))
    entering = runs.select("recording_id", F.col("first_piece").alias("piece"), F.struct("participant_index", "start_s", "end_s", "first_piece", "start_censored", "end_censored").alias("e"))
    i, e = F.col("i"), F.col("e")
    # They meet in groups of a piece, with the floor before it: a join on pieces would deal all of them anew.
    before = floor(states).select("recording_id", (F.col("ordinal") + 1).alias("piece"), F.col("last_unique").alias("previous_floor_holder"))
    pieces = stacked([initial, entering, before], "recording_id").groupBy("recording_id", "piece").agg(F.collect_list("i").alias("_i"), F.collect_list("e").alias("_e"), F.max("previous_floor_holder").alias("previous_floor_holder"))
    met = pieces.filter("size(_e) > 0 AND size(_i) > 1").select("recording_id", "previous_floor_holder", F.col("_i"), F.explode("_e").alias("e")).select("*", F.explode("_i").alias("i")).filter(
        (i["participant_index"] != e["participant_index"]) & ((i["first_piece"] != e["first_piece"]) | (i["participant_index"] < e["participant_index"]))
    )
    together = e["start_s"] - i["start_s"] <= rules.simultaneous_s + EPS
    cut_off = i["end_censored"] | e["end_censored"]
    kind = F.when(together, "simultaneous_onset").when(cut_off, "undetermined").when(e["end_s"] <= i["end_s"] + EPS, "within").otherwise("between")
    sure = F.when(together, ~(i["start_censored"] | e["start_censored"])).otherwise(~cut_off) & ~e["start_censored"]
    return met.select(
        "recording_id",
        i["participant_index"].alias("initial"),
        e["participant_index"].alias("entering"),
        e["start_s"].alias("start_s"),
        F.least(i["end_s"], e["end_s"]).alias("end_s"),
        kind.alias("overlap_type"),
        "previous_floor_holder",
        sure.alias("valid"),
    )


def silences(states: DataFrame) -> DataFrame:
    """Maximal joint silences: a pause if the same single speaker stands on both sides, a gap if two do, else undetermined."""
    out = joint(states).filter("all_known AND speakers = 0").groupBy("recording_id", "quiet").agg(
        F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.min_by("was_solo", "ordinal").alias("previous_speaker"), F.max_by("next_solo", "ordinal").alias("next_speaker")
    ).drop("quiet")
    same = F.col("previous_speaker") == F.col("next_speaker")
    kind = F.when(same, "pause").when(~same, "gap").otherwise("undetermined")
    return out.withColumn("silence_type", kind).withColumn("valid", F.col("silence_type") != "undetermined")


def turns(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Runs of one participant joined over short pauses without UNKNOWN; neighbours are the turns before and after in order of start.

    The offset from the previous turn is given only if that is another participant's.
    """
    own = Window.partitionBy("recording_id", "participant_index").orderBy("start_s")
    runs = _runs(states)
    pause = F.col("start_s") - F.lag("end_s").over(own)
    joins = (pause <= rules.turn_pause_s + EPS) & (F.lag("_bad").over(own) == F.col("_bad"))
    runs = runs.withColumn("_pause", F.when(joins, pause)).withColumn("_turn", F.sum(F.when(joins, 0).otherwise(1)).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy("recording_id", "participant_index", "_turn").agg(
        F.min("start_s").alias("start_s"),
        F.max("end_s").alias("end_s"),
        F.count("*").alias("runs"),
        F.coalesce(F.sum("_pause"), F.lit(0.0)).alias("pauses_s"),
        F.min_by("start_censored", "start_s").alias("start_censored"),
        F.max_by("end_censored", "start_s").alias("end_censored"),
    ).drop("_turn")
    order = Window.partitionBy("recording_id").orderBy("start_s", "participant_index")
    out = out.withColumn("previous_participant", F.lag("participant_index").over(order)).withColumn("next_participant", F.lead("participant_index").over(order))
    fto = F.when(F.col("previous_participant") != F.col("participant_index"), F.col("start_s") - F.lag("end_s").over(order))
    return out.withColumn("fto_from_previous_s", fto)


def in_turns(participants: DataFrame, speech: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All rows of speech with `participant_index`, `turn`, the number of the turn that a row is a part of, and `pause_s`, the silence before it within that turn.

    Turns are those of `turns` where nothing is unknown, numbered from 0 in a recording by start and participant, but no pieces are made:
    speech is sorted once by speaker and once by turn. What is dealt by recording stays in its partition. Rows without a
    length, or whose speaker isn't a participant, have no turn; a column `timing_valid` may take out others.
    """
    people = order_participants(participants).groupBy("recording_id").agg(F.collect_list(F.struct("participant_id", "participant_index")).alias("_who"))
    # A recording has one row of participants: they are hashed, and speech isn't sorted for them.
    rows = speech.join(people.hint("shuffle_hash"), "recording_id", "left")
    rows = rows.withColumn("participant_index", F.get(F.filter("_who", lambda p: p["participant_id"] == F.col("participant_id")), F.lit(0))["participant_index"]).drop("_who")
    timed = F.col("timing_valid") if "timing_valid" in speech.columns else F.lit(True)
    finite = [F.abs(c) < float("inf") for c in ("start_s", "end_s")]
    rows = rows.withColumn("_in", F.coalesce(timed & F.col("participant_index").isNotNull() & finite[0] & finite[1] & (F.col("end_s") > F.col("start_s")), F.lit(False)))
    own = Window.partitionBy("recording_id", "participant_index", "_in").orderBy("start_s", "end_s")
    rows = rows.withColumn("pause_s", F.col("start_s") - F.max("end_s").over(own.rowsBetween(Window.unboundedPreceding, -1)))
    joins = F.coalesce(F.col("pause_s") <= rules.turn_pause_s + EPS, F.lit(False))
    rows = rows.withColumn("_opened_s", F.last(F.when(~joins, F.col("start_s")), ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    order = Window.partitionBy("recording_id", "_in").orderBy("_opened_s", "participant_index")
    pause = F.when(F.col("_in"), F.when(joins & (F.col("pause_s") > 0), F.col("pause_s")).otherwise(0.0))
    return rows.withColumns({"turn": F.when(F.col("_in"), F.dense_rank().over(order) - 1), "pause_s": pause}).drop("_in", "_opened_s")


def speech_turns(rows: DataFrame) -> DataFrame:
    """(recording_id, participant_id, turn, start_s, end_s, pauses_s): the turns of rows of `in_turns`."""
    parts = rows.filter("turn IS NOT NULL").groupBy("recording_id", "participant_id", "turn")
    return parts.agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("pause_s").alias("pauses_s"))


def simultaneous_onsets(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Onsets with `simultaneous`: whether another participant begins within the tolerance. The frame runs over whole nanoseconds."""
    return _simultaneous(speaker_events(states).filter("kind = 'onset'"), rules)


def _simultaneous(onsets: DataFrame, rules: Rules) -> DataFrame:
    reach = round((rules.simultaneous_s + EPS) * 1e9)
    w = Window.partitionBy("recording_id").orderBy("_ns").rangeBetween(-reach, reach)
    near = F.min("participant_index").over(w) != F.max("participant_index").over(w)
    return onsets.withColumn("_ns", F.round(F.col("time_s") * 1e9).cast("long")).withColumn("simultaneous", near).drop("_ns")


def onset_contexts(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """What stands around each onset: last unique speaker, others active before and at it, joint silence before, and the onset's type.

    Whether others are active is three-valued: null if none is heard and one is unknown.
    """
    at = joint(states).select(
        "*", F.explode(F.filter("who", lambda p: (p["was"] == SILENT) & (p["state"] == SPEAKING))["participant_index"]).alias("participant_index")
    )
    rows = _simultaneous(at.select("*", F.col("start_s").alias("time_s"), F.col("was_holder").alias("previous_unique_speaker"), F.col("was_heard").alias("_heard"), F.col("was_speakers").alias("b_speakers"), F.col("was_unknowns").alias("b_unknowns")), rules)
    # The speaker itself is silent before and speaking at its onset.
    others_before = F.when(F.col("b_speakers") > 0, True).when(F.col("b_unknowns") > 0, None).otherwise(False)
    others_at = F.when(F.col("speakers") > 1, True).when(F.col("unknowns") > 0, None).otherwise(False)
    rows = rows.withColumn("others_before", others_before).withColumn("others_at", others_at)
    quiet = F.when(F.col("others_before"), F.lit(0.0)).when(~F.col("others_before") & F.col("_heard.all_known"), F.col("time_s") - F.col("_heard.end_s"))
    rows = rows.withColumn("silence_before_s", quiet)
    last = F.col("previous_unique_speaker")
    kind = (
        F.when(F.col("others_at"), "overlap")
        .when(F.col("others_at").isNull() | last.isNull() | F.col("silence_before_s").isNull(), "undetermined")
        .when(last == F.col("participant_index"), "after_silence")
        .otherwise("floor_transfer")
    )
    rows = rows.withColumn("onset_type", kind)
    return rows.select("recording_id", "ordinal", "time_s", "participant_index", "previous_unique_speaker", "others_before", "others_at", "silence_before_s", "simultaneous", "onset_type")


def observed_spans(states: DataFrame) -> DataFrame:
    """Maximal spans in which every participant is known."""
    return joint(states).filter("all_known").groupBy("recording_id", "span").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).drop("span")


def events_table(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Onsets with their context, offsets and floor changes as one table."""
    context = onset_contexts(states, rules).drop("ordinal").withColumn("event", F.lit("onset"))
    offsets = speaker_events(states).filter("kind = 'offset'").select("recording_id", "time_s", "participant_index", F.lit("offset").alias("event"))
    changes = floor_changes(states, rules).select("recording_id", "time_s", F.lit("floor_change").alias("event"), "previous_holder", "next_holder", "fto_s", F.col("kind").alias("transfer_kind"), "locality")
    return context.unionByName(offsets, allowMissingColumns=True).unionByName(changes, allowMissingColumns=True)


def segments_table(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Runs, turns, overlaps and silences as one table."""
    runs = speech_runs(states).drop("first_piece", "last_piece").withColumn("segment", F.lit("run"))
    turned = turns(states, rules).withColumn("segment", F.lit("turn"))
    over = overlaps(states, rules).withColumn("segment", F.lit("overlap"))
    quiet = silences(states).withColumn("segment", F.lit("silence"))
    out = runs
    for more in (turned, over, quiet):
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def _mean(seconds: Column) -> Column:
    """The mean of whole microseconds, the same in any order of the rows."""
    return F.sum(F.round(seconds * 1e6)) / F.count(seconds) / 1e6


def _quantile(seconds: Column, q: float) -> Column:
    """A quantile (in whole tenths) of whole microseconds, to their tenth: the same in any order of the rows and on any engine."""
    return F.round(F.percentile(F.round(seconds * 1e6), F.lit(q)), 1) / 1e6


#: The statistics of a profile, in the order of its vector.
PROFILE_FEATURES = (
    "speaking_time_s", "observed_duration_s", "speaking_ratio", "speech_run_count", "run_duration_mean_s", "run_duration_median_s", "turn_count", "turns_per_minute",
    "turn_duration_mean_s", "turn_duration_median_s", "turn_duration_std_s", "pause_count", "pause_duration_mean_s", "pause_duration_median_s", "onset_count", "offset_count",
    "onset_after_silence_count", "onset_floor_transfer_count", "onset_overlap_count", "overlaps_entered", "overlaps_received", "within_overlaps_entered", "between_overlaps_entered",
    "interruption_like_count", "overlap_time_s", "floor_takes", "floor_yields", "fto_take_mean_s", "fto_take_median_s", "fto_take_q10_s", "fto_take_q90_s",
    "response_latency_mean_s", "response_latency_median_s",
)


def profiles(states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per participant with PROFILE_FEATURES: counts are 0 and statistics null where there is nothing to count.

    Time is observed where every participant is known. Pauses belong to the speaker before them, transfers to who takes
    the floor, and latencies are transfers after a gap. The whole recording counts, so nothing here may predict within it.
    `states` is read about ten times: cache or write it first where it is costly.
    """
    key = ["recording_id", "participant_index"]
    length = F.col("end_s") - F.col("start_s")

    def per(rows: DataFrame, who: str, *stats: Column) -> DataFrame:
        return rows.groupBy("recording_id", F.col(who).alias("participant_index")).agg(*stats)

    def counted(name: str, test: Column | None = None) -> Column:
        return (F.count("*") if test is None else F.count_if(test)).cast("double").alias(name)

    def median(seconds: Column, name: str) -> Column:
        return _quantile(seconds, 0.5).alias(name)

    states = joint(states)
    known = by_participant(states)
    own = F.col("all_known") & (F.col("state") == SPEAKING)
    base = per(
        known,
        "participant_index",
        *(F.coalesce(F.sum(F.when(test, length)), F.lit(0.0)).alias(n) for n, test in (("speaking_time_s", own), ("observed_duration_s", F.col("all_known")), ("overlap_time_s", own & (F.col("speakers") > 1)))),
    )
    fto, late = F.col("fto_s"), F.when(F.col("fto_s") > 0, F.col("fto_s"))
    over, changes, kind, onset = overlaps(states, rules), floor_changes(states, rules), F.col("overlap_type"), F.col("onset_type")
    parts = [
        per(speech_runs(states), "participant_index", counted("speech_run_count"), _mean(length).alias("run_duration_mean_s"), median(length, "run_duration_median_s")),
        per(turns(states, rules), "participant_index", counted("turn_count"), _mean(length).alias("turn_duration_mean_s"), median(length, "turn_duration_median_s"), F.stddev_pop(length).alias("turn_duration_std_s")),
        per(silences(states).filter("silence_type = 'pause'"), "previous_speaker", counted("pause_count"), _mean(length).alias("pause_duration_mean_s"), median(length, "pause_duration_median_s")),
        per(speaker_events(states), "participant_index", counted("onset_count", F.col("kind") == "onset"), counted("offset_count", F.col("kind") == "offset")),
        per(onset_contexts(states, rules), "participant_index", *(counted(f"onset_{n}_count", onset == t) for n, t in (("after_silence", "after_silence"), ("floor_transfer", "floor_transfer"), ("overlap", "overlap")))),
        per(over, "entering", counted("overlaps_entered"), counted("within_overlaps_entered", kind == "within"), counted("between_overlaps_entered", kind == "between"), counted("interruption_like_count", kind == "between")),
        per(over, "initial", counted("overlaps_received")),
        per(
            changes,
            "next_holder",
            counted("floor_takes"),
            _mean(fto).alias("fto_take_mean_s"),
            *(_quantile(fto, q).alias(f"fto_take_{n}_s") for n, q in (("median", 0.5), ("q10", 0.1), ("q90", 0.9))),
            _mean(late).alias("response_latency_mean_s"),
            median(late, "response_latency_median_s"),
        ),
        per(changes, "previous_holder", counted("floor_yields")),
    ]
    out = base
    for more in parts:
        out = out.join(more, key, "left")
    counts = [f for f in PROFILE_FEATURES if f.endswith("_count") or "overlaps_" in f or f in ("floor_takes", "floor_yields")]
    observed = F.col("observed_duration_s")
    out = out.fillna(0.0, counts).withColumn("speaking_ratio", F.when(observed > 0, F.col("speaking_time_s") / observed))
    return out.withColumn("turns_per_minute", F.when(observed > 0, F.col("turn_count") * 60 / observed)).select(*key, *PROFILE_FEATURES)


def recordings_table(recordings: DataFrame, participants: DataFrame) -> DataFrame:
    """Each recording with its participants in their order, the wearer first, and its length; other columns stay."""
    who = order_participants(participants).groupBy("recording_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("participant_index", "participant_id"))), lambda p: p["participant_id"]).alias("participant_ids"))
    out = recordings.join(who, "recording_id", "left").withColumn("participant_ids", F.coalesce("participant_ids", F.array().cast("array<string>")))
    return out.withColumn("participant_count", F.size("participant_ids")).withColumn("wearer_index", F.lit(0)).withColumn("duration_s", F.col("end_s") - F.col("start_s"))


def participants_table(participants: DataFrame, profile: DataFrame) -> DataFrame:
    """Each participant with its identity, its profile, and the profile as a vector with the names of its places."""
    who = order_participants(participants).withColumn("is_ego", F.col("participant_index") == 0).withColumnRenamed("resolved", "is_resolved")
    out = who.join(profile, ["recording_id", "participant_index"], "left")
    return out.withColumn("interaction_profile_features", F.array(*PROFILE_FEATURES)).withColumn("interaction_profile_feature_names", F.array(*(F.lit(f) for f in PROFILE_FEATURES)))
