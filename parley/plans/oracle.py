"""DuckDB SQL of the canonical facts and layers, composed into one statement per query."""

from __future__ import annotations

#: name -> (names it needs, body). The order of this mapping is the order of the WITH list.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: str, body: str) -> None:
    PARTS[name] = tuple(needs.split()), body


def sql(needs: str, body: str) -> str:
    """`body` behind a WITH list of what it needs, directly or not."""
    wanted: set[str] = set()

    def want(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for n in PARTS[name][0]:
                want(n)

    for n in needs.split():
        want(n)
    listed = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in PARTS if n in wanted)
    return f"WITH {listed}\n{body}" if listed else body


EPS = "CAST(1e-9 AS DOUBLE)"

part(
    "ann",
    "",
    """SELECT strftime(ts, '%Y-%m-%d-%H') || '/' || (user_id // 500) AS recording_id, event_type AS kind,
      CAST(epoch_us(ts) % 3600000000 AS DOUBLE) / CAST(1e6 AS DOUBLE) AS start_s,
      CAST(epoch_us(ts) % 3600000000 AS DOUBLE) / CAST(1e6 AS DOUBLE) + value AS end_s, event_id, value,
      event_type || '#' || event_id AS annotation_id FROM events""",
)
part("speech", "ann", "SELECT recording_id, kind AS participant_id, start_s, end_s, annotation_id FROM ann WHERE kind <> 'error' AND end_s > start_s")
part("unk", "ann", "SELECT recording_id, start_s, end_s, annotation_id FROM ann WHERE kind = 'error' AND end_s > start_s")
part("recs", "ann", "SELECT DISTINCT recording_id, CAST(0 AS DOUBLE) AS lo, CAST(3600 AS DOUBLE) AS hi FROM ann")
part(
    "runs",
    "speech",
    """SELECT recording_id, participant_id, min(start_s) AS start_s, max(end_s) AS end_s FROM (
      SELECT *, sum(CASE WHEN reach IS NULL OR start_s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, participant_id ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, max(end_s) OVER (PARTITION BY recording_id, participant_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM speech))
      GROUP BY recording_id, participant_id, island""",
)
part(
    "marks",
    "speech unk recs",
    """SELECT recording_id, greatest(start_s, lo) AS start_s, least(end_s, hi) AS end_s, annotation_id, bad FROM (
      SELECT recording_id, start_s, end_s, annotation_id, false AS bad FROM speech WHERE participant_id = 'click'
      UNION ALL SELECT recording_id, start_s, end_s, annotation_id, true FROM unk) JOIN recs USING (recording_id)
      WHERE least(end_s, hi) > greatest(start_s, lo)""",
)
part(
    "cut",
    "marks recs",
    """SELECT * FROM (SELECT recording_id, t AS start_s, lead(t) OVER (PARTITION BY recording_id ORDER BY t) AS end_s FROM (
      SELECT recording_id, start_s AS t FROM marks UNION SELECT recording_id, end_s FROM marks
      UNION SELECT recording_id, lo FROM recs UNION SELECT recording_id, hi FROM recs)) WHERE end_s IS NOT NULL""",
)
part(
    "states",
    "cut marks",
    """SELECT c.recording_id, c.start_s, c.end_s,
      CASE WHEN count(*) FILTER (WHERE m.bad) > 0 THEN 'UNKNOWN' WHEN count(m.annotation_id) > 0 THEN 'SPEAKING' ELSE 'SILENT' END AS state,
      CASE WHEN count(*) FILTER (WHERE m.bad) > 0 THEN string_agg(DISTINCT m.annotation_id, '|' ORDER BY m.annotation_id) FILTER (WHERE m.bad)
        ELSE string_agg(DISTINCT m.annotation_id, '|' ORDER BY m.annotation_id) END AS annotation_ids
      FROM cut c LEFT JOIN marks m ON m.recording_id = c.recording_id AND m.start_s < c.end_s AND m.end_s > c.start_s
      GROUP BY c.recording_id, c.start_s, c.end_s""",
)
part(
    "native",
    "states",
    """SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY min(start_s)) - 1 AS native_index, min(start_s) AS start_s, max(end_s) AS end_s,
      state, annotation_ids FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY start_s ROWS UNBOUNDED PRECEDING) AS island FROM (
          SELECT *, CASE WHEN lag(state) OVER w IS NOT DISTINCT FROM state AND lag(annotation_ids) OVER w IS NOT DISTINCT FROM annotation_ids
            AND lag(end_s) OVER w = start_s THEN 0 ELSE 1 END AS fresh
          FROM states WINDOW w AS (PARTITION BY recording_id ORDER BY start_s)))
      GROUP BY recording_id, island, state, annotation_ids""",
)
part(
    "flagged",
    "native",
    f"""SELECT *, coalesce(state = 'SILENT' AND lag(state) OVER w = 'SPEAKING' AND lead(state) OVER w = 'SPEAKING'
      AND abs(start_s - lag(end_s) OVER w) <= {EPS} AND abs(lead(start_s) OVER w - end_s) <= {EPS}
      AND end_s - start_s < CAST(10 AS DOUBLE) - {EPS}, false) AS bridged
      FROM native WINDOW w AS (PARTITION BY recording_id ORDER BY start_s)""",
)
part(
    "grouped",
    "flagged",
    """SELECT *, sum(CASE WHEN bridged OR coalesce(was, false) THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY start_s ROWS UNBOUNDED PRECEDING) AS grp
      FROM (SELECT *, lag(bridged) OVER (PARTITION BY recording_id ORDER BY start_s) AS was FROM flagged)""",
)
part(
    "control",
    "grouped",
    """SELECT recording_id, min(start_s) AS start_s, max(end_s) AS end_s, min_by(state, start_s) AS state,
      nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(annotation_ids, '|')) FILTER (WHERE annotation_ids IS NOT NULL)))), '|'), '') AS annotation_ids,
      min(native_index) AS first_native_index, max(native_index) AS last_native_index, count(*) FILTER (WHERE bridged) AS bridged_gaps,
      coalesce(sum(end_s - start_s) FILTER (WHERE bridged), 0) AS bridged_s
      FROM grouped GROUP BY recording_id, grp""",
)


def layer(name: str, source: str) -> None:
    """Transitions, bounds and the grid (10 s cells) of a timeline."""
    part(
        f"{name}_changes",
        source,
        f"""SELECT * FROM (SELECT recording_id, start_s AS time_s, lag(state) OVER (PARTITION BY recording_id ORDER BY start_s) AS before, state AS after FROM {source})
          WHERE before <> after""",
    )
    part(
        f"{name}_bounds",
        source,
        f"""SELECT recording_id, CAST(ceil((min(start_s) - {EPS}) / 10) AS BIGINT) AS first_index,
          greatest(0, CAST(floor((max(end_s) + {EPS}) / 10) AS BIGINT) - CAST(ceil((min(start_s) - {EPS}) / 10) AS BIGINT)) AS slots, min(start_s) AS lo, max(end_s) AS hi
          FROM {source} GROUP BY recording_id""",
    )
    part(
        f"{name}_slots",
        f"{name}_bounds {source}",
        f"""SELECT s.recording_id, s.k AS decision_index, CAST(s.k AS DOUBLE) * 10 AS t, s.lo, n.state AS state_before
          FROM (SELECT recording_id, lo, unnest(range(first_index, first_index + slots)) AS k FROM {name}_bounds) s
          ASOF JOIN (SELECT recording_id, state, coalesce(lag(end_s) OVER (PARTITION BY recording_id ORDER BY start_s), CAST('-inf' AS DOUBLE)) AS opens FROM {source}) n
          ON n.recording_id = s.recording_id AND n.opens < CAST(s.k AS DOUBLE) * 10 - {EPS}""",
    )
    part(
        f"{name}_hits",
        f"{name}_changes",
        f"""SELECT recording_id, CAST(floor((time_s + {EPS}) / 10) AS BIGINT) AS decision_index,
          count(*) FILTER (WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN') AS changes,
          bool_or(before = 'UNKNOWN' OR after = 'UNKNOWN') AS unknown_change,
          min(time_s) FILTER (WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN') AS time_s,
          min_by(after, time_s) FILTER (WHERE before <> 'UNKNOWN' AND after <> 'UNKNOWN') AS after
          FROM {name}_changes GROUP BY ALL""",
    )
    part(
        f"{name}_grid",
        f"{name}_slots {name}_hits",
        f"""SELECT recording_id, decision_index, t AS decision_time_s, t + 10 AS slot_end_s, state_before, mask_reason IS NULL AS action_valid, mask_reason,
          CASE WHEN mask_reason IS NULL THEN CASE WHEN changes = 0 THEN 'NO_EVENT' WHEN after = 'SPEAKING' THEN 'ONSET' ELSE 'OFFSET' END END AS action,
          CASE WHEN mask_reason IS NULL AND changes = 1 THEN time_s END AS event_time_s,
          CASE WHEN mask_reason IS NULL AND changes = 1 THEN CASE WHEN time_s - t < 0 THEN 0 WHEN time_s - t >= 10 THEN 10 ELSE time_s - t END END AS tau_s
          FROM (SELECT s.*, coalesce(h.changes, 0) AS changes, h.time_s, h.after, CASE WHEN s.t <= s.lo + {EPS} THEN 'recording_start'
              WHEN s.state_before = 'UNKNOWN' THEN 'unknown_state' WHEN h.unknown_change THEN 'unknown_within_slot' WHEN h.changes > 1 THEN 'compound_transition' END AS mask_reason
            FROM {name}_slots s LEFT JOIN {name}_hits h USING (recording_id, decision_index))""",
    )


layer("native", "native")
layer("control", "control")

part("who", "recs", "SELECT recording_id, unnest(['click', 'purchase', 'signup', 'view']) AS participant_id, unnest([0, 1, 2, 3]) AS participant_index FROM recs")
part(
    "pmarks",
    "speech unk recs who",
    """SELECT recording_id, participant_index, greatest(start_s, lo) AS start_s, least(end_s, hi) AS end_s, bad FROM (
      SELECT recording_id, participant_index, start_s, end_s, false AS bad FROM speech JOIN who USING (recording_id, participant_id)
      UNION ALL SELECT recording_id, participant_index, start_s, end_s, true FROM unk JOIN who USING (recording_id)) JOIN recs USING (recording_id)
      WHERE least(end_s, hi) > greatest(start_s, lo)""",
)
part(
    "punion",
    "pmarks",
    """SELECT recording_id, participant_index, bad, min(start_s) AS start_s, max(end_s) AS end_s FROM (
      SELECT *, sum(CASE WHEN reach IS NULL OR start_s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, participant_index, bad ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, max(end_s) OVER (PARTITION BY recording_id, participant_index, bad ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM pmarks))
      GROUP BY recording_id, participant_index, bad, g""",
)
part(
    "pcut",
    "punion recs",
    """SELECT * FROM (SELECT recording_id, row_number() OVER w - 1 AS ordinal, t AS start_s, lead(t) OVER w AS end_s FROM (
      SELECT recording_id, start_s AS t FROM punion UNION SELECT recording_id, end_s FROM punion UNION SELECT recording_id, lo FROM recs UNION SELECT recording_id, hi FROM recs)
      WINDOW w AS (PARTITION BY recording_id ORDER BY t)) WHERE end_s IS NOT NULL""",
)
part(
    "pstates",
    "pcut who punion",
    """SELECT c.recording_id, c.ordinal, c.start_s, c.end_s, w.participant_index,
      CASE WHEN bool_or(m.bad) THEN 'UNKNOWN' WHEN count(m.bad) > 0 THEN 'SPEAKING' ELSE 'SILENT' END AS state
      FROM pcut c JOIN who w USING (recording_id) LEFT JOIN punion m ON m.recording_id = c.recording_id AND m.participant_index = w.participant_index AND m.start_s < c.end_s AND m.end_s > c.start_s
      GROUP BY ALL""",
)
part(
    "floor0",
    "pstates",
    """SELECT recording_id, ordinal, any_value(start_s) AS start_s, any_value(end_s) AS end_s, count(*) FILTER (WHERE state = 'SPEAKING') AS speakers, bool_and(state <> 'UNKNOWN') AS all_known,
      CASE WHEN count(*) FILTER (WHERE state = 'SPEAKING') = 0 THEN -1 WHEN count(*) FILTER (WHERE state = 'SPEAKING') > 1 THEN -2 ELSE min(participant_index) FILTER (WHERE state = 'SPEAKING') END AS holder,
      CASE WHEN bool_and(state <> 'UNKNOWN') AND count(*) FILTER (WHERE state = 'SPEAKING') = 1 THEN min(participant_index) FILTER (WHERE state = 'SPEAKING') END AS solo
      FROM pstates GROUP BY 1, 2""",
)
part(
    "flr",
    "floor0",
    """SELECT * EXCLUDE (r), CASE WHEN all_known THEN last_value(solo IGNORE NULLS) OVER (PARTITION BY recording_id, r ORDER BY ordinal ROWS UNBOUNDED PRECEDING) END AS last_unique
      FROM (SELECT *, count(*) FILTER (WHERE NOT all_known) OVER (PARTITION BY recording_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS r FROM floor0)""",
)
part(
    "pevents",
    "pstates",
    """SELECT * FROM (SELECT recording_id, ordinal, start_s AS time_s, participant_index,
      CASE WHEN was = 'SILENT' AND state = 'SPEAKING' THEN 'onset' WHEN was = 'SPEAKING' AND state = 'SILENT' THEN 'offset' END AS kind
      FROM (SELECT *, lag(state) OVER (PARTITION BY recording_id, participant_index ORDER BY ordinal) AS was FROM pstates)) WHERE kind IS NOT NULL""",
)
part(
    "pruns",
    "pstates",
    """SELECT recording_id, participant_index, min(start_s) AS start_s, max(end_s) AS end_s, min(ordinal) AS first_piece, max(ordinal) AS last_piece,
      coalesce(min_by(was, ordinal), 'UNKNOWN') = 'UNKNOWN' OR bool_or(ordinal = 0) AS start_censored, coalesce(max_by(nxt, ordinal), 'UNKNOWN') = 'UNKNOWN' OR bool_or(nxt IS NULL) AS end_censored FROM (
        SELECT *, ordinal - row_number() OVER (PARTITION BY recording_id, participant_index ORDER BY ordinal) AS g FROM (
          SELECT *, lag(state) OVER w AS was, lead(state) OVER w AS nxt FROM pstates WINDOW w AS (PARTITION BY recording_id, participant_index ORDER BY ordinal)) WHERE state = 'SPEAKING')
      GROUP BY recording_id, participant_index, g""",
)
part(
    "fchanges",
    "flr pruns",
    """SELECT f.recording_id, f.ordinal, f.start_s AS time_s, f.previous_holder, f.last_unique AS next_holder, max(b.end_s) AS previous_run_end_s, any_value(a.start_s) AS next_run_start_s, any_value(a.start_s) - max(b.end_s) AS fto_s
      FROM (SELECT *, lag(last_unique) OVER (PARTITION BY recording_id ORDER BY ordinal) AS previous_holder FROM flr) f
      JOIN pruns a ON a.recording_id = f.recording_id AND a.participant_index = f.last_unique AND f.ordinal BETWEEN a.first_piece AND a.last_piece
      JOIN pruns b ON b.recording_id = f.recording_id AND b.participant_index = f.previous_holder AND b.last_piece < f.ordinal
      WHERE f.previous_holder <> f.last_unique GROUP BY 1, 2, 3, 4, 5""",
)
part(
    "sil",
    "flr",
    """SELECT recording_id, min(start_s) AS start_s, max(end_s) AS end_s, min_by(b, ordinal) FILTER (WHERE first) AS previous_speaker, max_by(a, ordinal) FILTER (WHERE last) AS next_speaker FROM (
        SELECT *, ordinal = min(ordinal) OVER (PARTITION BY recording_id, g) AS first, ordinal = max(ordinal) OVER (PARTITION BY recording_id, g) AS last FROM (
          SELECT *, ordinal - row_number() OVER (PARTITION BY recording_id ORDER BY ordinal) AS g FROM (
            SELECT *, lag(solo) OVER w AS b, lead(solo) OVER w AS a FROM flr WINDOW w AS (PARTITION BY recording_id ORDER BY ordinal)) WHERE all_known AND speakers = 0))
      GROUP BY recording_id, g""",
)
part(
    "trn",
    "pruns pstates",
    f"""SELECT *, lag(participant_index) OVER w AS previous_participant, lead(participant_index) OVER w AS next_participant,
      CASE WHEN lag(participant_index) OVER w <> participant_index THEN start_s - lag(end_s) OVER w END AS fto_from_previous_s FROM (
        SELECT recording_id, participant_index, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS runs, coalesce(sum(pause) FILTER (WHERE joins), 0) AS pauses_s,
          min_by(start_censored, start_s) AS start_censored, max_by(end_censored, start_s) AS end_censored FROM (
          SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id, participant_index ORDER BY start_s ROWS UNBOUNDED PRECEDING) AS g FROM (
            SELECT *, start_s - pe AS pause, coalesce(start_s - pe <= 30 + {EPS} AND NOT EXISTS (FROM pstates s WHERE s.recording_id = r.recording_id AND s.participant_index = r.participant_index
              AND s.state = 'UNKNOWN' AND s.ordinal > r.pl AND s.ordinal < r.first_piece), false) AS joins
            FROM (SELECT *, lag(end_s) OVER v AS pe, lag(last_piece) OVER v AS pl FROM pruns WINDOW v AS (PARTITION BY recording_id, participant_index ORDER BY start_s)) r))
        GROUP BY recording_id, participant_index, g) WINDOW w AS (PARTITION BY recording_id ORDER BY start_s, participant_index)""",
)
part(
    "ovl",
    "pruns flr",
    f"""SELECT i.recording_id, i.participant_index AS initial, e.participant_index AS entering, e.start_s, least(i.end_s, e.end_s) AS end_s, f.last_unique AS previous_floor_holder,
      CASE WHEN e.start_s - i.start_s <= 5 + {EPS} THEN 'simultaneous_onset' WHEN i.end_censored OR e.end_censored THEN 'undetermined' WHEN e.end_s <= i.end_s + {EPS} THEN 'within' ELSE 'between' END AS overlap_type,
      CASE WHEN e.start_s - i.start_s <= 5 + {EPS} THEN NOT (i.start_censored OR e.start_censored) ELSE NOT (i.end_censored OR e.end_censored) END AND NOT e.start_censored AS valid
      FROM pruns i JOIN pruns e ON i.recording_id = e.recording_id AND i.participant_index <> e.participant_index AND e.start_s >= i.start_s AND e.start_s < i.end_s
        AND (e.start_s > i.start_s OR i.participant_index < e.participant_index)
      LEFT JOIN flr f ON f.recording_id = e.recording_id AND f.ordinal = e.first_piece - 1""",
)
part(
    "ctx",
    "pevents pstates flr",
    f"""SELECT *, CASE WHEN others_at THEN 'overlap' WHEN others_at IS NULL OR previous_unique_speaker IS NULL OR silence_before_s IS NULL THEN 'undetermined'
      WHEN previous_unique_speaker = participant_index THEN 'after_silence' ELSE 'floor_transfer' END AS onset_type FROM (
      SELECT o.recording_id, o.ordinal, o.time_s, o.participant_index, b.last_unique AS previous_unique_speaker,
        CASE WHEN b.speakers > 0 THEN true WHEN NOT b.all_known THEN NULL ELSE false END AS others_before,
        CASE WHEN a.speakers > 1 THEN true WHEN NOT a.all_known THEN NULL ELSE false END AS others_at,
        CASE WHEN b.speakers > 0 THEN 0 WHEN b.all_known AND h.all_known THEN o.time_s - h.end_s END AS silence_before_s,
        EXISTS (FROM pevents q WHERE q.recording_id = o.recording_id AND q.kind = 'onset' AND q.participant_index <> o.participant_index AND abs(q.time_s - o.time_s) <= 5 + {EPS}) AS simultaneous
      FROM pevents o JOIN flr b ON b.recording_id = o.recording_id AND b.ordinal = o.ordinal - 1 JOIN flr a ON a.recording_id = o.recording_id AND a.ordinal = o.ordinal
      LEFT JOIN (SELECT recording_id, ordinal, max(CASE WHEN NOT (all_known AND speakers = 0) THEN ordinal END) OVER (PARTITION BY recording_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS last_heard FROM flr) l
        ON l.recording_id = o.recording_id AND l.ordinal = o.ordinal - 1
      LEFT JOIN flr h ON h.recording_id = o.recording_id AND h.ordinal = l.last_heard
      WHERE o.kind = 'onset')""",
)
