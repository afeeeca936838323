"""Words and other speech placed in turns by windows: the turns of the pieces, and the SQL on odd conversations."""

import random
from collections import Counter

import pytest

import __spark_entry__ as entry
from parley.operators import structure as st
from parley.operators.intervals import normalize
from test_queries import shown

SPEECH = "recording_id string, participant_id string, start_s double, end_s double"


def speech_of():
    """Ends on a grid of tenths, so that intervals touch, nest, overlap and lie a turn's pause apart; some have no length."""
    draw = random.Random(3)
    rows = [(r, p, (a := draw.randrange(600) / 10), a + draw.randrange(12) / 10) for r in "xyz" for p in "abc" for _ in range(40)]
    return rows + [("x", None, 3.0, 4.0), ("x", "stranger", 3.0, 4.0), ("y", "a", None, 5.0), ("y", "a", 5.0, float("nan"))]


def test_turns_are_those_of_the_pieces(spark):
    rows = speech_of()
    speech = spark.createDataFrame(rows, SPEECH)
    who = spark.createDataFrame([(r, p, p == "b", True) for r in "xyz" for p in "abc"], "recording_id string, participant_id string, is_wearer boolean, resolved boolean")
    spans = spark.createDataFrame([(r, 0.0, 100.0) for r in "xyz"], "recording_id string, start_s double, end_s double")
    states = st.participant_states(spans, who, normalize(speech), spark.createDataFrame([], SPEECH))
    index = {r.participant_id: r.participant_index for r in st.order_participants(who).filter("recording_id = 'x'").collect()}
    want = {(r.recording_id, r.participant_index, r.start_s, r.end_s): r.pauses_s for r in st.turns(states).collect()}
    placed = st.in_turns(who, speech).cache()
    found = st.speech_turns(placed).collect()
    got = {(r.recording_id, index[r.participant_id], r.start_s, r.end_s): r.pauses_s for r in found}
    assert len(found) == len(want) > 50 and got == pytest.approx(want)
    for x in "xyz":
        assert [r.turn for r in sorted((r for r in found if r.recording_id == x), key=lambda r: (r.start_s, index[r.participant_id]))] == list(range(len([r for r in found if r.recording_id == x])))
    of = {(r.recording_id, r.participant_id, r.turn): (r.start_s, r.end_s) for r in found}
    out = placed.collect()
    assert Counter(str(r[:4]) for r in out) == Counter(str(r) for r in rows)
    for r in out:
        if r.participant_id in index and r.start_s is not None and r.end_s > r.start_s and r.end_s < 1000:
            low, high = of[r.recording_id, r.participant_id, r.turn]
            assert low <= r.start_s and r.end_s <= high
        else:
            assert r.turn is None and r.pause_s is None
            assert r.participant_index == index.get(r.participant_id)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Conversations with roles and texts that are missing or empty, and untimed turns."""
    says = [("user", "Hello there, you."), (None, "who said it?"), ("assistant", ""), ("user", None), ("system", None), ("tool", "[x] 12 ..."), ("user", "not timed so"), ("assistant", "well  done\nthen"), ("assistant", "a b c d e f g h")]
    rows = [(c, t, *s) for c in (-7, 4) for t, s in enumerate(says)] + [(None, 0, "user", "no conversation"), (9, 0, None, "nobody"), (9, 6, "user", "only untimed")]
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize("name", ["x7_token_events", "x8_turn_units"])
def test_same_rows_as_sql_on_odd_conversations(spark, odd, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{odd}/conversations.parquet/*.parquet')")
    df = entry.queries()[name](spark, odd)
    columns = sorted(df.columns)
    got = Counter(tuple(shown(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert got == Counter(tuple(shown(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_words_are_not_shuffled(spark, odd):
    """Conversations are, before they are cut into words; nothing moves a word after that."""
    plan = entry.queries()["x7_token_events"](spark, odd)._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("Generate posexplode")
    assert "Exchange" not in above and below.count("Exchange") == 2
