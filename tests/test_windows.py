"""Windows read back against plain slices."""

import random

from parley.operators import windows


def test_windows_are_slices_of_their_segment(spark):
    r = random.Random(8)
    grid, want = [], {}
    for rec, size in (("a", 57), ("b", 9), ("c", 3), ("d", 300)):
        held = [k for k in range(size) if r.random() > 0.02]
        actions = {k: r.choice(["NO_EVENT", "ONSET", "OFFSET", None]) for k in held}
        grid += [(rec, k, a, a is not None) for k, a in actions.items()]
        runs, run = [], []
        for k in [*held, None]:
            if run and (k is None or k != run[-1] + 1):
                runs.append(run)
                run = []
            run.append(k)
        for run in runs:
            marks = [actions[k] or "masked" for k in run]
            for at in range(len(run)):
                if at + 1 >= 3 and at + 4 < len(run):
                    want[rec, run[at]] = (marks[max(0, at - 19) : at + 1], marks[at + 1 : at + 5])
    df = spark.createDataFrame(grid, "recording_id string, decision_index long, action string, action_valid boolean")
    spec = windows.WindowSpec(3, 20, 4)
    for block in (1, 7, 1024):
        got = {(x.recording_id, x.decision_index): (x.context, x.future) for x in windows.reconstruct(df, spec, block).collect()}
        assert got == want, block
    assert set(want) == {(x.recording_id, x.decision_index) for x in windows.anchors(df, spec).collect()}
    assert windows.reconstruct(df.filter("false"), spec).count() == 0
