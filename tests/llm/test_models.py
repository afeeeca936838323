"""The trained models against plain loops, and packing whatever the partitions."""

import math
import random

import numpy as np
import pytest

from parley.llm import langid, packing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def value(rows):
    """Gain and addition of a leaf of (gradient, hessian) rows."""
    g, h = sum(r[0] for r in rows), sum(r[1] for r in rows)
    return g * g / (h + 1), g / (h + 1)


def plain_pair_tree(cells):
    """The best tree of two levels over cells {(i, j): (gradient, hessian)}: every cut of every half, one after another."""
    best, out = 1e-9, dict.fromkeys(cells, 0.0)
    whole = value(cells.values())[0]
    for axis in (0, 1):
        tops = 1 + max(c[axis] for c in cells)
        across = 1 + max(c[1 - axis] for c in cells)
        for top in range(1, tops):
            gain, leaves = -whole, {}
            for half in (True, False):
                mine = [c for c in cells if (c[axis] < top) == half]
                choices = []
                for cut in range(1, across):
                    sides = [[c for c in mine if (c[1 - axis] < cut) == low] for low in (True, False)]
                    choices.append((sum(value([cells[c] for c in s])[0] for s in sides), -cut, sides))
                if not choices:
                    break
                won = max(choices, key=lambda c: (c[0], c[1]))
                gain += won[0]
                for side in won[2]:
                    leaves |= dict.fromkeys(side, value([cells[c] for c in side])[1])
            else:
                if gain > best + 1e-12:
                    best, out = gain, leaves
    return out


@pytest.mark.parametrize("shape", [(1, 1), (1, 4), (2, 2), (5, 3), (8, 8)])
def test_pair_trees_equal_plain_loops(shape):
    for seed in range(5):
        r = np.random.default_rng(seed)
        g, h = r.normal(size=shape), r.random(shape)
        want = plain_pair_tree({(i, j): (g[i, j], h[i, j]) for i in range(shape[0]) for j in range(shape[1])})
        got = quality._pair_tree(g, h)
        assert np.allclose(got, [[want[i, j] for j in range(shape[1])] for i in range(shape[0])])


def plain_scores(x, y, bins, rounds):
    """Cyclic boosting of single features by loops over rows: scores of the rows themselves."""
    share = (sum(y) + 0.5) / (len(y) + 1)
    total = [math.log(share / (1 - share))] * len(y)
    for _ in range(rounds):
        for k in range(len(x[0])):
            rows = [(v[k], yy - 1 / (1 + math.exp(-t)), 1 / (1 + math.exp(-t)) * (1 - 1 / (1 + math.exp(-t)))) for v, yy, t in zip(x, y, total)]
            edges = bins[k]
            place = [sum(e <= r[0] for e in edges) for r in rows]
            spans = [(0, len(edges) + 1)]

            def inside(a, b):
                return [(r[1], r[2]) for r, p in zip(rows, place) if a <= p < b]

            while len(spans) < quality.LEAVES:
                cuts = [(value(inside(a, c))[0] + value(inside(c, b))[0] - value(inside(a, b))[0], -i, -c) for i, (a, b) in enumerate(spans) for c in range(a + 1, b)]
                if not cuts or max(cuts)[0] <= 1e-9:
                    break
                _, i, c = max(cuts)
                a, b = spans[-i]
                spans[-i : -i + 1] = [(a, -c), (-c, b)]
            step = [quality.RATE * value(inside(a, b))[1] for a, b in spans]
            total = [t + next(s for (a, b), s in zip(spans, step) if a <= p < b) for t, p in zip(total, place)]
    return [1 / (1 + math.exp(-t)) for t in total]


def test_boosting_equals_plain_loops(monkeypatch):
    monkeypatch.setattr(quality, "ROUNDS", 4)
    monkeypatch.setattr(quality, "PAIR_ROUNDS", 0)
    monkeypatch.setattr(quality, "BINS", 6)
    r = np.random.default_rng(3)
    x = r.random((60, 3)).round(2)
    y = (x[:, 0] + 0.3 * r.random(60) > 0.6).astype(float)
    model = quality.fit(x, y)
    assert np.allclose(model.score(x), plain_scores(x.tolist(), y.tolist(), [e.tolist() for e in model.edges], 4))


def plain_mixture(table, counts):
    """Shares and log-likelihood by loops over languages and buckets, with the operator's own number of steps and penalty."""

    def em(rows):
        n = sum(counts.values())
        share = [1 / len(rows)] * len(rows)
        for _ in range(langid.STEPS if len(rows) > 1 else 0):
            new = [0.0] * len(rows)
            for bucket, c in counts.items():
                mixed = sum(s * table[l][bucket] for s, l in zip(share, rows))
                for k, l in enumerate(rows):
                    new[k] += c * share[k] * table[l][bucket] / mixed / n
            moved = max(abs(a - b) for a, b in zip(new, share))
            share = new
            if moved < langid.MOVED:
                break
        return share, sum(c * math.log(sum(s * table[l][b] for s, l in zip(share, rows))) for b, c in counts.items())

    share, _ = em(list(range(len(table))))
    order = sorted(range(len(table)), key=lambda l: (-share[l], l))
    best = None
    for size in range(1, len(order) + 1):
        part, likely = em(order[:size])
        found = likely - langid.PENALTY * (size - 1) * math.log(sum(counts.values()) + 1)
        if best is not None and found <= best[0]:
            break
        best = found, order[:size], part
    return best[1], best[2]


def test_mixtures_equal_plain_loops():
    r = np.random.default_rng(1)
    table = r.random((5, 40)) ** 4 + 0.01
    table /= table.sum(axis=1, keepdims=True)
    known = langid.Languages(list("abcde"), table)
    for _ in range(20):
        mix = r.dirichlet([0.3] * 5) @ table
        buckets = r.choice(40, int(r.integers(1, 300)), p=mix / mix.sum())
        counts = {b: int((buckets == b).sum()) for b in sorted(set(buckets.tolist()))}
        chosen, share = known.proportions(buckets)
        want, want_share = plain_mixture(table.tolist(), counts)
        assert chosen == want and np.allclose(share, want_share)


def test_a_quarter_of_documents_in_each_language_and_very_long_rows(spark):
    said = {"en": "the of and water house tree", "de": "der die und wasser haus baum", "fr": "le la et eau maison arbre"}
    rows = [(k, " ".join(random.Random(k).choices(said[lang].split(), k=30)), lang, "s", 0) for k in range(120) for lang in [sorted(said)[k % 3]]]
    rows += [(900, "wasser " * 100_000, "de", "s", 0)] + [(901, "maison et eau", "fr", "s", 0)] * 50 + [(None, "the house and the tree", None, "s", 0)]
    d = spark.createDataFrame(rows, DOCS)
    out = langid.predict(d, langid.train(d)).collect()
    assert len(out) == len(rows)
    want = {r[0]: r[2] for r in rows if r[0] is not None}
    assert all(r.lang_pred == (want[r.doc_id] if r.doc_id is not None else "en") for r in out)


def test_packed_rows_do_not_depend_on_partitions(spark):
    rows = [(k, "word " * random.Random(k).randint(0, 400), "en", "s", 0) for k in range(300)]
    rows += [(None, "no id", "en", "s", 0), (None, "no id either", "en", "s", 0), (7, "same id", "en", "s", 0)] + [(8, "repeated", "en", "s", 0)] * 40 + [(9, None, "en", "s", 0)]
    d = spark.createDataFrame(rows, DOCS)
    few, many = (sorted(map(tuple, packing.pack(d.repartition(n), capacity=256, window_tokens=5000).collect())) for n in (1, 7))
    assert few == many and len({r[0] for r in few}) == len(few)
    assert sum(len(r[1]) for r in few) >= len(rows) and sum(r[1].count(8) for r in few) >= 40
    assert sum(r[4] for r in few) > 0.95 * 256 * len(few)


def test_no_documents_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []
    assert quality.train(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")).score(np.zeros((1, 16)))[0] == 0.5
