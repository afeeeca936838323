"""Document quality: a generalised additive model with pairwise interactions over whole-text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import crc_mod, mix, slices, text_bytes, word_hashes

#: Rows of labels that the model is fitted on at most, taken in the order of a hash of the id.
FIT_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE = 0.15
LEAVES = 4
#: Scores below this reject a document.
ACCEPT = 0.3

FEATURES = [
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "mark_share",
    "symbol_share",
    "space_share",
    "newline_share",
    "bar_share",
    "wide_share",
    "distinct_words",
    "same_as_previous",
    "repeated_pairs",
    "repeated_fives",
    "line_words",
    "marks_per_word",
]

_U = np.uint64
_CLASS = np.zeros((9, 256), np.float64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[0, _b] = "A" <= _c <= "Z"
    _CLASS[1, _b] = "0" <= _c <= "9"
    _CLASS[2, _b] = _c in ".,;:!?'\"-()"
    _CLASS[3, _b] = _b < 128 and _c in "#$%&*+/<=>@[\\]^_`{}~"
    _CLASS[4, _b] = _c == " "
    _CLASS[5, _b] = _c == "\n"
    _CLASS[6, _b] = _c == "|"
    _CLASS[7, _b] = _b >= 128
    _CLASS[8, _b] = _b < 128 and _c.isalpha()


def features(texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES) of whole texts; null and empty texts have zeros."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    words, at = word_hashes(texts)
    size = np.maximum(np.diff(offsets), 1)
    count = np.diff(at)
    some = np.maximum(count, 1)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1)
        np.cumsum(flags, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    kinds = [per_text(_CLASS[k][data], offsets) for k in range(9)]
    doc = np.repeat(np.arange(n), count)

    def repeats(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Values of each text less the distinct ones."""
        order = np.lexsort((values, of))
        v, d = values[order], of[order]
        same = (v[1:] == v[:-1]) & (d[1:] == d[:-1])
        return np.bincount(d[1:][same], minlength=n).astype(float)

    def runs(length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(words) < length:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(len(words) - length + 1, np.uint64)
        for k in range(length):
            total = mix(total * _U(3) + words[k : len(words) - length + 1 + k])
        inside = doc[: len(total)] == doc[length - 1 :]
        return total[inside], doc[: len(total)][inside]

    adjacent = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1]) if len(words) else np.empty(0, bool)
    pairs, fives = runs(2), runs(5)
    letters = kinds[8] + kinds[7]
    out = [
        np.log1p(count),
        (letters + kinds[1]) / some,
        kinds[0] / np.maximum(letters, 1),
        *(kinds[k] / size for k in (1, 2, 3, 4, 5, 6, 7)),
        1 - repeats(words, doc) / some,
        np.bincount(doc[1:][adjacent], minlength=n) / some if len(words) else np.zeros(n),
        repeats(*pairs) / some,
        repeats(*fives) / some,
        count / (kinds[5] + 1),
        (kinds[2] + kinds[3] + kinds[6]) / some,
    ]
    return np.where((count > 0)[:, None], np.stack(out, axis=1), 0.0)


@dataclass
class Additive:
    """Look-up tables: bin edges and additions per feature, and additions per pair of features in coarser bins."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _shallow_tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int) -> np.ndarray:
    """Additions per bin of a tree of few leaves over ordered bins: the best split of any leaf, again and again."""
    n = len(gradient)
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(hessian)])
    spans = [(0, n)]
    while len(spans) < leaves:
        best, what = 1e-9, None
        for k, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            left, right = g[cut] - g[a], g[b] - g[cut]
            gain = left**2 / (h[cut] - h[a] + 1) + right**2 / (h[b] - h[cut] + 1) - (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1)
            j = int(np.argmax(gain))
            if gain[j] > best:
                best, what = gain[j], (k, int(cut[j]))
        if what is None:
            break
        k, cut = what
        spans[k : k + 1] = [(spans[k][0], cut), (cut, spans[k][1])]
    out = np.zeros(n)
    for a, b in spans:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1)
    return out


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Additions per cell of a grid of two features, by a tree of two levels: one feature is cut, then the other in either half.

    All cuts are tried together, whichever feature comes first, so what only shows in both features at once is found.
    """
    best, out = 1e-9, np.zeros(gradient.shape)
    for turned in (False, True):
        g, h = (np.pad((m.T if turned else m).cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (gradient, hessian))
        rows, columns = g.shape[0] - 1, g.shape[1] - 1
        if rows < 2 or columns < 2:
            continue
        cuts, gain = [], np.zeros(rows - 1)
        for first, last in ((np.zeros(rows - 1, int), np.arange(1, rows)), (np.arange(1, rows), np.full(rows - 1, rows))):
            part_g, part_h = g[last] - g[first], h[last] - h[first]
            left_g, left_h, all_g, all_h = part_g[:, 1:-1], part_h[:, 1:-1], part_g[:, -1:], part_h[:, -1:]
            value = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1)
            cuts.append(value.argmax(axis=1) + 1)
            gain += value.max(axis=1)
        gain -= g[-1, -1] ** 2 / (h[-1, -1] + 1)
        row = int(np.argmax(gain))
        if gain[row] <= best:
            continue
        best = gain[row]
        step = np.zeros((rows, columns))
        for top, bottom, cut in ((0, row + 1, cuts[0][row]), (row + 1, rows, cuts[1][row])):
            for a, b in ((0, cut), (cut, columns)):
                sum_g, sum_h = (m[bottom, b] - m[top, b] - m[bottom, a] + m[top, a] for m in (g, h))
                step[top:bottom, a:b] = sum_g / (sum_h + 1)
        out = step.T if turned else step
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting: in every round each feature in turn gets one shallow tree on what is left to explain; then pairs do.

    Pairs are those whose coarse grid explains most of what the single features leave. Without rows, or with one
    label only, the model is the smoothed share of label 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    width = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        return Additive([np.empty(0)] * width, base, [np.zeros(1)] * width, [np.empty(0)] * width, [])
    edges, pair_edges = ([_edges(x[:, k], bins) for k in range(width)] for bins in (BINS, PAIR_BINS))
    bins = [np.searchsorted(edges[k], x[:, k], side="right") for k in range(width)]
    coarse = [np.searchsorted(pair_edges[k], x[:, k], side="right") for k in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def left_over() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            if len(tables[k]) < 2:
                continue
            gradient, hessian = left_over()
            m = len(tables[k])
            step = RATE * _shallow_tree(np.bincount(bins[k], gradient, m), np.bincount(bins[k], hessian, m), LEAVES)
            tables[k] += step
            total += step[bins[k]]

    def grid(a: int, b: int) -> tuple[np.ndarray, int, np.ndarray]:
        columns = len(pair_edges[b]) + 1
        cells = (len(pair_edges[a]) + 1) * columns
        gradient, hessian = left_over()
        cell = coarse[a] * columns + coarse[b]
        g, h = np.bincount(cell, gradient, cells), np.bincount(cell, hessian, cells)
        return cell, columns, np.stack([g, h])

    gains = []
    for a in range(width):
        for b in range(a + 1, width):
            g, h = grid(a, b)[2]
            gains.append((-float((g**2 / (h + 1)).sum()), a, b))
    chosen = [(a, b) for _, a, b in sorted(gains)[:PAIRS]]
    pair_tables = {p: np.zeros((len(pair_edges[p[0]]) + 1, len(pair_edges[p[1]]) + 1)) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            cell, columns, (g, h) = grid(a, b)
            step = RATE * _pair_tree(g.reshape(-1, columns), h.reshape(-1, columns))
            pair_tables[a, b] += step
            total += step.reshape(-1)[cell]
    return Additive(edges, base, tables, pair_edges, [(a, b, t) for (a, b), t in pair_tables.items()])


def _features_of(docs: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, y, x) of each row: its id, its label and the features of its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = features(batch.column("text"))
                flat = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.reshape(-1)))
                yield pa.record_batch([batch.column(doc_id), batch.column(label), flat], names=["id", "y", "x"])

    return docs.select(doc_id, label, "text").mapInArrow(work, "id long, y int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, fold: int = 0, folds: int = 5, fit_rows: int = FIT_ROWS) -> Additive:
    """The model of labels.quality, learned from rows whose crc32(doc_id as text) modulo `folds` is not `fold`.

    It is fitted on the driver on at most `fit_rows` labelled ids, the first by a hash; one row of features for each goes
    there: of an id with several texts the one with the least features teaches, and repeated labels count once. Labels other
    than 0 and 1 and ids without a document teach nothing.
    """
    known = labels.selectExpr("CAST(doc_id AS LONG) AS _id", "CAST(quality AS INT) AS _quality").filter("_quality IN (0, 1)").filter(crc_mod("_id", folds) != fold).distinct()
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_quality").limit(fit_rows)
    texts = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    joined = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # at most fit_rows pairs of numbers
    rows = _features_of(joined, "_id", "_quality").groupBy("id", "y").agg(F.min("x").alias("x")).collect()  # as many as the sample at most
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    y = np.array([r.y for r in rows], float)
    order = np.lexsort((y, *x.T))  # the order in which tasks end must not show in the sums
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Additive, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, score, predicted) of every whole text. Null and empty texts get the score of all-zero features; repeated rows repeat; null ids stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                p = model.score(features(batch.column("text")))
                yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= accept).astype(np.int32))], names=["doc_id", "score", "predicted"])

    needed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    return needed.mapInArrow(work, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Additive, accept: float = ACCEPT) -> DataFrame:
    """The documents that the model accepts, with all their columns; rows are judged one by one, so nothing is shuffled.

    Null and empty texts are judged as texts without any feature, very long ones whole; repeated rows stay or go together.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                yield batch.filter(pa.array(model.score(features(pc.cast(batch.column("text"), pa.string()))) >= accept))

    return docs.mapInArrow(work, docs.schema)
