"""Language identification as mixture inference: expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import crc_mod, mix, slices, text_bytes

#: Hashed n-grams of bytes: so many buckets, so many bytes.
BUCKETS, GRAM = 1 << 15, 4
SMOOTHING = 0.5
#: Languages that one model holds at most: its table has BUCKETS doubles for each.
MAX_LANGUAGES = 200
STEPS, MOVED = 40, 1e-3
#: Nats, times the logarithm of the n-grams, that each further language must earn.
PENALTY = 2.0
NONE = "und"

_U = np.uint64
_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of letters and single gaps, and each text's first one (one more entry for the end)."""
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    letter = _LETTER[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1 : len(data)]  # one gap after each word
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    kept = np.where(letter[keep], data[keep], 32).astype(np.uint64)
    if len(kept) < GRAM:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    total = np.zeros(len(kept) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        total = (total << _U(8)) | kept[k : len(kept) - GRAM + 1 + k]
    bucket = (mix(total) % _U(BUCKETS)).astype(np.int64)
    counts = np.maximum(np.diff(at) - GRAM + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    out_at = np.concatenate([[0], np.cumsum(counts)])
    return bucket[at[:-1][doc] + np.arange(out_at[-1]) - out_at[:-1][doc]], out_at


@dataclass
class Languages:
    """Names, and the probability of each bucket in each language."""

    names: list[str]
    table: np.ndarray

    def proportions(self, buckets: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The languages of one document and their shares.

        The mixture of all languages is fitted first; then that of the largest one, two, three ... of them, as
        long as the likelihood gains more than the penalty.
        """
        where, count = np.unique(buckets, return_counts=True)
        p = self.table[:, where]
        count = count.astype(float)
        n = count.sum()
        share, _ = _mixture(p, count)
        order = np.argsort(-share, kind="stable")
        best: tuple[float, list[int], np.ndarray] | None = None
        for size in range(1, len(order) + 1):
            chosen = order[:size]
            part, likelihood = _mixture(p[chosen], count)
            value = likelihood - PENALTY * (size - 1) * np.log(n + 1)
            if best is not None and value <= best[0]:
                break
            best = value, chosen.tolist(), part
        return best[1], best[2]


def _mixture(p: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the rows of `p` that make `count` likeliest, and the log-likelihood."""
    k = len(p)
    n = count.sum()
    share = np.full(k, 1 / k)
    mixed = share @ p
    for _ in range(STEPS if k > 1 else 0):
        new = share * (p @ (count / mixed)) / n
        moved = np.abs(new - share).max()
        share = new
        mixed = share @ p
        if moved < MOVED:
            break
    return share, float(count @ np.log(mixed))


def train(docs: DataFrame, fold: int = 2, folds: int = 4) -> Languages:
    """N-gram tables of all documents with a language whose crc32(doc_id as text) modulo `folds` is not `fold`.

    Each task adds up one table per language; the tables are summed by bucket on Spark, so what reaches the driver
    is bounded by languages times buckets. Beyond MAX_LANGUAGES languages this raises an error.
    """
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text", "CAST(lang AS STRING) AS lang")
    rows = rows.filter("lang IS NOT NULL").filter(crc_mod("doc_id", folds) != fold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                langs = np.array(batch.column("lang").to_pylist(), object)
                buckets, at = grams(batch.column("text"))
                doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
                for lang in set(langs.tolist()):
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS, np.int64)
                    sums[lang] += np.bincount(buckets[(langs == lang)[doc]], minlength=BUCKETS)
                if len(sums) > MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for lang, counts in sums.items():
            where = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([lang] * len(where), pa.string()), pa.array(where.astype(np.int32)), pa.array(counts[where])], names=["lang", "bucket", "n"])

    summed = rows.mapInArrow(work, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    tables: dict[str, np.ndarray] = {}
    for row in summed.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n")).toLocalIterator():
        tables.setdefault(row.lang, np.zeros(BUCKETS))[row.buckets] = row.n
        if len(tables) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(tables)
    table = np.array([tables[n] for n in names]).reshape(len(names), BUCKETS) + SMOOTHING
    return Languages(names, table / table.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, languages: Languages) -> DataFrame:
    """(doc_id, lang_pred, score, languages): the likeliest language of every whole text, its share, and the set of languages found.

    Null texts and texts without a letter, and all texts when nothing was learned, are `und` with score 0; texts
    shorter than one n-gram take all languages as equally likely and the first by name. Ties go to the first by
    name. Repeated rows repeat; a null doc_id stays null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(languages)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                column = batch.column("text")
                buckets, at = grams(column)
                data, offsets = text_bytes(column)
                plain = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 0x80))])
                plain = plain[offsets[1:]] > plain[offsets[:-1]]
                names, scores, sets = [], [], []
                for row in range(batch.num_rows):
                    if not known.names or not (plain[row] or any(c.isalpha() for c in column[row].as_py() or "")):
                        names.append(NONE)
                        scores.append(0.0)
                        sets.append([])
                    elif at[row] == at[row + 1]:
                        names.append(known.names[0])
                        scores.append(1 / len(known.names))
                        sets.append([known.names[0]])
                    else:
                        chosen, share = known.proportions(buckets[at[row] : at[row + 1]])
                        top = max(range(len(chosen)), key=lambda k: (share[k], -chosen[k]))
                        names.append(known.names[chosen[top]])
                        scores.append(min(1.0, float(share[top])))
                        sets.append([known.names[k] for k in chosen])
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))],
                    names=["doc_id", "lang_pred", "score", "languages"],
                )

    needed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    return needed.mapInArrow(work, "doc_id long, lang_pred string, score double, languages array<string>")
