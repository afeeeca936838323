"""Importance resampling towards a target corpus on hashed word pairs, with random keys in place of random draws."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import slices
from parley.operators.ranks import numbered
from parley.sources.shared import saved

#: Buckets that features are hashed to, share of documents drawn in percent, words that a drawn one has at least.
BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Bytes that one regex pass goes over; longer runs of text are cut between words.
WINDOW = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_WORD_BYTES = bytes(b for b in range(256) if _WORD.match(bytes([b])))
#: Words up to this length have their checksums joined by tables, and at most so many are remembered.
_SHORT, _REMEMBERED = 64, 1 << 18


def _shift_tables(longest: int) -> np.ndarray:
    """[k, j, b]: what byte j of a CRC-32, of value b, becomes in the CRC of a text with k bytes more; CRCs are linear, so four are xored."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(longest):
        out[k + 1] = (out[k] >> 8) ^ table[out[k] & 255]
    return out


_SHIFTS = _shift_tables(_SHORT + 1)


def joined_crcs(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of pairs of texts end to end, from those of each and the second's length."""
    moved = np.zeros(len(first), np.uint32)
    for j in range(4):
        moved ^= _SHIFTS[length, j, (first >> np.uint32(8 * j)) & np.uint32(255)]
    return moved ^ second


class _Crcs(dict):
    """CRC-32 of words, and of words after a blank, each worked out once as long as there is room."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        out = zlib.crc32(word), zlib.crc32(word, zlib.crc32(b" "))
        if len(word) <= _SHORT and len(self) < _REMEMBERED:
            self[word] = out
        return out


def _windows(joined: bytes) -> Iterator[tuple[int, bytes]]:
    """The bytes in runs of about a window, each with where it begins, cut where no word is."""
    at = 0
    while at < len(joined):
        end = at + WINDOW
        if end < len(joined):
            kept = len(joined[at:end].rstrip(_WORD_BYTES))
            gap = None if kept else _GAP.search(joined, end)
            end = at + kept if kept else gap.start() if gap else len(joined)
        yield at, joined[at:end]
        at = end


def hashed(texts: list[str | None], buckets: int, crcs: _Crcs | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each window over a batch: the texts that its words lie in, and text and bucket of each feature.

    The batch is one run of bytes with a zero byte, which no word holds, after each text; one regex pass finds the words, a
    search of the texts' offsets says whose each is, and pairs across two texts are masked.
    """
    crcs = _Crcs() if crcs is None else crcs
    raw = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0] + [len(t) + 1 for t in raw])
    joined = b"\0".join(raw).lower()
    last: tuple[int, int] | None = None  # text and checksum of the word before the window
    for at, window in _windows(joined):
        found = list(_WORD.finditer(window))
        if not found:
            continue
        words = [m[0] for m in found]
        doc = np.searchsorted(offsets, at + np.fromiter((m.start() for m in found), np.int64, len(found)), side="right") - 1
        both = np.array([crcs[w] for w in words], np.uint32)
        own, after = both[:, 0], both[:, 1]
        length = np.fromiter(map(len, words), np.int64, len(words)) + 1
        before = np.concatenate([[last[1] if last else 0], own[:-1]]).astype(np.uint32)
        pairs = joined_crcs(before, after, np.minimum(length, _SHORT + 1))
        for k in np.flatnonzero(length > _SHORT + 1):
            pairs[k] = zlib.crc32(b" " + words[k], int(before[k]))
        inside = doc == np.concatenate([[last[0] if last else -1], doc[:-1]])
        last = int(doc[-1]), int(own[-1])
        yield doc, np.concatenate([doc, doc[inside]]), np.concatenate([own, pairs[inside]]) % np.uint32(buckets)


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all whole texts fall in each bucket that has any. Each task adds up its own first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, crcs = np.zeros(buckets, np.int64), _Crcs()
        for whole in batches:
            for batch in slices(whole, "text"):
                for _, _, found in hashed(batch.column("text").to_pylist(), buckets, crcs):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    parts = rows.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds: thousandths of the log of how much likelier it is in the target, counts smoothed by one."""
    sides = source.select(F.lit(0).alias("side"), "bucket", "n").unionByName(target.select(F.lit(1).alias("side"), "bucket", "n"))
    counts = [[0] * buckets, [0] * buckets]
    for r in sides.collect():  # two rows a bucket at most
        counts[r["side"]][r["bucket"]] = r["n"]
    s_all, t_all = sum(counts[0]), sum(counts[1])
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(*counts, strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate from the seed and the id, so that the highest sums are a weighted draw without replacement."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, tie) of each document; `tie` tells rows apart that are otherwise equal."""
    buckets = len(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs = _Crcs()
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = batch.column("doc_id").to_pylist()
                words, features, total = (np.zeros(len(ids), np.int64) for _ in range(3))
                for of_word, of_feature, found in hashed(batch.column("text").to_pylist(), buckets, crcs):
                    words += np.bincount(of_word, minlength=len(ids))
                    features += np.bincount(of_feature, minlength=len(ids))
                    total += np.bincount(of_feature, weights=gain[found], minlength=len(ids)).astype(np.int64)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                score = weight + np.array([noise(i, seed) for i in ids], np.int64)
                yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words, features, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long, score long").withColumn("tie", F.monotonically_increasing_id())


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document: rank 1, 2, 3... where it is drawn to resemble the target's texts, else null.

    Features are all words and pairs of words of whole texts, counted over all documents and all of the target, in buckets of
    their CRC-32. A document's weight is the floored mean gain of its features, its score that plus seeded Gumbel noise; of the
    N documents with `least_words` words or more the floor(percent N / 100) highest scores are drawn, ties to the smaller id (a
    null id, drawn for like an empty one, comes last), and rows that are equal in all this in any order. Null and empty
    texts have no features and weight 0; repeated rows count each time; without documents there are no rows, without a
    target its counts are 0. Other columns are left out. To the driver come two counts for each bucket and one row for each
    range of scores.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    rows = saved(weighted(docs, gain, seed), "weights")
    able = rows.filter(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    ranked = numbered(able, order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
