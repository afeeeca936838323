"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, exact checks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import SHINGLE, mix, shingles_of, slices, times, word_hashes

THRESHOLD = 0.8
#: Fingerprints have BLOCKS bytes; two within RADIUS bits differ in at most RADIUS // BLOCKS bits of some byte.
BLOCKS, RADIUS = 32, 63
#: Bytes of benchmark text that are sent to the executors at once; a larger benchmark goes in several such blocks.
BLOCK_BYTES = 4 << 20

_U = np.uint64
_NEAR = [[v for v in range(256) if (v ^ b).bit_count() <= RADIUS // BLOCKS] for b in range(256)]


def fingerprint_bits(shingles: np.ndarray) -> np.ndarray:
    """(len, 8 * BLOCKS) of +1 and -1: the vote of each shingle on each bit."""
    words = np.stack([mix(shingles + times(k + 1, _U(0xD6E8FEB86659FD93))) for k in range(BLOCKS // 8)], axis=1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def weighted_similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Jaccard similarity of two multisets: sum of lesser over sum of greater counts."""
    lesser = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return lesser / (sum(a.values()) + sum(b.values()) - lesser)


def _counts(shingles: np.ndarray) -> dict[int, int]:
    values, counts = np.unique(shingles, return_counts=True)
    return dict(zip(values.tolist(), counts.tolist(), strict=True))


class Items:
    """A block of benchmark items: their shingles, fingerprints, and tables from (block, byte) to items."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        words, at = word_hashes(pa.array(texts, pa.string()))
        shingles, self.at = shingles_of(words, at)
        self.ids = item_ids
        self.words = np.diff(at)
        # An item of fewer words than a shingle is one run of words, which a window equals or doesn't.
        self.short: dict[int, dict[int, list[int]]] = {}
        for k in np.flatnonzero((self.words > 0) & (self.words < SHINGLE)).tolist():
            self.short.setdefault(int(self.words[k]), defaultdict(list))[int(shingles[self.at[k]])].append(k)
        self.bags = [_counts(shingles[a:b]) for a, b in zip(self.at, self.at[1:], strict=False)]
        self.known = np.unique(shingles)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.known & _U((1 << 20) - 1)).astype(np.int64)] = True
        self.having: dict[int, list[int]] = defaultdict(list)
        self.prints = np.zeros((len(item_ids), BLOCKS), np.uint8)
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        for k, bag in enumerate(self.bags):
            if not bag or self.words[k] < SHINGLE:
                continue
            for s in bag:
                self.having[s].append(k)
            own = shingles[self.at[k] : self.at[k + 1]]
            self.prints[k] = np.packbits(fingerprint_bits(own).sum(axis=0, dtype=np.int64) > 0)
            tables = self.tables.setdefault(int(self.words[k]), [defaultdict(list) for _ in range(BLOCKS)])
            for block, byte in enumerate(self.prints[k].tolist()):
                tables[block][byte].append(k)

    def within(self, prints: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, windows within RADIUS of it), for windows of the item's length; none is missed."""
        tables = self.tables[length]
        proposed: dict[int, set[int]] = defaultdict(set)
        for block in range(BLOCKS):
            column = prints[:, block]
            for byte in np.unique(column).tolist():
                near = [k for b in _NEAR[byte] for k in tables[block].get(b, ())]
                if near:
                    rows = np.flatnonzero(column == byte).tolist()
                    for k in near:
                        proposed[k].update(rows)
        for k, rows in proposed.items():
            rows = np.array(sorted(rows))
            far = np.bitwise_count(prints[rows] ^ self.prints[k]).sum(axis=1, dtype=np.int64)
            rows = rows[far <= RADIUS]
            if len(rows):
                yield k, rows

    def matches(self, words: np.ndarray, shingles: np.ndarray, hits: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """{item: (similarity, first word, words)}: the best window of one document for each item that it holds.

        `hits` are the positions of shingles that some item has. A window without any has similarity 0, so only
        windows around hits are fingerprinted.
        """
        best: dict[int, tuple[float, int, int]] = {}
        lengths = {int(self.words[k]) for p in hits for k in self.having[int(shingles[p])]}
        for length in lengths:
            span = min(length, len(words))
            width = max(span - SHINGLE, 0)  # shingles after the first of a window
            last = len(shingles) - 1 - width
            starts = np.unique(np.concatenate([np.arange(max(0, p - width), min(p, last) + 1) for p in hits]))
            if not len(starts):
                continue
            cuts = np.flatnonzero(np.diff(starts) > 1) + 1
            for run in np.split(starts, cuts):
                first = int(run[0])
                votes = fingerprint_bits(shingles[first : int(run[-1]) + width + 1])
                sums = np.zeros((len(votes) + 1, votes.shape[1]), np.int32)
                np.cumsum(votes, axis=0, out=sums[1:])
                prints = np.packbits(sums[width + 1 :][: len(run)] - sums[: len(run)] > 0, axis=1)
                for k, rows in self.within(prints, length):
                    for row in rows.tolist():
                        start = first + row
                        found = weighted_similarity(self.bags[k], _counts(shingles[start : start + width + 1]))
                        if found >= threshold and (k not in best or found > best[k][0]):
                            best[k] = found, start, span
        return best

    def of_batch(self, texts: pa.Array, threshold: float) -> list[dict[int, tuple[float, int, int]]]:
        """The matches of each text."""
        words, at = word_hashes(texts)
        shingles, first = shingles_of(words, at)
        out: list[dict[int, tuple[float, int, int]]] = [{} for _ in range(len(texts))]
        for size, runs in self.short.items():
            own, start = shingles_of(words, at, size)
            for p in np.flatnonzero(np.isin(own, np.array(list(runs), np.uint64))).tolist():
                d = int(np.searchsorted(start, p, side="right")) - 1
                if at[d + 1] - at[d] >= size:
                    for k in runs[int(own[p])]:
                        out[d].setdefault(k, (1.0, p - int(start[d]), size))
        if not len(self.known) or not len(shingles):
            return out
        some = np.flatnonzero(self.sieve[(shingles & _U((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.known, shingles[some]), len(self.known) - 1)
        some = some[self.known[place] == shingles[some]]
        if not len(some):
            return out
        doc = np.searchsorted(first, some, side="right") - 1
        present, begin = np.unique(doc, return_index=True)
        for d, own in zip(present.tolist(), np.split(some, begin[1:]), strict=True):
            hits = own - first[d]
            out[d] = self.matches(words[at[d] : at[d + 1]], shingles[first[d] : first[d + 1]], hits, threshold)
        return out


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The benchmark in blocks whose size is checked before they are sent: each holds about `block_bytes` of text at most.

    Items without id, text or a word are left out; an item whose text occurs under several ids is found under each.
    """
    rows = benchmark.selectExpr("CAST(item_id AS LONG) AS item_id", "CAST(text AS STRING) AS text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        found = sorted((r.item_id, r.text) for r in block.toLocalIterator())
        yield Items([i for i, _ in found], [t for _, t in found])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each benchmark item that a document's text holds, with its best window.

    A window is as many words as the item has (the whole text, if that is shorter); both are multisets of
    five-word shingles, an item of fewer words being one shingle, and their weighted Jaccard similarity is
    `threshold` or more. Ties go to the earliest window. Null and empty texts hold nothing; repeated rows are
    reported again; a null doc_id stays null. An empty benchmark gives no rows.
    """
    needed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    out = None
    for items in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for whole in batches:
                for batch in slices(whole, "text"):
                    ids = batch.column("doc_id").to_pylist()
                    rows = [(i, items.ids[k], *m) for i, found in zip(ids, items.of_batch(batch.column("text"), threshold), strict=True) for k, m in sorted(found.items())]
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    columns = list(zip(*rows, strict=True)) or [()] * 5
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        found = needed.mapInArrow(work, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; rows are judged one by one, so nothing is shuffled."""
    for items in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for whole in batches:
                for batch in slices(whole, "text"):
                    yield batch.filter(pa.array([not m for m in items.of_batch(batch.column("text").cast(pa.string()), threshold)], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
