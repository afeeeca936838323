"""What several operators share: text hashing on whole Arrow batches, and cutting lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words per shingle wherever word shingles are taken.
SHINGLE = 5
#: Bytes of text that numpy works on at once; one longer text is one slice.
SLICE_BYTES = 1 << 20

_U = np.uint64
#: Odd multiplier of the rolling byte hash, its inverse modulo 2^64, and one multiplier per place in a shingle.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = [pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(SHINGLE)]
_WORD_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
#: Spaces and punctuation beyond ASCII that separate words as well.
_WIDE_GAPS = "[\u0085 -©«-±´¶-¸»¿  -⁯　-〃〈-】]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only on a single machine where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-parley-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that a lost executor costs no more than a re-read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or `wanted` and as many underscores as make it differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about `limit` bytes of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out, all bits spread."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def times(n: int, constant: np.uint64) -> np.uint64:
    """The product modulo 2^64."""
    return _U(n * int(constant) & 0xFFFFFFFFFFFFFFFF)


class _Powers:
    """Powers of the base and of its inverse, grown as longer slices need them."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            steps = np.full(max(n, 2 * len(cls.up)), _BASE, np.uint64)
            steps[0] = 1
            cls.up = np.multiply.accumulate(steps)
            steps[1:] = _INVERSE
            cls.down = np.multiply.accumulate(steps)
        return cls.up[:n], cls.down[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each text begins (one more entry for the end). Null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word in order, and each text's first word (one more entry for the end).

    A word is a run of letters and digits after lower-casing; everything else separates. Null and empty texts
    have no words.
    """
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    if len(texts) and pc.any(pc.match_substring_regex(texts, _WIDE_GAPS)).as_py():
        texts = pc.replace_substring_regex(texts, _WIDE_GAPS, " ")
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _WORD_BYTE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _Powers.to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up, out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts])
    return words, np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of five words in order, and each text's first run; a text of one to four words has one run."""
    words, at = word_hashes(texts)
    return shingles_of(words, at)


def shingles_of(words: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of `size` words (five at most) in each text; a shorter text has one run."""
    counts = np.diff(at)
    n_out = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(n_out)])
    doc = np.repeat(np.arange(len(counts)), n_out)
    start = at[:-1][doc] + np.arange(out_at[-1]) - out_at[:-1][doc]
    length = np.minimum(counts, size)[doc]
    total = np.zeros(len(start), np.uint64)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    for k, place in enumerate(_PLACES):
        total += np.where(k < length, padded[start + k] * _U(place), _U(0))
    return mix(total), out_at


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's multiset of shingles as (text index, shingle hash, count), sorted by the first two."""
    hashes, at = shingle_hashes(texts)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return doc[first], hashes[first], np.diff(np.append(first, len(doc)))
