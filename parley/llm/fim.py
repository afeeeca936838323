"""Fill-in-middle examples: units found by arithmetic on 64-bit words of UTF-8, cut by select over their counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import slices, text_bytes

#: What stands before prefix, suffix and middle. A text that holds one of them stays plain, so that outputs can be read back.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are cut, and of 100 cut ones so many have the suffix first.
CUT_RATE, SUFFIX_FIRST_RATE = 50, 80
SEED = 42

_U = np.uint64
_ONES = 0x0101010101010101
_TOP, _LOW = _U(0x80 * _ONES), _U(0x7F * _ONES)
_SINGLE, _FIFTY_SIX = _U(1), _U(56)


def _at_least(low: np.ndarray, n: int) -> np.ndarray:
    """The top bit of each byte whose low seven bits, all that `low` holds, are n or more."""
    return low + _U((0x80 - n) * _ONES)


class Marks:
    """One bit in the top of each byte that is marked, eight bytes to a word, and how many are marked up to each word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bytes before each place are marked."""
        word, lane = at >> 3, at & 7
        below = (_SINGLE << (lane.astype(np.uint64) << _U(3))) - _SINGLE
        inside = np.append(self.words, _U(0))[word] & below
        return self.upto[word] + np.bitwise_count(inside)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The place of the nth marked byte, counted from 1: the word by a search of the counts, then the byte within it."""
        word = np.searchsorted(self.upto, nth, side="left") - 1
        left = nth - self.upto[word]
        bits = np.append(self.words, _U(0))[np.minimum(word, len(self.words))]
        for _ in range(7):
            bits = np.where(left > 1, bits & (bits - _SINGLE), bits)
            left = left - 1
        below = (bits & (~bits + _SINGLE)) - _SINGLE
        return word * 8 + (np.bitwise_count(below) >> 3)


def unit_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """Where units end and where code points begin, in texts laid end to end.

    A unit is a run of bytes that are no white space with the white space before it, or the white space that ends a text: it
    ends at a byte that is no white space before one that is, and at each text's last byte.
    """
    padded = np.zeros((len(data) + 15) // 8 * 8, np.uint8)
    padded[: len(data)] = data
    x = padded.view("<u8")
    low = x & _LOW
    other = _at_least(low ^ _U(0x20 * _ONES), 1)
    blank = ((_at_least(low, 0x09) & ~_at_least(low, 0x0E)) | ~other) & ~x & _TOP
    after = blank >> _U(8)
    after[:-1] |= blank[1:] << _FIFTY_SIX
    ends = ~blank & after & _TOP
    last = offsets[1:][np.diff(offsets) > 0] - 1
    bytes_of = ends.view(np.uint8)
    bytes_of[last] = 0x80
    begins = ~(x & ~(x << _SINGLE)) & _TOP
    begins.view(np.uint8)[len(data) :] = 0
    bytes_of[len(data) :] = 0
    return Marks(ends), Marks(begins)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from the seed and the id; a null id is drawn for like an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4]) for k in (0, 4, 8, 12))


def rebuild(output: str, form: str) -> str:
    """The text that an output of this form was made from."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX)
    return prefix + middle + suffix


def _examples(ids: list, texts: pa.Array, seed: int, rate: int, suffix_first: int) -> Iterator[tuple]:
    """(id, units, form, characters of prefix and of middle, output) of each text in one slice."""
    data, offsets = text_bytes(texts)
    ends, begins = unit_marks(data, offsets)
    before = ends.rank(offsets)
    n = np.diff(before)
    drawn = [draws(i, seed) for i in ids]
    h = np.array(drawn, np.int64).reshape(len(ids), 4)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    places = np.where(cuts > 0, ends.select(np.maximum(before[:-1, None] + cuts, 1)) + 1, offsets[:-1, None])
    chars = np.diff(begins.rank(np.column_stack([offsets[:-1], places])), axis=1)
    raw = data.tobytes()
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    for k, doc_id in enumerate(ids):
        a, d = int(offsets[k]), int(offsets[k + 1])
        text = raw[a:d]
        if not text or h[k, 2] % 100 >= rate or any(m in text for m in marks):
            yield doc_id, int(n[k]), "plain", None, None, text
            continue
        b, c = int(places[k, 0]) - a, int(places[k, 1]) - a
        prefix, suffix = marks[0] + text[:b], marks[1] + text[c:]
        spm = h[k, 3] % 100 < suffix_first
        output = (suffix + prefix if spm else prefix + suffix) + marks[2] + text[b:c]
        yield doc_id, int(n[k]), "spm" if spm else "psm", int(chars[k, 0]), int(chars[k, 1]), output


def _each(docs: DataFrame, schema: str, finish, seed: int, rate: int, suffix_first: int) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    out = pa.schema([(name, {"long": pa.int64(), "string": pa.string()}[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [finish(*x) for x in _examples(batch.column("doc_id").to_pylist(), batch.column("text"), seed, rate, suffix_first)]
                columns = zip(*rows, strict=True) if rows else [[] for _ in names]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, columns), out.types, strict=True)], schema=out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = CUT_RATE, suffix_first: int = SUFFIX_FIRST_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): each whole text as a training example with its middle last.

    A text of n units is cut after two numbers of units drawn from the seed and its id. Forms: psm (prefix, suffix,
    middle), spm (suffix first) and plain: empty texts, those that hold a control string, and those not drawn
    stay as they are, with null counts. Null texts count as empty, a null id is drawn for like an empty one, repeated rows give
    repeated rows, other columns are left out. Each row is worked on by itself, so files and partitions don't matter.
    """
    return _each(docs, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string", lambda i, n, f, p, m, out: (i, n, f, p, m, out.decode()), seed, rate, suffix_first)


def fill_digests(docs: DataFrame, seed: int = SEED, rate: int = CUT_RATE, suffix_first: int = SUFFIX_FIRST_RATE) -> DataFrame:
    """What `fill_in_middle` returns with digests of the output and of the text rebuilt from it; texts don't leave their task."""

    def finish(doc_id, n, form, prefix, middle, output: bytes) -> tuple:
        said = hashlib.sha256(output).hexdigest()
        again = said if form == "plain" else hashlib.sha256(rebuild(output.decode(), form).encode()).hexdigest()
        return doc_id, n, form, prefix, middle, said, again

    return _each(docs, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string", finish, seed, rate, suffix_first)
