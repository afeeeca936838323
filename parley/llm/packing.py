"""Token-id rows of fixed length: best-fit-decreasing packing with a segment tree over free capacity."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import slices
from parley.llm.tokens import tokenizer_path

#: Token ids in one packed row.
ROW_TOKENS = 4096
#: Tokens that are packed against each other, about; a task holds no more than twice as many at a time.
WINDOW_TOKENS = 1 << 20
#: Bytes of text that are reckoned to give one token, when documents are dealt to windows.
TOKEN_BYTES = 4
VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 50256
PAD_ID = 0

SCHEMA = "pack_id string, doc_ids array<long>, parts array<int>, cu_seqlens array<int>, n_tokens int, ids binary, position_ids binary"


class FreeCapacity:
    """Open rows by free tokens: a segment tree that finds the least free capacity of at least a given size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = defaultdict(list)

    def _add(self, free: int, by: int) -> None:
        node = free + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def best(self, size: int) -> tuple[int, int] | None:
        """The fullest open row with room for `size`, taken out; None if there is none."""
        node = size + self.leaves
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._add(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Indexes of the pieces in each row, longest piece first; ties in the order given."""
    open_rows, rows = FreeCapacity(capacity), []
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = open_rows.best(size)
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        free, row = found
        rows[row].append(k)
        if free > size:
            open_rows.put(free - size, row)
    return rows


def pack(docs: DataFrame, capacity: int = ROW_TOKENS, window_tokens: int = WINDOW_TOKENS, path: str | None = None) -> DataFrame:
    """Packed rows of all documents' tokens, each document closed with the end id.

    A document longer than a row is cut into parts, all full but the last, so no token is lost; `parts` numbers
    them. `ids` is the row as little-endian uint16, padded to `capacity`; `cu_seqlens` has the start of each
    segment and the end of the last; `position_ids` (uint16) starts again at 0 with each segment. Documents are
    dealt by a hash of id and text to as many windows as the bytes of all texts ask for, and rows are filled
    best-fit-decreasing within a window, in a defined order: rows don't depend on files or partitions. A window
    that turns out more than twice as large is packed in several goes, so memory is bounded. Null and empty texts
    become the end id alone; repeated rows are packed as often as they occur; a null doc_id stays null in `doc_ids`.
    """
    texts = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    total = texts.agg(F.sum(F.octet_length("text") + TOKEN_BYTES)).first()[0] or 0
    windows = max(1, -(-total // (window_tokens * TOKEN_BYTES)))
    texts = texts.withColumn("place", F.xxhash64("doc_id", "text"))
    texts = texts.withColumn("window", F.pmod("place", F.lit(windows)))
    texts = texts.repartition("window").sortWithinPartitions("window", "place", "doc_id")

    def rows_of(pieces: list[tuple[int | None, int, np.ndarray]], window: int, go: int) -> pa.RecordBatch:
        sizes = np.array([len(t) for _, _, t in pieces])
        packs = best_fit_decreasing(sizes, capacity)
        ids = np.full((len(packs), capacity), PAD_ID, np.uint16)
        positions = np.zeros((len(packs), capacity), np.uint16)
        ends = []
        for row, members in enumerate(packs):
            at, cu = 0, [0]
            for k in members:
                tokens = pieces[k][2]
                ids[row, at : at + len(tokens)] = tokens
                positions[row, at : at + len(tokens)] = np.arange(len(tokens))
                at += len(tokens)
                cu.append(at)
            ends.append(cu)
        return pa.record_batch(
            [
                pa.array([f"{window}-{go}-{row}" for row in range(len(packs))]),
                pa.array([[pieces[k][0] for k in m] for m in packs], pa.list_(pa.int64())),
                pa.array([[pieces[k][1] for k in m] for m in packs], pa.list_(pa.int32())),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array([cu[-1] for cu in ends], pa.int32()),
                pa.array([r.tobytes() for r in ids.astype("<u2")], pa.binary()),
                pa.array([r.tobytes() for r in positions.astype("<u2")], pa.binary()),
            ],
            names=["pack_id", "doc_ids", "parts", "cu_seqlens", "n_tokens", "ids", "position_ids"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(path or tokenizer_path(VOCABULARY))
        pieces, held, now, go = [], 0, None, 0
        for whole in batches:
            for batch in slices(whole, "text"):
                for doc_id, text, window in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "window")), strict=True):
                    if pieces and (window != now or held >= 2 * window_tokens):
                        yield rows_of(pieces, now, go)
                        pieces, held, go = [], 0, go + 1 if window == now else 0
                    now = window
                    tokens = np.append(encoding.encode_to_numpy(text or "", disallowed_special=()).astype(np.uint16), np.uint16(END_ID))
                    pieces += [(doc_id, part, tokens[start : start + capacity]) for part, start in enumerate(range(0, len(tokens), capacity))]
                    held += len(tokens)
        if pieces:
            yield rows_of(pieces, now, go)

    return texts.select("doc_id", "text", "window").mapInArrow(work, SCHEMA)


_VOCABULARIES: dict[str, object] = {}


def vocabulary(path: str):
    """The byte-pair vocabulary of a rank file, read once in each Python worker."""
    if path not in _VOCABULARIES:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _VOCABULARIES[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _VOCABULARIES[path]
