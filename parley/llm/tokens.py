"""SentencePiece encoding and decoding, and token counts, over whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from parley.llm.common import slices
from parley.llm.piece_bpe import model

#: Tokens above which a document counts as over the limit.
TOKEN_LIMIT = 4096
MODEL_NAME = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None, add_end: bool = True) -> DataFrame:
    """(doc_id, ids, text): every text's ids by backtracking, and the text that the ids decode to.

    Null texts count as empty; an empty text has the end id only. Repeated rows give repeated rows, a null
    doc_id stays null, and other columns are left out. `path` is a model file that every executor has, by
    default the public one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path or tokenizer_path(MODEL_NAME))
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = [pieces.encode(t or "") for t in batch.column("text").to_pylist()]
                if add_end:
                    for row in ids:
                        row.append(pieces.eos)
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(pieces.decode, ids), pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    return _needed(docs).mapInArrow(work, "doc_id long, ids array<int>, text string")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """What `encode` returns, as (doc_id, n_tokens, ids_sha256, decoded_sha256); ids and texts don't leave their task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path or tokenizer_path(MODEL_NAME))
        shown = pieces.shown.__getitem__
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, ids_hex, text_hex = [], [], []
                for text in batch.column("text").to_pylist():
                    ids = pieces.encode(text or "")
                    ids.append(pieces.eos)
                    counts.append(len(ids))
                    ids_hex.append(hashlib.sha256(" ".join(map(shown, ids)).encode()).hexdigest())
                    text_hex.append(hashlib.sha256(pieces.decode(ids).encode()).hexdigest())
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _needed(docs).mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) by heap-and-linked-list merging; no end id, no ids made.

    Null texts count as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows, a null doc_id stays null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path or tokenizer_path(MODEL_NAME))
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                counts = [pieces.count(t or "") for t in texts]
                yield pa.record_batch(
                    [
                        batch.column("doc_id"),
                        pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts]),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return _needed(docs).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _needed(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
