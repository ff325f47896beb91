"""Byte-level BPE by a global shuffle of distinct pre-tokens, and its decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farestar.llm.common import texts
from farestar.llm.tokens import shared_file
from farestar.llm.wordshuffle import by_text, encode_blocks

#: Larger blocks repeat fewer words; a block's words and numbers stay below 200 MB.
BLOCK_CHARS = 1 << 25


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The token bytes and ranks of a rank file (base64 token, space, rank a line)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


def encode(docs: DataFrame, ranks_path: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """doc_id and ids (binary, unsigned 32-bit little-endian) of every row of ``docs``.

    Each match of the pattern is encoded by itself, without special tokens.  NULL and empty
    texts have no ids; repeated rows give repeated rows; NULL doc_ids stay NULL.
    """

    def splitter():
        import regex

        return by_text(regex.compile(pattern).findall)

    def coder(content: bytes):
        import tiktoken

        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=read_ranks(content), special_tokens={}
        )
        return lambda words: [encoding.encode_ordinary(word.decode()) for word in words]

    def finish(block: int, packet: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
            ["doc_id", "ids"],
        )

    return encode_blocks(
        texts(docs), splitter, coder, shared_file(docs.sparkSession, ranks_path), finish,
        "doc_id long, ids binary", buckets, block_chars=BLOCK_CHARS,
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of (doc_id, ids) rows.

    Every id meets the table of token bytes, which has one row an id of the vocabulary and is
    the same for any corpus.
    """
    ranks = shared_file(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(ranks.value).items()}
        spelled = {rank: str(rank) for rank in table}
        for batch in batches:
            rows = []
            for raw in batch["ids"]:
                ids = np.frombuffer(raw.as_py(), "<u4").tolist()
                decimals = " ".join(map(spelled.__getitem__, ids)).encode()
                text = b"".join(map(table.__getitem__, ids))
                rows.append((
                    len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(text).hexdigest()
                ))
            n, ids_hash, text_hash = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                 pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def decode_texts(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows; bytes that are not UTF-8 are replaced."""
    ranks = shared_file(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(ranks.value).items()}
        for batch in batches:
            found = [
                b"".join(map(table.__getitem__, np.frombuffer(raw.as_py(), "<u4").tolist()))
                for raw in batch["ids"]
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x.decode(errors="replace") for x in found], pa.string())],
                ["doc_id", "text"],
            )

    return encoded.mapInArrow(run, "doc_id long, text string")
