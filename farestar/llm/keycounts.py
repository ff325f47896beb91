"""Counts of 64-bit keys over the corpus, sent back to the blocks that asked.

A block of documents sends its distinct keys and how often it has each, in packets by bucket.  The
owner of a bucket adds up its packets, so it holds each distinct key once, and answers every
packet with the totals of its keys.  A key in all documents is one number a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: A task merges the keys it has gathered when there are so many.
GATHERED = 1 << 21

ROW = (
    "block long, kind int, part int, keys binary, counts binary, places binary, doc_ids array<long>,"
    " numbers array<long>, sizes array<int>, hashes array<string>"
)
_ARROW = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()),
    ("counts", pa.binary()), ("places", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("numbers", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("hashes", pa.list_(pa.string())),
])
#: Kinds of rows: a bucket's totals, a packet of keys or its answer, documents of a block.
TOTALS, KEYS, DOCS = range(3)


def _cell(value, kind: pa.DataType) -> pa.Array:
    if isinstance(value, np.ndarray):
        return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), pa.array(value, kind.value_type))
    return pa.array([value], kind)


def row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_cell(values.get(f.name), f.type) for f in _ARROW], schema=_ARROW)


def squeeze(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<i8").tobytes(), 3)


def restore(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), "<i8")


def packets(block: int, keys: np.ndarray, counts: np.ndarray, owner: np.ndarray, places: Callable | None = None):
    """The packets of one block; the keys of a bucket keep the order given."""
    order = np.argsort(owner, kind="stable")
    ranked = owner[order]
    heads = np.flatnonzero(np.diff(ranked, prepend=-1))
    for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
        mine = order[low:high]
        yield row(
            block=block, kind=KEYS, part=int(ranked[low]), keys=squeeze(keys[mine]),
            counts=squeeze(counts[mine]), places=places(mine) if places else None,
        )


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, where, np.concatenate(counts))
    return distinct, total


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of every bucket, its keys ascending: one row a bucket."""
    part, keys, counts, size = None, [], [], 0

    def finish() -> pa.RecordBatch:
        distinct, total = _merged(keys, counts)
        return row(kind=TOTALS, part=part, keys=squeeze(distinct), counts=squeeze(total))

    for batch in batches:
        for i in range(batch.num_rows):
            if batch["part"][i].as_py() != part:
                if keys:
                    yield finish()
                part, keys, counts, size = batch["part"][i].as_py(), [], [], 0
            keys.append(restore(batch["keys"][i].as_py()))
            counts.append(restore(batch["counts"][i].as_py()))
            size += len(keys[-1])
            if size > GATHERED + 2 * len(keys[0]):
                keys, counts = ([x] for x in _merged(keys, counts))
                size = len(keys[0])
    if keys:
        yield finish()


def dealt(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "part").sortWithinPartitions("part", "kind", "block")


def answers(asked: DataFrame, buckets: int, view: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Every packet of ``asked`` with ``view`` (keys, totals) of its keys as counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = total = None
        for batch in batches:
            for i in range(batch.num_rows):
                found, counts = (restore(batch[c][i].as_py()) for c in ("keys", "counts"))
                if batch["kind"][i].as_py() == TOTALS:
                    keys, total = found, view(found, counts)
                    continue
                yield row(
                    block=batch["block"][i].as_py(), kind=KEYS, part=batch["part"][i].as_py(),
                    keys=batch["keys"][i].as_py(), places=batch["places"][i].as_py(),
                    counts=squeeze(total[np.searchsorted(keys, found)]),
                )

    summed = dealt(asked, buckets).mapInArrow(totals, ROW)
    return dealt(summed.unionByName(asked), buckets).mapInArrow(run, ROW)
