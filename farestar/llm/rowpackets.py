"""Rows (document, place, key, other) that tasks send to the owners of parts, in packets.

A packet holds rows of one kind for one part: a task that meets B blocks and P parts sends a packet
for each part it has rows for whenever HELD rows have come together, not for each block.  Packets are
made and read many at a time, straight from and into Arrow's buffers, so a small packet costs no
more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A task sends its rows on when it holds so many.
HELD = 1 << 18
#: A packet has at most so many rows, an Arrow batch of packets about so many bytes.
PACKET_ROWS, BATCH_BYTES = 1 << 18, 1 << 21

PACKET = "kind int, part int, size int, docs binary, places binary, keys binary, others binary"
_NAMES = [field.split()[0] for field in PACKET.split(", ")]

#: (kind, part, document, place, key, other) of some rows: a number and five arrays.
Rows = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned 64-bit numbers as little-endian groups of seven bits, and where each ends."""
    size = np.ones(len(values), np.int64)
    for width in range(1, 10):
        more = values >= np.uint64(1 << 7 * width)
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    if not len(values) or ends[-1] == len(values):
        return values.astype(np.uint8), ends
    raw, first = np.empty(int(ends[-1]), np.uint8), ends - size
    raw[first] = values & np.uint64(127)
    rows, i = np.flatnonzero(size > 1), 1
    while len(rows):
        at = first[rows] + i
        raw[at - 1] |= 128
        raw[at] = (values[rows] >> np.uint64(7 * i)) & np.uint64(127)
        i += 1
        rows = rows[size[rows] > i]
    return raw, ends


def from_varints(raw: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(raw < 128)
    if len(last) == len(raw):
        return raw.astype(np.uint64)
    first = np.concatenate([[0], last[:-1] + 1])
    values = (raw[first] & 127).astype(np.uint64)
    rows, i = np.flatnonzero(first < last), 1
    while len(rows):
        at = first[rows] + i
        values[rows] |= (raw[at] & 127).astype(np.uint64) << np.uint64(7 * i)
        i += 1
        rows = rows[at < last[rows]]
    return values


def _steps(values: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as differences from the one before, from 0 at heads; they may wrap around."""
    values = values.astype(np.int64)
    step = np.diff(values, prepend=0)
    step[head] = values[head]
    return varints((step << 1 ^ step >> 63).view(np.uint64))


def _walked(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    values = from_varints(raw)
    step = (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)
    total = np.cumsum(step)
    head = np.cumsum(sizes) - sizes
    return total - np.repeat(total[head] - step[head], sizes)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Numbers, of which there is at least one, in 32 bits if they fit."""
    fit = np.iinfo(np.int32)
    return values.astype(np.int32) if values.min() >= fit.min and values.max() <= fit.max else values


def _binary(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)]
    )


def _batches(kind: int, hashed: bool, pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
    part, doc, place, key, other = (np.concatenate(c) for c in zip(*pieces))
    pieces.clear()
    order = np.lexsort((place, doc, part) if hashed else (place, key, doc, part))
    part = part[order]
    at = np.arange(len(part))
    fresh = np.diff(part, prepend=-1) != 0
    head = np.flatnonzero(fresh | ((at - np.maximum.accumulate(np.where(fresh, at, 0))) % PACKET_ROWS == 0))
    edges = np.append(head, len(part))
    columns = [np.full(len(head), kind, np.int32), part[head], np.diff(edges).astype(np.int32)]
    sent = np.zeros(len(head), np.int64)
    for name, values in (("doc", doc), ("place", place), ("key", key), ("other", other)):
        values = values[order]
        if name == "key" and hashed:
            raw, stops = values.view(np.uint8), edges * values.itemsize
        else:
            raw, ends = _steps(values, head)
            stops = np.append(0, ends)[edges]
        columns.append(_binary(raw, stops))
        sent += np.diff(stops)
    batch = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], _NAMES)
    cuts = np.flatnonzero(np.diff((np.cumsum(sent) - sent) // BATCH_BYTES, prepend=-1))
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(head)]):
        yield batch.slice(low, high - low)


def packed(rows: Iterator[Rows], hashed: dict[int, type]) -> Iterator[pa.RecordBatch]:
    """The packets of rows.  ``hashed`` has the kinds whose keys are hashes, and their type; the
    keys of other kinds are numbers that repeat."""
    held, size = {}, 0
    for kind, part, doc, place, key, other in rows:
        if not len(part):
            continue
        held.setdefault(kind, []).append((
            part.astype(np.int32), doc, _narrow(place), key.astype(hashed.get(kind, np.int64), copy=False),
            _narrow(other),
        ))
        size += len(part)
        if size >= HELD:
            while held:
                kind, pieces = held.popitem()
                yield from _batches(kind, kind in hashed, pieces)
            size = 0
    while held:
        kind, pieces = held.popitem()
        yield from _batches(kind, kind in hashed, pieces)


def _content(column: pa.Array, low: int, high: int) -> np.ndarray:
    """The bytes of some values of a binary column, one after another."""
    _, edges, raw = column.buffers()
    edges = np.frombuffer(edges, np.int32)[column.offset + low:column.offset + high + 1]
    return np.frombuffer(raw, np.uint8)[edges[0]:edges[-1]]


def received(batches: Iterator[pa.RecordBatch], hashed: dict[int, type]) -> Iterator[tuple[int, dict]]:
    """(part, {kind: [document, place, key, other]}) of each part of packets sorted by part and kind."""
    part, held = None, {}

    def finish() -> tuple[int, dict]:
        found = {}
        while held:
            kind, pieces = held.popitem()
            found[kind] = [
                np.concatenate([p[i] for p in pieces], dtype=hashed.get(kind, np.int64) if i == 2 else np.int64)
                for i in range(4)
            ]
        return part, found

    for batch in batches:
        parts, kinds, sizes = (batch[c].to_numpy() for c in ("part", "kind", "size"))
        if not len(parts):
            continue
        cuts = np.flatnonzero(np.append(True, (np.diff(parts) != 0) | (np.diff(kinds) != 0)))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(parts)]):
            if parts[low] != part:
                if held:
                    yield finish()
                part = int(parts[low])
            kind, mine = int(kinds[low]), sizes[low:high].astype(np.int64)
            doc, place, key, other = (_content(batch[c], low, high) for c in ("docs", "places", "keys", "others"))
            held.setdefault(kind, []).append((
                _walked(doc, mine), _narrow(_walked(place, mine)),
                key.view(hashed[kind]).copy() if kind in hashed else _walked(key, mine), _narrow(_walked(other, mine)),
            ))
    if held:
        yield finish()


def dealt(packets: DataFrame, parts: int) -> DataFrame:
    return packets.repartition(parts, "part").sortWithinPartitions("part", "kind")
