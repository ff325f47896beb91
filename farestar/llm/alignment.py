"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers' tokens of a text are laid over its bytes.  Places where a token of either ends
cut the text into groups, found by divide and conquer: a common end near the middle of an
interval is located by bisection, both halves are cut in turn, and an interval without one is a
group.  Single spaces between other characters are such cuts from the start (no token of either
spans them), so each distinct unit between them is aligned once a task.

How many documents hold an id pair linked is counted over the corpus by a shuffle of the blocks'
distinct pairs: 1. a block of texts counts its pairs, 2. the owner of a pair's first id sums
them, finds the highest of each first id and sends both back to the blocks, 3. the blocks'
documents, kept as positions into the pairs, are summed up.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts
from farestar.llm.keycounts import DOCS, KEYS, ROW, answers, dealt, packets, restore, row, squeeze, totals
from farestar.llm.tokens import byte_coder, byte_vocabulary, shared_file, space_units, token_bytes
from farestar.llm.wordshuffle import blocks_of, bucket_count, by_block, pack_numbers, unpack_numbers
from farestar.session import scratch_folder

#: A block's texts have at most this many characters; a longer text is a block by itself.
BLOCK_CHARS = 6 << 20
#: Documents a row of a block.
PACKET_DOCS = 4096
#: The longest aligned unit that a task remembers.
CACHED_BYTES = 64
#: Links of a group that are listed one by one.
LARGE_GROUP = 64
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# --- one text --------------------------------------------------------------------------------


def _cut(a: list[int], b: list[int], lo: int, hi: int, low: int, high: int) -> tuple[int, int] | None:
    """The common end nearest the middle of a[lo:hi], before the last: its places in a and b."""
    last, end = hi - 1, high - 1
    if last <= lo or end <= low:
        return None
    middle = (lo + last) // 2
    for step in range(last - lo + 1):
        for i in (middle - step, middle + step) if step else (middle,):
            if lo <= i < last:
                j = bisect_left(b, a[i], low, end)
                if j < end and b[j] == a[i]:
                    return i, j
    return None


def groups(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Token ranges (from, to, from, to) of the groups of two lists of token ends, in order.

    Both lists ascend strictly and end at the same byte.
    """
    if len(a) == 1 or len(b) == 1:
        return [(0, len(a), 0, len(b))]
    found, waiting = [], [(0, len(a), 0, len(b))] if a else []
    while waiting:
        lo, hi, low, high = waiting.pop()
        cut = _cut(a, b, lo, hi, low, high)
        if cut is None:
            found.append((lo, hi, low, high))
        else:
            i, j = cut
            waiting += [(i + 1, hi, j + 1, high), (lo, i + 1, low, j + 1)]
    return found


class Aligner:
    """Aligns units: token counts, groups, their text, and how often each id pair is linked."""

    def __init__(self, a: tuple, b: bytes):
        import sentencepiece

        self._a = byte_coder(a, plain=True)
        self._a_bytes = token_bytes(a[0])
        model = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [model.id_to_piece(i) for i in range(len(model))]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("a piece spans a single space, so units cannot be encoded by themselves")
        self._b = lambda words: model.encode([word.decode() for word in words], num_threads=1)
        self._b_bytes = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self._a_shown, self._b_shown = ([str(i) for i in range(len(x))] for x in (self._a_bytes, self._b_bytes))
        self._known: dict[bytes, tuple | None] = {}

    def of_units(self, units: list[bytes]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, n_links, text, pairs, times) of each distinct unit of a block.

        None if a tokenizer's bytes are not those of a space and the unit.  Pairs are 64-bit
        numbers as bytes; times is None if each is linked once.  Units of the block before are
        remembered.
        """
        known = {unit: self._known[unit] for unit in units if unit in self._known}
        fresh = [unit for unit in units if unit not in known]
        for low in range(0, len(fresh), 1 << 14):
            some = fresh[low:low + (1 << 14)]
            for unit, a, b in zip(some, self._a([b" " + unit for unit in some]), self._b(some)):
                known[unit] = self._align(b" " + unit, a, b)
        self._known = {unit: x for unit, x in known.items() if len(unit) <= CACHED_BYTES}
        return [known[unit] for unit in units]

    def _align(self, raw: bytes, a: list[int], b: list[int]) -> tuple | None:
        ours, theirs = [self._a_bytes[i] for i in a], [self._b_bytes[i] for i in b]
        if b"".join(ours) != raw or b"".join(theirs) != raw:
            return None
        found = groups(list(accumulate(map(len, ours))), list(accumulate(map(len, theirs))))
        shown, pairs, times, total = [], [], None, 0
        shown_a, shown_b = [self._a_shown[i] for i in a], [self._b_shown[i] for i in b]
        for lo, hi, low, high in found:
            shown.append(f"{','.join(shown_a[lo:hi])}|{','.join(shown_b[low:high])}")
            links = (hi - lo) * (high - low)
            total += links
            if links == 1:
                pairs.append(a[lo] << 32 | b[low])
            elif links <= LARGE_GROUP:
                pairs += [i << 32 | j for i in a[lo:hi] for j in b[low:high]]
            else:  # each id once, with how often it is there
                times = [1] * len(pairs) if times is None else times + [1] * (len(pairs) - len(times))
                right = Counter(b[low:high])
                for i, m in Counter(a[lo:hi]).items():
                    pairs += [i << 32 | j for j in right]
                    times += [m * n for n in right.values()]
        if times is not None:
            times = array("q", times + [1] * (len(pairs) - len(times))).tobytes()
        return len(a), len(b), len(found), total, ";".join(shown), array("q", pairs).tobytes(), times


# --- blocks of texts -------------------------------------------------------------------------


def _of_block(
    block: int, doc_ids: list, values: pa.Array, split, aligner: Aligner, buckets: int
) -> Iterator[pa.RecordBatch]:
    """A block's pairs by bucket of their first id, and its documents as positions into the pairs."""
    sizes, numbers, units = split(values)
    aligned = aligner.of_units(units.to_pylist())
    bad = np.array([x is None for x in aligned], bool)
    aligned = [x or (0, 0, 0, 0, "", b"", None) for x in aligned]
    measures = np.array([x[:4] for x in aligned], np.int64).reshape(-1, 4)
    width = np.array([len(x[5]) // 8 for x in aligned], np.int64)
    first = np.cumsum(width) - width
    keys, key = np.unique(np.frombuffer(b"".join([x[5] for x in aligned]), np.int64), return_inverse=True)
    times = np.ones(len(key), np.int64)
    for i, x in enumerate(aligned):
        if x[6] is not None:
            times[first[i]:first[i] + width[i]] = np.frombuffer(x[6], np.int64)
    shown = [x[4] for x in aligned]
    del aligned
    empty = (pc.utf8_length(values).to_numpy(zero_copy_only=False) == 0).tolist()

    holders = np.zeros(len(keys), np.int64)
    packed, rows, at = [], [], 0
    for doc_id, size, nothing in zip(doc_ids, sizes.tolist(), empty):
        stream = numbers[at:at + size]
        at += size
        if nothing or bad[stream].any():
            rows.append((doc_id, [0] * 4, "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
        else:
            held, often = np.unique(stream, return_counts=True)
            many = width[held]
            place = np.repeat(first[held] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            linked, where = np.unique(key[place], return_inverse=True)
            count = np.bincount(where, times[place] * np.repeat(often, many), len(linked)).astype(np.int64)
            holders[linked] += 1
            digest = hashlib.sha256(";".join(map(shown.__getitem__, stream.tolist())).encode()).hexdigest()
            rows.append((doc_id, (measures[held] * often[:, None]).sum(0).tolist(), digest, linked, count))
        if len(rows) == PACKET_DOCS:
            packed.append(rows)
            rows = []
    packed += [rows] if rows else []

    # Positions in descending frequency are small numbers where documents have many of them.
    position = np.empty(len(keys), np.int64)
    position[np.argsort(-holders, kind="stable")] = np.arange(len(keys))
    for part, rows in enumerate(packed):
        ids, own, hashes, linked, count = zip(*rows)
        yield row(
            block=block, kind=DOCS, part=part, doc_ids=list(ids), hashes=list(hashes),
            numbers=[n for m in own for n in m], sizes=[len(x) for x in linked],
            places=pack_numbers(position[np.concatenate(linked)]), counts=squeeze(np.concatenate(count)),
        )
    held = np.flatnonzero(holders)
    held = held[np.argsort(position[held])]
    yield from packets(
        block, keys[held], holders[held], _bucket(keys[held], buckets),
        lambda mine: pack_numbers(np.diff(position[held[mine]], prepend=0)),
    )


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The owner of each pair: all pairs of a first id have one."""
    return ((keys >> 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets


def _signed(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The count of each pair (ascending), negative unless it is its first id's highest."""
    head = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
    highest = np.repeat(np.maximum.reduceat(counts, head), np.diff(np.append(head, len(keys))))
    return np.where(counts == highest, counts, -counts)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each block, whose pairs come first."""
    block, places, signed, known = None, [], [], None
    names = [field.split()[0] for field in RESULT.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            got = {name: batch[name][i].as_py() for name in batch.schema.names}
            if got["block"] != block:
                block, places, signed, known = got["block"], [], [], None
            if got["kind"] == KEYS:
                places.append(np.cumsum(unpack_numbers(got["places"]), dtype=np.int64))
                signed.append(restore(got["counts"]))
                continue
            if known is None:
                known = np.zeros(sum(map(len, places)), np.int64)
                for where, values in zip(places, signed):
                    known[where] = values
                places, signed = [], []
            found = known[unpack_numbers(got["places"])] if len(known) else np.zeros(0, np.int64)
            times, ends = restore(got["counts"]), np.cumsum([0, *got["sizes"]])
            sums = [
                np.diff(np.concatenate([[0], np.cumsum(values)])[ends])
                for values in (np.where(found > 0, times, 0), np.abs(found) * times)
            ]
            own = np.array(got["numbers"], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["doc_ids"], pa.int64()), *map(pa.array, [*own.T, *sums]),
                 pa.array(got["hashes"], pa.string())],
                names,
            )


def align(docs: DataFrame, byte_file: str, piece_file: str, buckets: int | None = None) -> DataFrame:
    """n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    A text with a space before it is encoded by the byte-level file (A), the text by the piece
    model (B), which adds that space.  A NULL or empty text, or one that a tokenizer's tokens do
    not spell byte by byte, has no tokens: all zeros and an empty hash.  Each row counts as a
    document, also a repeated one or one without doc_id.
    """
    spark = docs.sparkSession
    source = texts(docs)
    buckets = buckets or bucket_count(source)
    first, second = byte_vocabulary(spark, byte_file), shared_file(spark, piece_file)
    folder = scratch_folder(spark, "alignment_blocks")
    _split(source, first, second, buckets, folder)
    blocks = spark.read.schema(ROW).parquet(folder)
    both = answers(blocks.where(F.col("kind") == KEYS), buckets, _signed).unionByName(
        blocks.where(F.col("kind") == DOCS)
    )
    return by_block(both, blocks, "part").mapInArrow(_sums, RESULT)


def _split(source: DataFrame, first: Broadcast, second: Broadcast, buckets: int, folder: str) -> None:
    """Step 1, written: the pairs and documents of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, aligner = space_units(), Aligner(first.value, second.value)
        for block, doc_ids, values in blocks_of(batches, BLOCK_CHARS):
            yield from _of_block(block, doc_ids, values, split, aligner, buckets)

    parted = source.withColumn("part", F.spark_partition_id().cast("long"))
    parted.mapInArrow(run, ROW).write.parquet(folder)


def id_pairs(docs: DataFrame, byte_file: str, piece_file: str, buckets: int | None = None) -> DataFrame:
    """(a, b, n_docs, best): every linked id pair, how many documents hold it, whether it is A's highest."""
    spark = docs.sparkSession
    source = texts(docs)
    buckets = buckets or bucket_count(source)
    first, second = byte_vocabulary(spark, byte_file), shared_file(spark, piece_file)
    folder = scratch_folder(spark, "alignment_blocks")
    _split(source, first, second, buckets, folder)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch["keys"], batch["counts"]):
                key, n = restore(pairs.as_py()), restore(counts.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(n)], ["a", "b", "n_docs"]
                )

    pairs = spark.read.schema(ROW).parquet(folder).where(F.col("kind") == KEYS)
    found = dealt(pairs, buckets).mapInArrow(totals, ROW).select("keys", "counts").mapInArrow(
        spread, "a long, b long, n_docs long"
    )
    highest = found.groupBy("a").agg(F.max("n_docs").alias("highest"))  # at most one row an id
    return found.join(highest, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))
