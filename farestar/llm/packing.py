"""Packing documents into fixed windows by non-negative least squares.

A document's ids are cut into whole windows and one tail shorter than a window.  Only the
histogram of tail lengths (at most one count a length) reaches the driver: combinations of two
or three lengths that fill a window exactly are enumerated, their repeat counts are solved
against the histogram by non-negative least squares, rounded and held to what is there.  What
they leave is packed greedily, longest first, cut where a window ends.  Every place follows
from a tail's rank among those of its length, so placing is map-side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts, tidy, written
from farestar.llm.scan import running_totals
from farestar.llm.tokens import byte_coder, byte_vocabulary, space_words
from farestar.llm.wordshuffle import BLOCK_CHARS, encode_blocks

WINDOW = 2048
#: Of the combinations of three, the middle length is a multiple of window / TRIPLE_STEPS.
TRIPLE_STEPS = 256
ITERATIONS = 300

CUT = (
    "doc_id long, block long, packet int, tail int, nth long, windows_before long, n_ids long,"
    " width int, ids binary"
)
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


@dataclass(frozen=True)
class Plan:
    """Where the tails of each length go, by rank."""

    window: int
    first: np.ndarray  # of each length: its first entry in the arrays below; one more at the end
    until: np.ndarray  # ranks below this belong to the entry (running count within the length)
    sequence: np.ndarray  # sequence of the entry's first repeat
    offset: np.ndarray  # place of the tail in that sequence
    planned: np.ndarray  # of each length: how many tails have an entry
    stream: np.ndarray  # of each length: place of its first leftover tail in the greedy stream
    stream_sequence: int  # the sequence at which the greedy stream begins
    end: int  # number of sequences

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the pieces of one tail."""
        if rank < self.planned[length]:
            low, high = self.first[length], self.first[length + 1]
            entry = low + int(np.searchsorted(self.until[low:high], rank, side="right"))
            before = self.until[entry - 1] if entry > low else 0
            return [(int(self.sequence[entry] + rank - before), int(self.offset[entry]), length)]
        at = int(self.stream[length] + (rank - self.planned[length]) * length)
        head = min(length, self.window - at % self.window)
        pieces = [(self.stream_sequence + at // self.window, at % self.window, head)]
        if head < length:
            pieces.append((pieces[0][0] + 1, 0, length - head))
        return pieces


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of two or three of the lengths (0: none) that add up to the window, ascending."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    there[0] = False
    low = np.arange(1, window // 2 + 1)
    low = low[there[low] & there[window - low]]
    pairs = np.stack([np.zeros_like(low), low, window - low], axis=1)
    middle = np.arange(1, window, max(1, window // TRIPLE_STEPS))
    a, b = (x.ravel() for x in np.meshgrid(lengths, middle[there[middle]], indexing="ij"))
    c = window - a - b
    fits = (c > 0) & there[np.maximum(c, 0)]
    triples = np.sort(np.stack([a[fits], b[fits], c[fits]], axis=1), axis=1)
    return np.unique(np.concatenate([pairs, triples]), axis=0).astype(np.int64)


def least_squares(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 for which the lengths used come closest to the histogram.

    Accelerated projected gradient on |A x - h|^2, where column k of A counts the lengths of
    combination k; A is never built, its products are gathers and bin counts.
    """
    target = histogram.astype(float)
    target[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        total = np.bincount(combos.ravel(), np.repeat(x, combos.shape[1]), len(target))
        total[0] = 0
        return total

    x = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        x = used(x)[combos].sum(1)
        scale = np.linalg.norm(x)
        x /= scale
    x = np.zeros(len(combos))
    ahead, momentum = x, 1.0
    for _ in range(ITERATIONS):
        moved = np.maximum(ahead - (used(ahead) - target)[combos].sum(1) / (1.05 * scale), 0)
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead, x, momentum = moved + (momentum - 1) / grown * (moved - x), moved, grown
    return x


def make_plan(histogram: np.ndarray, whole_windows: int, window: int = WINDOW) -> Plan:
    """Plan the tails of a histogram (index: length); sequences start after the whole windows."""
    histogram = histogram.astype(np.int64)
    combos = combinations(np.flatnonzero(histogram[1:]) + 1, window)
    left = histogram.copy()
    counts = np.zeros(len(combos), np.int64)
    if len(combos):
        solved = np.rint(least_squares(combos, histogram)).astype(np.int64)
        for k in np.argsort(-solved, kind="stable"):
            if not solved[k]:
                break
            lengths, times = np.unique(combos[k][combos[k] > 0], return_counts=True)
            counts[k] = min(solved[k], int((left[lengths] // times).min()))
            left[lengths] -= counts[k] * times
    used = np.flatnonzero(counts)
    base = whole_windows + np.concatenate([[0], np.cumsum(counts[used])])
    chosen = combos[used]
    place = np.cumsum(chosen, axis=1) - chosen
    length = chosen.ravel()
    order = np.argsort(length, kind="stable")
    order = order[length[order] > 0]
    sorted_length = length[order]
    first = np.searchsorted(sorted_length, np.arange(window + 2))
    repeats = np.repeat(counts[used], 3)[order]
    running = np.cumsum(repeats)
    before = np.concatenate([[0], running])[first[sorted_length]]
    descending = (left * np.arange(len(left)))[::-1]
    stream = (np.cumsum(descending) - descending)[::-1]
    stream_sequence = int(base[-1])
    return Plan(
        window, first, running - before, np.repeat(base[:-1], 3)[order], place.ravel()[order],
        histogram - left, stream, stream_sequence,
        stream_sequence + -(-int(descending.sum()) // window),
    )


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The ids of every document, its tail length and the tail's number in its packet."""
    end = np.array([end_id], np.uint32)

    def finish(block: int, packet: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        seen: dict[int, int] = {}
        windows, rows = 0, []
        for doc_id, found in zip(doc_ids, ids):
            found = np.concatenate([found, end])
            whole, tail = divmod(len(found), window)
            width = 2 if found.max() < 1 << 16 else 4
            nth = seen[tail] = seen.get(tail, -1) + 1
            rows.append((
                doc_id, block, packet, tail, nth, windows, len(found), width,
                found.astype(f"<u{width}").tobytes(),
            ))
            windows += whole
        kinds = (*[pa.int64()] * 2, *[pa.int32()] * 2, *[pa.int64()] * 3, pa.int32(), pa.binary())
        names = [field.split()[0] for field in CUT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return encode_blocks(
        texts(docs), space_words, byte_coder, byte_vocabulary(docs.sparkSession, tokenizer), finish, CUT,
        purpose="cut_documents", block_chars=block_chars,
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Every piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each sequence is filled from offset 0 without gaps; all but the last hold exactly
    ``window`` ids.  NULL and empty texts are the end id alone; repeated rows and NULL doc_ids
    are packed like any other; an empty table gives no piece.  A task holds ``block_chars`` of text
    at once; with fewer, a word crosses the network more often.
    """
    cut = cut_documents(docs, tokenizer, end_id, window, block_chars)
    counts = written(
        cut.groupBy("block", "packet", "tail").agg(
            F.count("*").alias("n"), F.expr(f"sum(n_ids div {window})").alias("windows")
        ),
        "tail_counts",
    )
    histogram = np.zeros(window, np.int64)
    whole = 0
    lengths = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows"))
    for row in lengths.collect():  # at most one row a length
        histogram[row["tail"]] = row["n"]
        whole += row["windows"]
    plan = docs.sparkSession.sparkContext.broadcast(astuple(make_plan(histogram, whole, window)))
    packet_windows = running_totals(
        counts.groupBy("block", "packet").agg(F.sum("windows").alias("windows")), ["block", "packet"], ["windows"]
    ).select("block", "packet", F.col("windows_before").alias("windows_base"))
    bases = running_totals(
        counts.select("block", "packet", "tail", "n"), ["block", "packet"], ["n"], group=["tail"]
    ).select("block", "packet", "tail", F.col("n_before").alias("nth_base")).join(packet_windows, ["block", "packet"])
    # The bases grow with the corpus, so this join is never a broadcast, however small they are.
    bases = written(bases, "tail_bases").hint("merge")
    placed = cut.join(bases, ["block", "packet", "tail"]).select(
        "doc_id", "tail", "n_ids", "width", "ids",
        (F.col("nth") + F.col("nth_base")).alias("rank"),
        (F.col("windows_before") + F.col("windows_base")).alias("window_id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Plan(*plan.value)
        for batch in batches:
            rows = []
            names = ("doc_id", "tail", "n_ids", "width", "ids", "rank", "window_id")
            for doc_id, tail, n, width, raw, rank, at in zip(*(batch[c].to_pylist() for c in names)):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                places = [(at + i, 0, window) for i in range(n // window)]
                if tail:
                    places += known.place(tail, rank)
                start = 0
                for sequence, offset, length in places:
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    rows.append((doc_id, start, length, crc, n, sequence, offset))
                    start += length
            names = [field.split()[0] for field in PIECES.split(", ")]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return placed.mapInArrow(tidy(run), PIECES)
