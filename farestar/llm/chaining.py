"""Substring dedup by collinear chaining of shared k-mers.

Seeds are word k-mers picked by their hash alone, so a k-mer that two documents share is a seed of
both, whatever stands around it.  An occurrence of a seed is matched with the first OWNERS earlier
documents that have it, so a seed of few documents is matched with all of them.  Matches of a
document with an owner on one diagonal are runs; runs that keep their order are chained, gaps
cost; chains are aligned on the words to find passages that repeat, also with differences.  The
first document keeps a passage.

Frequent seeds, which more documents have, are matched once more by twos: two seeds of a document
that stand APART words, one of them frequent, are a key, and words that are not yet in a passage
are matched with all earlier documents that have their key.  A line that n documents have is n * n / 2
such matches, so they are looked at in bulk, by the words around them: only where a passage may be long
enough are two documents chained and aligned.

Runs of MIN_WORDS equal words do not depend on chains: every one that an earlier document has is
found by its hash, among the runs whose picked longer seed another document has.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import free_shuffles, texts, tidy, written, written_to
from farestar.llm.rowpackets import PACKET, Rows, dealt, packed, received
from farestar.llm.shingles import CACHED_WORDS, mix, word_hashes
from farestar.llm.wordshuffle import blocks_of, bucket_count
from farestar.session import scratch_folder

#: Words of a seed; of all k-mers one in PICK is a seed.
KMER, PICK = 5, 3
#: So many earlier documents are matched with an occurrence of a seed: all there are, of a seed
#: that no more than OWNERS + 1 documents have.  Other seeds are frequent.
OWNERS = 3
#: Two seeds so many words apart, at least and at most, are a key if one of them is frequent.
APART = 30, 60
#: So many matches by keys are put together at a time, and by one task for one key.
MATCHED, KEY_MATCHES = 1 << 18, 1 << 24
#: So many words on either side of a key tell how far a passage may go on there; a key is seen with them.
AROUND = 24
SEEN = 2 * AROUND + APART[1] + KMER
#: So many matches at a time are compared word by word.
COMPARED = 1 << 12
#: A repeated passage has at least so many words, and so large a share of them matches.
MIN_WORDS, MIN_MATCH = 50, 0.75
#: Cost of a word of gap on either side, in words of score.
GAP_COST = 0.02
MIN_ANCHORS = 2
#: Matches on one diagonal at most so many words apart are one run.
RUN_GAP = 16
#: A passage ends where more than so many words in a row do not match.
MAX_LOST = 20
#: Beyond its outer seeds a passage goes on while equal words (1 each) are not outweighed by others
#: (MISS each) by more than DROP.
MISS, DROP = 2, 12
MARGIN, GRID = 64, 16
#: A block's texts have at most this many characters; a longer text is a block by itself.  A task
#: holds about 40 bytes a character of its block.
BLOCK_CHARS = 1 << 22
#: Bytes of text for each bucket of seeds, which a task holds whole.
BUCKET_BYTES = 1 << 25
#: Words of a seed of exact runs; every run of MIN_WORDS words holds a picked one.
EXACT_KMER = 20

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def seeds(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and place of the picked k-mers of documents' word hashes, one after another."""
    count = len(words) - KMER + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(count, np.uint64)
    for shift in range(KMER):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[shift:shift + count])
    ends = np.cumsum(sizes)
    picked = np.flatnonzero(value % np.uint64(PICK) == 0)
    doc = np.searchsorted(ends, picked, side="right")
    inside = picked + KMER <= ends[doc]
    picked, doc = picked[inside], doc[inside]
    return value[picked], doc, picked - (ends - sizes)[doc]


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, put together from runs of doubling length."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    times = np.uint64(0x9E3779B97F4A7C15)
    found, at, width = np.zeros(count, np.uint64), 0, 1
    while True:
        if size & width:
            found = mix(found * times + words[at:at + count])
            at += width
        if 2 * width > size:
            return found
        words = mix(words[:-width] * times + words[width:])
        width *= 2


def least_of_runs(value: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row, by runs of doubling length."""
    width = 1
    while 2 * width <= size:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    return np.minimum(value[:len(value) - (size - width)], value[size - width:])


def _owned(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner (the first document of the key) and owner place of rows sorted by all three.

    The n-th occurrence in a document meets the n-th in its owner, or the last, so that text
    which repeats itself keeps its order.
    """
    at = np.arange(len(key))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    start = fresh | np.concatenate([[True], doc[1:] != doc[:-1]])
    distinct = start | np.concatenate([[True], place[1:] != place[:-1]])
    head = np.maximum.accumulate(np.where(fresh, at, 0))
    first = np.maximum.accumulate(np.where(start, at, 0))
    number = np.cumsum(distinct) - 1
    begin = np.flatnonzero(start)
    places = np.zeros(len(key), np.int64)
    places[begin] = np.diff(np.append(number[begin], number[-1] + 1))
    nth = np.minimum(number - number[first], places[head] - 1)
    return doc[head], place[np.flatnonzero(distinct)[number[head] + nth]]


def _once(*columns: np.ndarray) -> list[np.ndarray]:
    """Rows sorted by their columns, the first one first; a repeated row has its places only once."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.concatenate([[True], np.logical_or.reduce([np.diff(c) != 0 for c in columns])])
    return [c[fresh] for c in columns]


def _holders(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by key and document: the rank of the document among those of its key, and
    the first row of its key and of the document there."""
    at = np.arange(len(key))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    start = fresh | np.concatenate([[True], doc[1:] != doc[:-1]])
    number = np.cumsum(start) - 1
    head = np.maximum.accumulate(np.where(fresh, at, 0))
    return number - number[head], head, np.maximum.accumulate(np.where(start, at, 0))


def _matches(key: np.ndarray, doc: np.ndarray, place: np.ndarray, late: np.ndarray | None = None):
    """(doc, place, owner, owner place) of rows sorted by all three with their first OWNERS documents.

    The n-th occurrence in a document meets the n-th in its owner, or the last, so that text which
    repeats itself keeps its order.  ``late`` marks the rows wanted.
    """
    rank, head, start = _holders(key, doc)
    begin = np.flatnonzero(start == np.arange(len(key)))  # of each document of each key
    first = np.searchsorted(begin, head)  # the group of the key's first document
    sizes = np.diff(np.append(begin, len(key)))
    nth = np.arange(len(key)) - start
    found = []
    for k in range(OWNERS):
        rows = np.flatnonzero((rank > k) if late is None else (rank > k) & late)
        owner = first[rows] + k
        other = begin[owner] + np.minimum(nth[rows], sizes[owner] - 1)
        found.append((doc[rows], place[rows], doc[other], place[other]))
    return [np.concatenate(x) for x in zip(*found)]


# --- rows (document, place, ...) dealt by a bucket of a key, then by one of the document ----------

SEEDS, MATCHES, RUNS, SPANS, EXACT, SHARED, TWOS, PAIRED = range(8)
#: Kinds whose keys are hashes; other keys are owners, or 0.
HASHED = {SEEDS: np.uint32, SHARED: np.uint32, SPANS: np.int64, EXACT: np.int64, TWOS: np.int64}


def _sent(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[Rows]]):
    """For mapInArrow: the packets of the rows that a task makes."""
    return tidy(lambda batches: packed(rows(batches), HASHED))


def _by_doc(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_key(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(8)).astype(np.int64) % buckets


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    return received(batches, HASHED)


def _passed(kind: int, part: int, rows: list[np.ndarray]) -> Rows:
    """Rows that were settled in their block go on to the bucket of their document."""
    return kind, np.full(len(rows[0]), part, np.int32), *rows


# --- candidates: matches of seeds, and spans that may hold exact runs -----------------------------


def _seed_rows(doc_ids: np.ndarray, words: np.ndarray, sizes: np.ndarray, buckets: int) -> Iterator[Rows]:
    """A block's seeds, dealt by their hash, and what is matched within the block.

    Of a seed only the first OWNERS + 1 documents of the block go on, and a mark that there are
    others; those have their owners here, and go to their documents as frequent ones.  Within a
    bucket 32 bits tell seeds apart; a clash is a match that no alignment keeps.
    """
    key, at, place = seeds(words, sizes)
    if not len(key):
        return
    key, doc, place = _once(key, doc_ids[at], place)
    rank, *_ = _holders(key, doc)
    late, more = rank > OWNERS, np.zeros_like(place)
    if late.any():
        own, at, owner, other = _matches(key, doc, place, late)
        yield MATCHES, _by_doc(own, buckets), own, at, owner, other
        own, many = doc[late], (key[late] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        yield SHARED, _by_doc(own, buckets), own, place[late], many, more[late]
        crowd = np.unique(key[late])
        key, doc, place = key[~late], doc[~late], place[~late]
        more = (crowd[np.minimum(np.searchsorted(crowd, key), len(crowd) - 1)] == key).astype(np.int64)
    short = (key >> np.uint64(32)).astype(np.uint32)
    part = (mix(key) % np.uint64(buckets)).astype(np.int64)
    yield SEEDS, part, doc, place, short, more


def _span_rows(doc_ids: np.ndarray, words: np.ndarray, sizes: np.ndarray, buckets: int) -> Iterator[Rows]:
    """Spans of runs of MIN_WORDS words with one picked seed of EXACT_KMER words, dealt by the seed.

    Where two documents of the block have it, the spans are settled, and one row without length
    says so to others.
    """
    whole = grams(words, EXACT_KMER)
    if len(whole) < MIN_WORDS - EXACT_KMER + 1:
        return
    value = least_of_runs(whole, MIN_WORDS - EXACT_KMER + 1)
    ends = np.cumsum(sizes)
    row_of = np.repeat(np.arange(len(sizes)), sizes)[:len(value)]
    inside = np.flatnonzero(np.arange(len(value)) + MIN_WORDS <= ends[row_of])
    if not len(inside):
        return
    value, row_of = value[inside], row_of[inside]
    head = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (np.diff(inside) > 1)]))
    key, at = value[head].view(np.int64), row_of[head]
    start = inside[head] - (ends - sizes)[at]
    length = np.diff(np.append(head, len(value))) - 1 + MIN_WORDS
    doc = doc_ids[at]
    order = np.lexsort((start, doc, key))
    key, doc, start, length = (x[order] for x in (key, doc, start, length))
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(head, len(key)))
    several = doc[head] != doc[head + size - 1]
    done = np.repeat(several, size)
    if done.any():
        own = doc[done]
        yield RUNS, _by_doc(own, buckets), own, start[done], np.zeros(len(own), np.int64), length[done]
    marks = head[several]
    key = np.concatenate([key[~done], key[marks]])
    yield (
        SPANS, _by_key(key, buckets), np.concatenate([doc[~done], doc[marks]]),
        np.concatenate([start[~done], start[marks]]), key,
        np.concatenate([length[~done], np.zeros(len(marks), np.int64)]),
    )


def _frequent(key: np.ndarray, doc: np.ndarray, crowd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key and document: whether several documents have the key, and more than
    OWNERS + 1.  Keys in ``crowd`` have more than are here."""
    rank, head, _ = _holders(key, doc)
    first = np.flatnonzero(head == np.arange(len(key)))
    sizes = np.diff(np.append(first, len(key)))
    last = np.maximum.reduceat(rank, first)
    many = (last > OWNERS) | np.isin(key[first], crowd)
    return np.repeat((last > 0) | many, sizes), np.repeat(many, sizes)


def _settled(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[Rows]:
    """Step 2: what the seeds of a bucket match, the seeds that several documents have, and the
    spans whose seed two documents have."""
    for part, kinds in _received(batches):
        for kind in (MATCHES, RUNS, SHARED):
            if kind in kinds:
                yield _passed(kind, part, kinds.pop(kind))
        if SEEDS in kinds:
            doc, place, key, more = kinds.pop(SEEDS)
            crowd = np.unique(key[more > 0])
            key, doc, place = _once(key, doc, place)
            own, at, owner, other = _matches(key, doc, place)
            if len(own):
                yield MATCHES, _by_doc(own, buckets), own, at, owner, other
                del own, at, owner, other
                several, many = _frequent(key, doc, crowd)
                key = key[several] & ~np.uint32(1) | many[several]
                doc, place = doc[several], place[several]
                yield SHARED, _by_doc(doc, buckets), doc, place, key, np.zeros_like(place)
        if SPANS in kinds:
            doc, start, key, length = kinds.pop(SPANS)
            order = np.lexsort((doc, key))
            doc, start, key, length = (x[order] for x in (doc, start, key, length))
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(head, len(key)))
            known = (np.minimum.reduceat(length, head) == 0) | (doc[head] != doc[head + size - 1])
            wanted = np.repeat(known, size) & (length > 0)
            if wanted.any():
                own = doc[wanted]
                yield RUNS, _by_doc(own, buckets), own, start[wanted], np.zeros(len(own), np.int64), length[wanted]


def _joined(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that touch, of each document, as one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    room = int(stop.max()) + 1  # keeps the running maximum of one document below the next one
    far = np.maximum.accumulate(stop + number * room) - number * room
    head = np.flatnonzero(np.concatenate([[True], (np.diff(number) > 0) | (start[1:] > far[:-1])]))
    return doc[head], start[head], far[np.append(head[1:], len(doc)) - 1]


_CANDIDATE = (
    "doc long, start int, stop int, owner long, owner_start int, owner_stop int, xs array<int>, ys array<int>,"
    " reach array<int>"
)
_CANDIDATE_KINDS = [pa.int64(), *[pa.int32()] * 2, pa.int64(), *[pa.int32()] * 2, *[pa.list_(pa.int32())] * 3]


def _candidates_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: the chains of a bucket of documents, their spans without an owner, and the seeds
    that each shares: places and keys (odd: of a frequent seed) as xs and ys of a row without span.

    Seeds that no frequent one stands near make no key and are left out.
    """
    names = [field.split()[0] for field in _CANDIDATE.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CANDIDATE_KINDS)], names)

    for _, kinds in _received(batches):
        if SHARED in kinds:
            yield from _shared_rows(*kinds.pop(SHARED)[:3], names)
        if RUNS in kinds:
            doc, start, _, length = kinds.pop(RUNS)
            found = [*_joined(doc, start, start + length)]
            blank = len(found[0])
            columns = [pa.array(c, t) for c, t in zip(found, _CANDIDATE_KINDS)]
            columns += [pa.nulls(blank, t) for t in _CANDIDATE_KINDS[3:]]
            yield pa.RecordBatch.from_arrays(columns, names)
        if PAIRED in kinds:
            doc, x, owner, y = _hopeful(*kinds.pop(PAIRED))
            if len(doc):
                kinds[MATCHES] = doc, x, owner, y
        if MATCHES in kinds:
            doc, x, owner, y = kinds.pop(MATCHES)
            order = np.lexsort((x, x - y, owner, doc))
            found = runs_of(doc[order], owner[order], x[order], y[order])
            del doc, x, owner, y, order
            rows = []
            for one in _pairs(found):
                rows += link(*one)
                if len(rows) >= 1 << 13:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def _shared_rows(doc: np.ndarray, place: np.ndarray, key: np.ndarray, names: list) -> Iterator[pa.RecordBatch]:
    doc, place, key = _once(doc, place, key)
    at = np.cumsum(np.concatenate([[True], doc[1:] != doc[:-1]])) << 32 | place
    odd = at[key & np.uint32(1) > 0]
    if not len(odd):
        return
    after = np.searchsorted(odd, at)
    near = at - odd[np.maximum(after, 1) - 1], odd[np.minimum(after, len(odd) - 1)] - at
    kept = np.logical_or.reduce([(n >= 0) & (n <= APART[1]) for n in near])
    doc, place, key = doc[kept], place[kept], key[kept]
    head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    offsets = pa.array(np.append(head, len(doc)), pa.int32())
    columns = {
        "doc": pa.array(doc[head]),
        "xs": pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
        "ys": pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int32))),
    }
    yield pa.RecordBatch.from_arrays(
        [columns[n] if n in columns else pa.nulls(len(head), t) for n, t in zip(names, _CANDIDATE_KINDS)], names
    )


def _pairs(found: tuple) -> Iterator[tuple]:
    """(document, owner, xs, ys, reaches) of runs sorted by document and owner."""
    if not len(found[0]):
        return
    head = np.flatnonzero(np.concatenate([[True], (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0)]))
    bounds = [*head.tolist(), len(found[0])]
    for low, high in zip(bounds, bounds[1:]):
        doc, owner, *places = (c[low:high].tolist() for c in found)
        yield doc[0], owner[0], *places


def link(doc: int, owner: int, x: list[int], y: list[int], reach: list[int]) -> Iterator[tuple]:
    """One row a chain of a document and an owner: the word spans to align, and its runs."""
    for links in chain(x, y, reach):
        xs, ys, rs = ([c[i] for i in links] for c in (x, y, reach))
        start, stop = max(0, xs[0] - MARGIN) // GRID * GRID, (xs[-1] + rs[-1] + KMER + MARGIN) // GRID * GRID + GRID
        first, last = max(0, ys[0] - MARGIN) // GRID * GRID, (ys[-1] + rs[-1] + KMER + MARGIN) // GRID * GRID + GRID
        yield doc, start, stop, owner, first, last, xs, ys, rs


def candidates(docs: DataFrame, buckets: int) -> DataFrame:
    """Chains of shared seeds (one row each), and disjoint spans (no owner) that hold every run of
    MIN_WORDS words that may repeat.

    A seed found in any number of documents is OWNERS + 1 rows a block at most when it is
    shuffled, and each occurrence is matched with OWNERS documents at most.  A run is in a span if
    another document has the longer seed picked from it.
    """
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        for _, doc_ids, values in blocks_of(batches, BLOCK_CHARS):
            (words, sizes), ids = word_hashes(values), np.array(doc_ids, np.int64)
            yield from _seed_rows(ids, words, sizes, buckets)
            yield from _span_rows(ids, words, sizes, buckets)

    source = docs.where("doc_id IS NOT NULL").withColumn("part", F.spark_partition_id().cast("long"))
    picked = dealt(source.mapInArrow(_sent(pick), PACKET), buckets)
    settled = picked.mapInArrow(_sent(lambda batches: _settled(batches, buckets)), PACKET)
    return dealt(settled, buckets).mapInArrow(tidy(_candidates_of), _CANDIDATE)


# --- frequent seeds, by twos ----------------------------------------------------------------------


def _within(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, spans: list[np.ndarray]) -> np.ndarray:
    """Whether one of the spans (documents, starts, stops) holds each stretch; documents are small numbers."""
    owner, first, last = spans
    if not len(owner):
        return np.zeros(len(doc), bool)
    order = np.lexsort((first, owner))
    low = (owner << 32 | first)[order]
    far = np.maximum.accumulate((owner << 32 | last)[order])
    at = np.searchsorted(low, doc << 32 | start, side="right") - 1
    return (at >= 0) & (far[np.maximum(at, 0)] >= (doc << 32 | stop))


def _twos(sizes: np.ndarray, place: np.ndarray, key: np.ndarray, passages: list[np.ndarray], exact: np.ndarray):
    """(document, place, key, distance and whether wanted) of two seeds APART words, one of them frequent.

    ``sizes`` are the numbers of seeds of each document, ``passages`` (document, start, stop) are
    those found so far.  Wanted are stretches that passages do not cover.  A stretch in an exact
    passage is left out: its first document has the same two.
    """
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = doc << 32 | place
    low, high = np.searchsorted(at, at + APART[0]), np.searchsorted(at, at + APART[1], side="right")
    count = high - low
    one = np.repeat(np.arange(len(at)), count)
    two = np.arange(len(one)) + np.repeat(low - (np.cumsum(count) - count), count)
    odd = ((key[one] | key[two]) & np.uint32(1)) > 0
    one, two = one[odd], two[odd]
    start, stop = place[one], place[two] + KMER
    kept = ~_within(doc[one], start, stop, [x[exact] for x in passages])
    one, two, start, stop = one[kept], two[kept], start[kept], stop[kept]
    joined = _joined(*passages) if len(passages[0]) else passages
    wanted = ~_within(doc[one], start, stop, joined)
    bare = (key >> np.uint32(1)).astype(np.uint64)
    both = mix(mix(bare[one]) * np.uint64(0x9E3779B97F4A7C15) + bare[two]).view(np.int64)
    return doc[one], start, both, (place[two] - start) << 1 | wanted


def _live(doc: np.ndarray, place: np.ndarray, key: np.ndarray, other: np.ndarray) -> Iterator[list[np.ndarray]]:
    """(document, key, place, other) of the rows that a match needs, of rows like those of ``_twos``.

    The matches of a key are dealt to several keys of its own where they are many; a row is then in
    several of them, and wanted in one.
    """
    key, doc, place, other = _once(key, doc, place, other)
    rank, head, _ = _holders(key, doc)
    wanted = (other & 1 > 0) & (rank > 0)
    first = np.flatnonzero(head == np.arange(len(key)))
    group = np.searchsorted(first, head)
    matches = np.cumsum(np.where(wanted, rank, 0))
    before = (matches - np.where(wanted, rank, 0))[first]
    share = (matches - before[group]) // KEY_MATCHES  # of the matches of its key, for wanted rows
    for n in range(int(share.max()) + 1):
        if n == 1:  # few keys have so many
            many = np.maximum.reduceat(share, first)[group] > 0
            key, doc, place, other, rank, wanted, share = (c[many] for c in (key, doc, place, other, rank, wanted, share))
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        mine = wanted & (share == n)
        needed = rank <= np.maximum.reduceat(np.where(mine, rank, -1), first)[group]
        if needed.any():
            own = key[needed].view(np.uint64)
            own = mix(own + np.uint64(n)) if n else own
            yield [doc[needed], own.view(np.int64), place[needed], other[needed] & ~1 | mine[needed]]


class _Codes(dict):
    """A number from 1 to 65535 for each word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = code = zlib.crc32(word) % 65535 + 1
        return code


def _around(words: list[bytes], place: np.ndarray, codes: _Codes) -> np.ndarray:
    """One row a place: the codes of SEEN words from AROUND before it on; 0 stands beyond the text's ends."""
    padded = np.zeros(len(words) + 2 * SEEN, np.uint16)
    padded[SEEN:SEEN + len(words)] = np.fromiter(map(codes.__getitem__, words), np.uint16, len(words))
    return np.lib.stride_tricks.sliding_window_view(padded, SEEN)[place + SEEN - AROUND]


def _reaches(codes: np.ndarray, mine: np.ndarray, x: np.ndarray, theirs: np.ndarray, y: np.ndarray, step: int):
    """How far a passage goes on from columns x and y of two rows of ``codes``, as ``_reach`` has it,
    and where that is not known within AROUND words."""
    far, score = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int16)
    best, live, unknown = score, np.arange(len(mine)), np.zeros(len(mine), bool)
    flat, width = codes.ravel(), codes.shape[1]
    one, two = mine * width + x, theirs * width + y
    for n in range(AROUND):
        code = flat[one]
        score = score + np.where((code == flat[two]) & (code > 0), np.int16(1), np.int16(-MISS))
        far[live[score > best]] = n + 1
        best = np.maximum(score, best)
        on = score >= best - DROP
        live, score, best, one, two = live[on], score[on], best[on], one[on] + step, two[on] + step
    unknown[live] = True
    return far, unknown


def _shared_words(codes: np.ndarray, mine, start, stop, theirs, first, last) -> np.ndarray:
    """How many words in columns start to stop of one row stand between columns first and last of another."""
    found = np.zeros(len(mine), np.int64)
    at = np.arange(codes.shape[1])
    for low in range(0, len(mine), COMPARED):
        part = slice(low, low + COMPARED)
        ours = np.where((at >= start[part, None]) & (at < stop[part, None]), codes[mine[part]], 0)
        other = np.where((at >= first[part, None]) & (at < last[part, None]), codes[theirs[part]], 0)
        for n in range(int(start[part].min()), int(stop[part].max())):
            found[part] += (other == ours[:, n, None]).any(1) & (ours[:, n] > 0)
    return found


def _hopes(codes: np.ndarray, mine: np.ndarray, near: np.ndarray, theirs: np.ndarray, far: np.ndarray):
    """(words before and after, hope) of matches of rows of ``codes``, by the distances of their two seeds.

    A passage that begins or ends with a seed of the match has so many words before and after it, and
    without hope those would not make one: they are too few, or too few of them stand in the other.
    """
    begin, after = np.full(len(mine), AROUND), AROUND + KMER
    back, unknown = _reaches(codes, mine, begin - 1, theirs, begin - 1, -1)
    on, hope = _reaches(codes, mine, near + after, theirs, far + after, 1)
    hope |= unknown
    # A seed's other side: on one diagonal it leads through the other seed, with no more beyond.
    rows = np.flatnonzero((near != far) & ~hope)
    for x, y, step in ((begin + KMER, begin + KMER, 1), (near + AROUND - 1, far + AROUND - 1, -1)):
        hope[rows] |= _reaches(codes, mine[rows], x[rows], theirs[rows], y[rows], step)[1]
    rows = np.flatnonzero((back + near + KMER + on >= MIN_WORDS) & ~hope)
    start, ends = AROUND - back[rows], on[rows] + after
    shared = _shared_words(codes, mine[rows], start, near[rows] + ends, theirs[rows], start, far[rows] + ends)
    hope[rows] = shared >= MIN_MATCH * MIN_WORDS
    return back, on, hope


def _all_pairs(key: np.ndarray, doc: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Wanted rows, of rows sorted by key and doc, each with a row of every earlier document of its key."""
    rank, head, start = _holders(key, doc)
    at = np.arange(len(key))
    begin = np.flatnonzero(start == at)
    first = np.searchsorted(begin, head)
    sizes = np.diff(np.append(begin, len(key)))
    wanted = np.flatnonzero((other & 1 > 0) & (rank > 0))
    ends = np.cumsum(rank[wanted])
    low = 0
    while low < len(wanted):
        base = ends[low] - rank[wanted[low]]
        high = max(low + 1, int(np.searchsorted(ends, base + MATCHED, side="right")))
        rows, count = wanted[low:high], rank[wanted[low:high]]
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        rows = np.repeat(rows, count)
        owner = first[rows] + nth
        yield rows, begin[owner] + np.minimum((at - start)[rows], sizes[owner] - 1)
        low = high


def _all_matches(key: np.ndarray, doc: np.ndarray, place: np.ndarray, other: np.ndarray, around: np.ndarray | None = None):
    """(doc, owner, place, owner place) of wanted rows sorted by key and doc with all earlier documents.

    With the codes ``around`` the rows there is a fifth column, for ``_hopeful``.
    """
    for rows, theirs in _all_pairs(key, doc, other):
        found = [doc[rows], doc[theirs], place[rows], place[theirs]]
        if around is not None:
            near, far = other[rows] >> 1, other[theirs] >> 1
            back, on, hope = _hopes(around, rows, near, theirs, far)
            fields = found[3]
            for value, bits in zip((near, far, back, on, hope), _FIELDS):
                fields = fields << bits | value
            found.append(fields)
        yield found


#: Bits of a match's two distances, of the words before and after it, and of hope.
_FIELDS = 6, 6, 5, 5, 1


def _hopeful(doc: np.ndarray, x: np.ndarray, owner: np.ndarray, fields: np.ndarray) -> list[np.ndarray]:
    """(doc, place, owner, owner place) of the seeds of matches of two documents that may have a passage.

    A passage begins and ends with seeds, so it lies in the stretch of their matches with the words
    before and after.  Without hope in any match there is none if the stretch is one match's, or too short.
    """
    order = np.lexsort((owner, doc))
    doc, x, owner, y = (c[order] for c in (doc, x, owner, fields))
    values = []
    for bits in _FIELDS[::-1]:
        values.append(y & (1 << bits) - 1)
        y = y >> bits
    hope, on, back, far, near = values
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1])]))
    most, least = (lambda c: np.maximum.reduceat(c, head)), (lambda c: np.minimum.reduceat(c, head))
    start, stop = x - back, x + near + KMER + on
    several = np.logical_or.reduce([most(c) > least(c) for c in (start, stop, y - back, y + far + on)])
    kept = (most(hope) > 0) | several & (most(stop) - least(start) >= MIN_WORDS)
    kept = np.repeat(kept, np.diff(np.append(head, len(doc))))
    doc, x, owner, y, far, near = (c[kept] for c in (doc, x, owner, y, far, near))
    return [np.tile(doc, 2), np.concatenate([x, x + near]), np.tile(owner, 2), np.concatenate([y, y + far])]


def by_twos(docs: DataFrame, shared: DataFrame, passages: DataFrame, buckets: int) -> DataFrame:
    """Chains (rows like those of ``candidates``) of documents with any earlier one that has the
    same two seeds APART words, one of them frequent, where ``passages`` leave words of it uncovered
    and one of MIN_WORDS may be.

    ``shared`` has the places and keys of the seeds that several documents have.
    """
    spans = passages.groupBy("doc").agg(F.collect_set(F.struct("start", "stop", "exact")).alias("found"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        for batch in batches:
            ids = batch["doc"].to_numpy()
            sizes = np.diff(batch["xs"].offsets.to_numpy())
            place, key = (batch[c].flatten().to_numpy() for c in ("xs", "ys"))
            found = [
                (n, span["start"], span["stop"], span["exact"])
                for n, several in enumerate(batch["found"].to_pylist()) for span in several or ()
            ]
            taken = [np.array(c, np.int64) for c in zip(*found)] or [np.zeros(0, np.int64)] * 4
            doc, start, both, other = _twos(sizes, place.astype(np.int64), key.view(np.uint32), taken[:3], taken[3] > 0)
            if len(doc):
                yield TWOS, _by_key(both, buckets), ids[doc], start, both, other

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kinds in _received(batches):
            for columns in _live(*kinds.pop(TWOS)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "key", "place", "other"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            for doc, value, found in zip(batch["doc"].to_pylist(), batch["text"], batch["found"]):
                words = value.as_py().encode().lower().split()
                key, place, other = (found.values.field(c).to_numpy() for c in ("key", "place", "other"))
                around = _around(words, place, codes)
                part = _by_key(key, buckets)
                columns = [pa.array(c) for c in (part, key, np.full(len(key), doc, np.int64), place, other)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(map(bytes, around), pa.binary())], names)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        for columns, around in _gathered(batches, names):
            key, doc, place, other = columns
            order = np.lexsort((other, place, doc, key))
            again = np.logical_and.reduce([np.diff(c[order]) == 0 for c in columns])  # of a row that is there twice
            order = order[np.append(True, ~again)]
            key, doc, place, other = (c[order] for c in columns)
            for mine, owner, x, _, fields in _all_matches(key, doc, place, other, around[order]):
                yield PAIRED, _by_doc(mine, buckets), mine, x, owner, fields

    names = ["part", "key", "doc", "place", "other", "around"]
    sent = shared.join(spans.hint("merge"), "doc", "left").mapInArrow(_sent(keys), PACKET)
    needed = dealt(sent, buckets).mapInArrow(tidy(live), "doc long, key long, place long, other long")
    wanted = needed.groupBy("doc").agg(F.collect_list(F.struct("key", "place", "other")).alias("found"))
    seen = docs.withColumnRenamed("doc_id", "doc").join(wanted.hint("merge"), "doc").select("doc", "text", "found").mapInArrow(
        tidy(look), "part long, key long, doc long, place long, other long, around binary"
    )
    matched = seen.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(_sent(match), PACKET)
    return dealt(matched, buckets).mapInArrow(tidy(_candidates_of), _CANDIDATE)


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(key, document, place, other) of each part of rows sorted by part, and the codes around them."""
    part, held = None, []

    def finish() -> tuple[list[np.ndarray], np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        codes = np.frombuffer(b"".join(table["around"].to_pylist()), np.uint16)
        return [table[c].to_numpy() for c in names[1:5]], codes.reshape(-1, SEEN)

    for batch in batches:
        parts = batch["part"].to_numpy()
        cuts = np.flatnonzero(np.diff(parts, prepend=-1)) if len(parts) else []
        for low, high in zip(cuts, [*cuts[1:], len(parts)]):
            if parts[low] != part:
                if held:
                    yield finish()
                part, held = parts[low], []
            held.append(batch.slice(low, high - low))
    if held:
        yield finish()


# --- exact runs -----------------------------------------------------------------------------------

_PASSAGE = "doc long, start int, stop int, owner long, owner_start int, owner_stop int"
_NAMES = [field.split()[0] for field in _PASSAGE.split(", ")]


def exact_passages(segments: DataFrame, buckets: int) -> DataFrame:
    """Passages made of runs of MIN_WORDS words that an earlier document has, from their spans.

    Of a run that several documents of a block have, one row is shuffled by its hash; the others
    have an earlier document in the block.
    """
    def of_block(doc_ids: list[int], starts: list[int], texts: list[str]) -> Iterator[Rows]:
        words, sizes = word_hashes(pa.array(texts, pa.string()))
        key = grams(words, MIN_WORDS).view(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat(np.arange(len(sizes)), sizes)[:len(key)]
        inside = np.flatnonzero(np.arange(len(key)) + MIN_WORDS <= ends[at])
        if not len(inside):
            return
        key, at = key[inside], at[inside]
        doc, place = np.array(doc_ids, np.int64)[at], inside - (ends - sizes)[at] + np.array(starts)[at]
        key, doc, place = _once(key, doc, place)
        owner, other = _owned(key, doc, place)
        local = doc != owner
        if local.any():
            own = doc[local]
            yield MATCHES, _by_doc(own, buckets), own, place[local], owner[local], other[local]
            key, doc, place = key[~local], doc[~local], place[~local]
        yield EXACT, _by_key(key, buckets), doc, place, key, np.zeros_like(place)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        held, size = ([], [], []), 0
        for batch in batches:
            for doc, start, words in zip(*(batch[c].to_pylist() for c in ("doc", "start", "words"))):
                for column, x in zip(held, (doc, start, words.decode())):
                    column.append(x)
                size += len(words)
                if size >= BLOCK_CHARS:
                    yield from of_block(*held)
                    held, size = ([], [], []), 0
        if held[0]:
            yield from of_block(*held)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        for part, kinds in _received(batches):
            if MATCHES in kinds:
                yield _passed(MATCHES, part, kinds.pop(MATCHES))
            if EXACT in kinds:
                doc, place, key, _ = kinds.pop(EXACT)
                key, doc, place = _once(key, doc, place)
                fresh = np.concatenate([[True], key[1:] != key[:-1]])
                head = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
                shared = doc != doc[head]
                if shared.any():
                    mine, first = doc[shared], head[shared]
                    yield MATCHES, _by_doc(mine, buckets), mine, place[shared], doc[first], place[first]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kinds in _received(batches):
            doc, place, owner, other = kinds[MATCHES]
            order = np.lexsort((place, owner, doc))
            doc, place, owner, other = (x[order] for x in (doc, place, owner, other))
            head = np.flatnonzero(np.concatenate(
                [[True], (np.diff(doc) != 0) | (np.diff(owner) != 0) | (np.diff(place) > MIN_WORDS)]
            ))
            tail = np.append(head[1:], len(doc)) - 1
            columns = (
                doc[head], place[head], place[tail] + MIN_WORDS, owner[head],
                np.minimum.reduceat(other, head), np.maximum.reduceat(other, head) + MIN_WORDS,
            )
            kinds = (np.int64, np.int32, np.int32) * 2
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds)], _NAMES)

    first = dealt(segments.mapInArrow(_sent(hashed), PACKET), buckets).mapInArrow(_sent(own), PACKET)
    return dealt(first, buckets).mapInArrow(tidy(merge), _PASSAGE)


# --- chains and alignment -------------------------------------------------------------------------


def runs_of(doc, owner, x, y):
    """Runs of matches sorted by document, owner, diagonal and place: first and last match of each.

    Left out are documents' owners with fewer than MIN_ANCHORS matches.
    """
    pair = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(owner) != 0)])
    head = np.flatnonzero(pair)
    many = np.repeat(np.diff(np.append(head, len(doc))) >= MIN_ANCHORS, np.diff(np.append(head, len(doc))))
    doc, owner, x, y, pair = (c[many] for c in (doc, owner, x, y, pair))
    if not len(doc):
        return doc, owner, x, y, x
    fresh = pair | np.concatenate([[True], (np.diff(x - y) != 0) | (np.diff(x) > RUN_GAP)])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(doc)) - 1
    return doc[head], owner[head], x[head], y[head], x[tail] - x[head]


def chain(x: list[int], y: list[int], reach: list[int]) -> list[list[int]]:
    """Chains of runs (indices, in order), best first.

    A run starts at (x, y) and its last k-mer stands ``reach`` words further on.
    score(i) = reach_i + KMER + max(0, max over runs j that end before i starts of score(j) - gap
    cost).  The cost is linear, so the best predecessor is a prefix maximum over y: a Fenwick tree,
    which a run enters once the sweep over x has passed its end.
    """
    ranks = sorted({b + r for b, r in zip(y, reach)})
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ranks) + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    ends = sorted(range(len(x)), key=lambda i: x[i] + reach[i])
    ended = 0
    for i in sorted(range(len(x)), key=lambda i: x[i]):
        while ended < len(ends) and x[ends[ended]] + reach[ends[ended]] < x[i]:
            j = ends[ended]
            ended += 1
            stop = y[j] + reach[j]
            entry, node = (score[j] + GAP_COST * (x[j] + reach[j] + stop), j), bisect_left(ranks, stop) + 1
            while node < len(tree):
                tree[node] = max(tree[node], entry)
                node += node & -node
        best, node = (-1e18, -1), bisect_left(ranks, y[i])  # so many smaller ends
        while node:
            best = max(best, tree[node])
            node &= node - 1
        gain = best[0] - GAP_COST * (x[i] + y[i])
        score[i] = reach[i] + KMER + max(0.0, gain)
        before[i] = best[1] if gain > 0 else -1
    taken, found = [False] * len(x), []
    for i in sorted(range(len(x)), key=score.__getitem__, reverse=True):
        links = []
        while i >= 0 and not taken[i]:
            taken[i] = True
            links.append(i)
            i = before[i]
        if links and (len(links) > 1 or reach[links[0]]):
            found.append(links[::-1])
    return found


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if a == b:
        return len(a)
    if not a or not b:
        return 0
    masks: dict[bytes, int] = {}
    for i, word in enumerate(b):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for word in a:
        hit = row & masks.get(word, 0)
        row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def _reach(a: list[bytes], b: list[bytes], x: int, y: int, step: int) -> tuple[int, int]:
    """How far (words, equal words) a passage goes on from a[x], b[y] in the given direction."""
    score = best = equal = 0
    far, room = (0, 0), min(len(a) - x, len(b) - y) if step > 0 else min(x, y) + 1
    for n in range(room):
        if a[x + n * step] == b[y + n * step]:
            score, equal = score + 1, equal + 1
            if score > best:
                best, far = score, (n + 1, equal)
        else:
            score -= MISS
            if score < best - DROP:
                break
    return far


def align(
    a: list[bytes], b: list[bytes], xs: list[int], ys: list[int], reach: list[int]
) -> list[tuple[int, int, int, int]]:
    """Passages (start, stop, other start, other stop) along a chain of runs, in words.

    A chain is cut where too many words are lost, and where it does not match well enough as a
    whole, at its widest gap.
    """
    gaps = [(0, 0)]  # (words lost, words matched) before each run
    for i in range(1, len(xs)):
        x, y = xs[i - 1] + reach[i - 1] + KMER, ys[i - 1] + reach[i - 1] + KMER
        if xs[i] < x or ys[i] < y:  # the runs overlap on one side
            gaps.append((abs((xs[i] - x) - (ys[i] - y)), min(xs[i] - x, ys[i] - y)))
        else:
            common = common_words(a[x:xs[i]], b[y:ys[i]])
            gaps.append((max(xs[i] - x, ys[i] - y) - common, common))
    equal = [sum(map(bytes.__eq__, a[x:x + r + KMER], b[y:y + r + KMER])) for x, y, r in zip(xs, ys, reach)]

    def passages(lo: int, hi: int) -> Iterator[tuple[int, int, int, int]]:
        widest = max(range(lo + 1, hi), key=lambda i: gaps[i][0], default=None)
        if widest is None or gaps[widest][0] <= MAX_LOST:
            back, more = _reach(a, b, xs[lo] - 1, ys[lo] - 1, -1) if xs[lo] and ys[lo] else (0, 0)
            x, y = xs[hi - 1] + reach[hi - 1] + KMER, ys[hi - 1] + reach[hi - 1] + KMER
            on, further = _reach(a, b, x, y, 1)
            matched = more + further + sum(equal[lo:hi]) + sum(m for _, m in gaps[lo + 1:hi])
            start, stop, first, last = xs[lo] - back, x + on, ys[lo] - back, y + on
            if matched >= MIN_MATCH * max(stop - start, last - first):
                if stop - start >= MIN_WORDS:
                    yield start, stop, first, last
                return
        if widest is not None:
            yield from passages(lo, widest)
            yield from passages(widest, hi)

    return list(passages(0, len(xs)))


def _segments(docs: DataFrame, wanted: DataFrame, hint: str | None = "merge") -> DataFrame:
    """(doc, start, stop, exact, words) of the wanted word spans, clipped at the text's end.

    A document's spans meet its text as one array, so the text goes to Python once.  Without a
    hint texts are only shuffled where the spans are many.
    """
    names = ["doc", "start", "stop", "exact", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc, value, spans in zip(batch["doc"].to_pylist(), batch["text"], batch["spans"]):
                words = value.as_py().encode().lower().split()
                for span in spans.as_py():
                    rows.append((doc, span["start"], span["stop"], span["exact"], b" ".join(words[span["start"]:span["stop"]])))
                    size += len(rows[-1][4])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    spans = wanted.groupBy("doc").agg(F.collect_set(F.struct("start", "stop", "exact")).alias("spans"))
    spans = spans.hint(hint) if hint else written(spans, "passage_wanted")
    source = docs.withColumnRenamed("doc_id", "doc")
    return source.join(spans, "doc").select("doc", "text", "spans").mapInArrow(
        tidy(run), "doc long, start int, stop int, exact boolean, words binary"
    )


def several_texts(docs: DataFrame) -> DataFrame:
    """(doc, digest): doc_ids whose rows hold several texts, and which of them stands for the document."""
    digests = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.xxhash64("text")).alias("digest"), F.max(F.xxhash64("text")).alias("other")
    )
    return written(
        digests.where("digest <> other").select(F.col("doc_id").alias("doc"), "digest"), "passage_several"
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc, start, stop, owner, owner_start, owner_stop): passages an earlier document has.

    All runs of MIN_WORDS equal words are found; of text that repeats itself, the owner's words
    are the hull of the runs met there.  Other passages are those that chains find.
    Positions count words from 0, lower-cased A-Z; ``owner`` is a smaller doc_id.  NULL and
    empty texts have no passage; rows without doc_id are not searched; rows that share a doc_id
    count as one document and never match each other.  Where they hold several texts, the one
    with the least hash stands for the document, and the others have no passage.
    """
    docs = texts(docs)
    return _passages(docs, several_texts(docs)).select(*_NAMES)


def _passages(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``repeated_passages`` of (doc_id, text) rows of which ``several`` doc_ids hold other texts."""
    if not several.isEmpty():
        docs = docs.join(several, docs["doc_id"] == several["doc"], "left").where(
            "digest IS NULL OR digest = xxhash64(text)"
        ).select("doc_id", "text")
    spark = docs.sparkSession
    free_shuffles(spark)
    chains, texts_cut = (scratch_folder(spark, name) for name in ("passage_candidates", "passage_segments"))
    buckets = bucket_count(docs, BUCKET_BYTES)
    everything = written_to(candidates(docs, buckets), chains)
    found = everything.where("owner IS NOT NULL")
    spans = everything.where("owner IS NULL AND start IS NOT NULL").select("doc", "start", "stop", F.lit(True).alias("exact"))
    cut = written_to(_segments(docs, spans.unionByName(_to_align(found))), texts_cut)
    exact = written(exact_passages(cut.where("exact"), buckets), "passage_exact")
    first = written(
        _aligned(found, cut.where("NOT exact")).withColumn("exact", F.lit(False)).unionByName(
            exact.withColumn("exact", F.lit(True))
        ), "passage_first", instead_of=texts_cut
    )
    shared = everything.where("start IS NULL").select("doc", "xs", "ys")
    more = written(by_twos(docs, shared, first, buckets), "passage_more", instead_of=chains)
    first = first.drop("exact")
    if more.isEmpty():
        return first
    return first.unionByName(_aligned(more, written(_segments(docs, _to_align(more), None), "passage_more_segments")))


def _to_align(found: DataFrame) -> DataFrame:
    """The word spans of both sides of chains."""
    theirs = found.selectExpr("owner AS doc", "owner_start AS start", "owner_stop AS stop", "false AS exact")
    return found.selectExpr("doc", "start", "stop", "false AS exact").unionByName(theirs)


def _aligned(found: DataFrame, segments: DataFrame) -> DataFrame:
    """The passages of chains, aligned on the words of their segments."""
    names = ["doc", "start", "owner", "owner_start", "xs", "ys", "reach", "its_words", "their_words"]
    # Renamed on both sides, so that both joins share one shuffle of the segments.
    mine, theirs = (
        segments.select(*(F.col(c).alias(f"{side}_{c}") for c in ("doc", "start", "stop", "words")))
        for side in ("its", "their")
    )
    # Both sides grow with the corpus, so these joins are never broadcast, however small.
    both = found.join(mine.hint("merge"), F.expr("doc = its_doc AND start = its_start AND stop = its_stop")).join(
        theirs.hint("merge"), F.expr("owner = their_doc AND owner_start = their_start AND owner_stop = their_stop")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, start, owner, first, xs, ys, reach, mine, other in zip(*(batch[c].to_pylist() for c in names)):
                passages = align(
                    mine.split(), other.split(), [x - start for x in xs], [y - first for y in ys], reach
                )
                rows += [
                    (doc, a + start, b + start, owner, c + first, d + first) for a, b, c, d in passages
                ]
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), *[pa.int32()] * 2) * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                ["doc", "start", "stop", "owner", "owner_start", "owner_stop"],
            )

    return both.select(*names).mapInArrow(tidy(run), _PASSAGE)


def merged_spans(passages: DataFrame) -> DataFrame:
    """(doc, spans, owners): per document the disjoint word spans to remove, and their owners.

    A document has at most one passage a chain or exact run, bounded by its own length.
    """
    grouped = passages.groupBy("doc").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("found"),
        F.sort_array(F.collect_set("owner")).alias("owners"),
    )
    merged = """
        aggregate(found, CAST(array() AS array<struct<start:int,stop:int>>), (done, s) ->
          CASE WHEN size(done) > 0 AND element_at(done, -1).stop >= s.start
               THEN concat(slice(done, 1, size(done) - 1), array(struct(
                      element_at(done, -1).start AS start,
                      greatest(element_at(done, -1).stop, s.stop) AS stop)))
               ELSE concat(done, array(s)) END)
    """
    return grouped.select("doc", F.expr(merged).alias("spans"), "owners")


def cut_words(text: str, spans: list) -> str:
    """The text without the given word spans (start, stop), and the white space after them."""
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    parts, at = [], 0
    for start, stop in spans:
        parts.append(text[at:starts[start]])
        at = starts[min(stop, len(starts) - 1)]
    return "".join([*parts, text[at:]])


def _spans(docs: DataFrame) -> DataFrame:
    """(doc, digest, spans, owners) of documents with passages, written.

    ``digest`` is NULL, or of the one text that the spans are places in.
    """
    docs = texts(docs)
    several = several_texts(docs)
    found = merged_spans(_passages(docs, several))
    return written(found.join(several, "doc", "left"), "passage_spans")


#: Rows of documents (d) meet the spans of their text (s).
_OWN = "s.doc = CAST(d.doc_id AS LONG) AND (s.digest IS NULL OR s.digest = xxhash64(coalesce(d.text, '')))"


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, duplicate_of (doc_ids) of every row of ``docs``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(text.as_py().encode().split()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), batch["own"]], ["doc_id", "n_words", "own"]
            )

    sizes = texts(docs).withColumn("own", F.xxhash64("text")).mapInArrow(count, "doc_id long, n_words long, own long")
    own = F.expr("s.doc = d.doc_id AND (s.digest IS NULL OR s.digest = d.own)")
    return sizes.alias("d").join(_spans(docs).alias("s"), own, "left").select(
        "doc_id", "n_words",
        F.expr("coalesce(aggregate(spans, 0L, (n, s) -> n + s.stop - s.start), 0L)").alias("n_removed"),
        F.expr("CAST(coalesce(array_size(spans), 0) AS LONG)").alias("n_spans"),
        F.coalesce("owners", F.expr("CAST(array() AS array<long>)")).alias("duplicate_of"),
    )


def remove_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from all but the first document that has them."""
    def cut(text: pd.Series, found: pd.Series) -> pd.Series:
        pairs = ([(p["start"], p["stop"]) for p in spans] for spans in found)
        return pd.Series([cut_words(t, p) for t, p in zip(text, pairs)], dtype=object)

    cut_text = F.pandas_udf(cut, "string")
    none = F.expr("CAST(array() AS array<struct<start:int,stop:int>>)")
    text = F.when(
        F.col("s.spans").isNotNull(),
        cut_text(F.coalesce("d.text", F.lit("")), F.coalesce("s.spans", none)),
    ).otherwise(F.col("d.text"))
    met = docs.alias("d").join(_spans(docs).alias("s"), F.expr(_OWN), "left")
    return met.select(*(text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
