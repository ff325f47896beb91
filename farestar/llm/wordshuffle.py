"""Token ids of whole texts by a global shuffle of distinct words.

1. A task splits its texts into words, block by block.  A block becomes a dictionary of its
   distinct words, most frequent first, and a stream of positions into it.
2. The words go, in packets by hash bucket, to the one task that owns the bucket.  It encodes
   each distinct word once for the whole corpus and sends the ids back to the blocks.
3. A block's ids meet its streams; documents are reassembled by position.

A word that stands in every document crosses the network once a block, so no key is hot.
Splitting must not change the ids: the ids of a text are those of its words, one after another.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import tidy, written
from farestar.session import scratch_folder

#: Makes, in a task, the function from an array of texts to the number of words of each text, the
#: words of all as numbers, and the distinct words they number.
Splitter = Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.BinaryArray]]]
#: Makes, in a task and from the broadcast vocabulary, the function from distinct words to the ids
#: of each.
Coder = Callable[[object], Callable[[list[bytes]], list[list[int]]]]
#: Rows from a block, the number of a packet in it, doc_ids and the ids of each document.
Finish = Callable[[int, int, list, list[np.ndarray]], pa.RecordBatch]

#: A block's texts have at most this many characters; a longer text is a block by itself.
BLOCK_CHARS = 1 << 24
#: A block's number: its partition above these bits, its place in it below.
PART_SHIFT = 24
#: Bytes of text for each task that owns words, at most.
BUCKET_BYTES = 1 << 30
#: A stream packet has at most this many words; a longer text is a packet by itself.
PACKET_WORDS = 1 << 17

_PACKET = (
    "block long, kind int, bucket int, doc_ids array<long>, sizes array<int>, places binary, content binary"
)
_ARROW = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("places", pa.binary()), ("content", pa.binary()),
])
WORDS, STREAM = 0, 1


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as little-endian groups of seven bits, compressed."""
    values = np.asarray(values, np.uint32)
    width = max(1, -(-int(values.max()).bit_length() // 7)) if len(values) else 1
    if width == 1:
        return zstandard.compress(values.astype(np.uint8).tobytes(), 3)
    groups, there = np.empty((len(values), width), np.uint8), np.ones((len(values), width), bool)
    for i in range(width):
        groups[:, i] = (values >> np.uint32(7 * i)).astype(np.uint8) & 127
        if i:
            more = values >= np.uint32(1 << 7 * i)
            there[:, i] = more
            groups[:, i - 1] |= more.view(np.uint8) << 7
    return zstandard.compress(groups[there].tobytes(), 3)


def unpack_numbers(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    last = np.flatnonzero(raw < 128)
    if len(last) == len(raw):
        return raw.astype(np.uint32)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    values = (raw[first] & 127).astype(np.uint32)
    rows = np.flatnonzero(first < last)
    for i in range(1, 5):
        if not len(rows):
            break
        at = first[rows] + i
        values[rows] |= (raw[at] & 127).astype(np.uint32) << np.uint32(7 * i)
        rows = rows[at < last[rows]]
    return values


def _packet(block: int, kind: int, bucket: int | None, doc_ids, sizes, places, content) -> pa.RecordBatch:
    row = (block, kind, bucket, doc_ids, sizes, places, content)
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW
    )


def _bytes_of(words: pa.BinaryArray) -> tuple[memoryview, list[int]]:
    """The bytes of all words, and where each begins and the last ends."""
    if not len(words):
        return memoryview(b""), [0]
    _, edges, raw = words.buffers()
    edges = np.frombuffer(edges, np.int32)[words.offset:words.offset + len(words) + 1]
    return memoryview(raw or b""), edges.tolist()


def _block(
    block: int, doc_ids: list, sizes: np.ndarray, stream: np.ndarray, words: pa.BinaryArray, buckets: int
) -> Iterator[pa.RecordBatch]:
    """The packets of one block: its words by bucket, and its stream."""
    count = len(words)
    place = np.empty(count, np.int64)
    place[np.argsort(-np.bincount(stream, minlength=count), kind="stable")] = np.arange(count)
    crc, (raw, edges) = zlib.crc32, _bytes_of(words)
    owner = np.fromiter([crc(raw[a:b]) for a, b in zip(edges, edges[1:])], np.int64, count) % buckets
    order = np.argsort(owner * count + place)
    owner, ranked = owner[order], place[order]
    spelled = words.take(pa.array(order))
    lengths = pc.binary_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    content, edges = _bytes_of(spelled)
    content = content[edges[0]:edges[-1]]
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    for first, last in zip(heads.tolist(), [*heads[1:].tolist(), count]):
        sized = pack_numbers(lengths[first:last])
        body = zstandard.compress(content[ends[first] - lengths[first]:ends[last - 1]], 3)
        gaps = pack_numbers(np.diff(ranked[first:last], prepend=0))
        yield _packet(block, WORDS, int(owner[first]), None, [len(sized), len(body)], gaps, sized + body)
    stops = np.cumsum(sizes)
    begin = packet = 0
    while begin < len(sizes):
        base = int(stops[begin] - sizes[begin])
        end = max(begin + 1, int(np.searchsorted(stops, base + PACKET_WORDS, side="right")))
        numbers = pack_numbers(place[stream[base:int(stops[end - 1])]])
        yield _packet(block, STREAM, packet, doc_ids[begin:end], sizes[begin:end].tolist(), None, numbers)
        packet, begin = packet + 1, end


def blocks_of(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[int, list, pa.Array]]:
    """(number, doc_ids, texts) of the blocks of one partition's (doc_id, text, part) rows."""
    pending: list[pa.RecordBatch] = []
    blocks = size = 0

    def block() -> tuple[int, list, pa.Array]:
        doc_ids = [i for piece in pending for i in piece["doc_id"].to_pylist()]
        return pending[0]["part"][0].as_py() << PART_SHIFT | blocks, doc_ids, pa.concat_arrays([p["text"] for p in pending])

    for batch in batches:
        chars = np.cumsum(pc.utf8_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = base = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(chars, base + block_chars - size, side="right"))
            end = max(end, begin if pending else begin + 1)
            if end > begin:
                pending.append(batch.slice(begin, end - begin))
                size += int(chars[end - 1]) - base
                begin, base = end, int(chars[end - 1])
            if begin < batch.num_rows:
                yield block()
                blocks, size, pending = blocks + 1, 0, []
    if pending:
        yield block()


def bucket_count(source: DataFrame, each: int = BUCKET_BYTES) -> int:
    """How many tasks own words: the shuffle partitions, more where texts exceed ``each`` bytes for one.

    So what one task owns stays level when the input grows; measured by a scan of the texts.
    """
    size = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def by_block(rows: DataFrame, blocks: DataFrame, number: str) -> DataFrame:
    """Rows dealt so that a task has whole blocks, in their order; sorted by block, kind, number.

    Tasks follow one another in the order of the blocks.  ``blocks`` is the written table of all
    packets: its largest part number and how many blocks there are decide the number of tasks.
    """
    part = F.shiftright("block", PART_SHIFT)
    size = blocks.agg(F.max(part).alias("last"), F.count_distinct("block").alias("n")).first()
    parts = (size["last"] or 0) + 1
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(max(parts, least), max(1, size["n"]))
    if tasks <= parts:
        place = F.floor(part * tasks / parts)
    else:  # few parts of many blocks each
        inside = blocks.groupBy(part.alias("p")).agg((F.max("block") - F.shiftleft(F.max(part), PART_SHIFT)).alias("m"))
        most = (inside.agg(F.max("m").alias("m")).first()["m"] or 0) + 1
        offset = F.col("block") - F.shiftleft(part, PART_SHIFT)
        place = F.floor((part * most + offset) * tasks / (parts * most))
    return rows.repartitionById(tasks, place.cast("int")).sortWithinPartitions("block", "kind", number)


def split_words(source: DataFrame, splitter: Splitter, buckets: int, folder: str, block_chars: int) -> DataFrame:
    """Step 1, written to a folder: the word packets and stream packets of every block.

    Blocks are numbered by partition of ``source`` (doc_id, text) and place in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for block, doc_ids, values in blocks_of(batches, block_chars):
            yield from _block(block, doc_ids, *split(values), buckets)

    parted = source.withColumn("part", F.spark_partition_id().cast("long"))
    packets = parted.mapInArrow(tidy(run), _PACKET)
    packets.write.parquet(folder)
    return source.sparkSession.read.schema(packets.schema).parquet(folder)


def by_text(find: Callable[[str], list]) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.BinaryArray]]:
    """A splitter of arrays from a function of one text."""

    def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
        words: dict = defaultdict()
        words.default_factory = words.__len__
        numbers = [
            np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
            for found in map(find, texts.to_pylist())
        ]
        spelled = [w if isinstance(w, bytes) else w.encode() for w in words]
        return np.fromiter(map(len, numbers), np.int64), np.concatenate(numbers), pa.array(spelled, pa.binary())

    return split


def _encode_words(packets: DataFrame, coder: Coder, vocabulary: Broadcast, buckets: int) -> DataFrame:
    """Step 2: the ids of each word packet.  A bucket's words are encoded once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary.value)
        known: dict[bytes, list[int]] = {}
        bucket = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                head, tail = row["sizes"]
                ends = np.cumsum(unpack_numbers(row["content"][:head]), dtype=np.int64).tolist()
                text = zstandard.decompress(row["content"][head:head + tail])
                words = [text[a:b] for a, b in zip([0, *ends], ends)]
                fresh = [word for word in words if word not in known]
                known.update(zip(fresh, encode(fresh) if fresh else ()))
                ids = [known[word] for word in words]
                counts = pack_numbers(np.fromiter(map(len, ids), np.uint32, len(ids)))
                flat = pack_numbers(np.fromiter(chain.from_iterable(ids), np.uint32))
                yield _packet(
                    row["block"], WORDS, row["bucket"], None, [len(counts), len(flat)],
                    row["places"], counts + flat,
                )

    words = packets.where(F.col("kind") == WORDS)
    return (
        words.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
        .mapInArrow(tidy(run), _PACKET)
    )


class _Vocabulary:
    """The ids of one block's words, gathered from its packets."""

    def __init__(self):
        self.places, self.counts, self.flat = [], [], []

    def add(self, places: bytes, sizes: list[int], content: bytes) -> None:
        self.places.append(np.cumsum(unpack_numbers(places), dtype=np.int64))
        self.counts.append(unpack_numbers(content[:sizes[0]]))
        self.flat.append(unpack_numbers(content[sizes[0]:]))

    def close(self) -> None:
        place = np.concatenate(self.places)
        count, flat = np.concatenate(self.counts).astype(np.int64), np.concatenate(self.flat)
        self.flat = flat
        self.count = np.empty(len(place), np.int64)
        self.start = np.empty(len(place), np.int64)
        self.count[place] = count
        self.start[place] = np.cumsum(count) - count
        self.places = None

    def ids(self, stream: np.ndarray) -> np.ndarray:
        count = self.count[stream]
        shift = self.start[stream] - (np.cumsum(count) - count)
        return self.flat[np.repeat(shift, count) + np.arange(int(count.sum()))]


def encode_blocks(
    source: DataFrame, splitter: Splitter, coder: Coder, vocabulary: Broadcast, finish: Finish,
    schema: str, buckets: int | None = None, purpose: str | None = None, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """What ``finish`` makes of each packet of documents, in ``schema``.

    ``source`` has doc_id and text, never NULL.  Packets keep the order of the rows of
    ``source``: by block, then by packet number, from task to task.  ``buckets`` is the number of
    tasks that encode words, by default as many as the size of the texts asks for.  With a ``purpose`` the
    result is written and the blocks behind it are deleted; without, it is evaluated when read.
    """
    spark = source.sparkSession
    buckets = buckets or bucket_count(source)
    folder = scratch_folder(spark, "word_blocks")
    packets = split_words(source, splitter, buckets, folder, block_chars)
    encoded = _encode_words(packets, coder, vocabulary, buckets)
    both = encoded.unionByName(packets.where(F.col("kind") == STREAM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                if row["block"] != block:
                    block, known = row["block"], _Vocabulary()
                if row["kind"] == WORDS:
                    known.add(row["places"], row["sizes"], row["content"])
                    continue
                stream = unpack_numbers(row["content"])
                if known.places:
                    known.close()
                ids = known.ids(stream) if len(stream) else stream
                counts = known.count[stream] if len(stream) else stream
                ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(row["sizes"])].astype(np.int64)
                documents = np.split(ids, ends[:-1])
                yield finish(block, row["bucket"], row["doc_ids"], documents)

    made = by_block(both, packets, "bucket").mapInArrow(tidy(run), schema)
    return written(made, purpose, instead_of=folder) if purpose else made
