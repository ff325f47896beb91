"""Token ids in directly addressable codes, written as segments and read at any position.

An id is split into chunks of eight bits, lowest first.  Level 0 holds the lowest chunk of every
id; a bitmap says which ids continue; level 1 holds the next chunk of those, and so on.  A rank
directory (set bits before every 512th position) finds an id's place on the next level, so one
id is read with one popcount a level and no block is decoded.

File format: a Parquet table of segments, ordered by doc_id.  A segment holds whole documents
(a packet of the word shuffle), their doc_ids and lengths,
and per level the chunks, the continuation bitmap and the rank directory as binary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts, written
from farestar.llm.scan import running_totals
from farestar.llm.tokens import bare_words, word_coder, word_vocabulary
from farestar.llm.wordshuffle import bucket_count, encode_blocks

CHUNK_BITS = 8
RANK_EVERY = 512

SEGMENT = (
    "block long, packet int, doc_ids array<long>, lengths array<long>, n_ids long,"
    " chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)
_ARROW = pa.schema([
    ("block", pa.int64()), ("packet", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("chunks", pa.list_(pa.binary())),
    ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
])


def build(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of the levels of one id array."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes())
        rest = rest >> np.uint32(CHUNK_BITS)
        more = rest > 0
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        sums = np.add.reduceat(more, np.arange(0, len(more), RANK_EVERY), dtype=np.uint32) if len(more) else []
        ranks.append(np.concatenate([[0], np.cumsum(sums)]).astype("<u4").tobytes())
        if not more.any():
            return chunks, bitmaps, ranks
        rest = rest[more]


class Codes:
    """Random access to the ids of one segment."""

    def __init__(self, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    def _rank(self, level: int, position: int) -> int:
        """Set bits of the level's bitmap before a position."""
        block, bits = divmod(position, RANK_EVERY)
        start = block * RANK_EVERY // 8
        words = self.bitmaps[level][start:start + (bits + 7) // 8]
        return int(self.ranks[level][block]) + int(np.unpackbits(words, bitorder="little")[:bits].sum())

    def get(self, position: int) -> int:
        """The id at a position."""
        value = 0
        for level, chunk in enumerate(self.chunks):
            value |= int(chunk[position]) << (CHUNK_BITS * level)
            if not self.bitmaps[level][position >> 3] >> (position & 7) & 1:
                break
            position = self._rank(level, position)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop: the ranks of the two ends bound the run on each level."""
        found = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for level, chunk in enumerate(self.chunks):
            if start == stop:
                break
            found[where] |= chunk[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            first = start >> 3
            bits = np.unpackbits(self.bitmaps[level][first:(stop + 7) >> 3], bitorder="little")
            more = bits[start - 8 * first:stop - 8 * first].astype(bool)
            start = self._rank(level, start)
            where = where[more]
            stop = start + len(where)
        return found


def write_codes(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Encode every text, write the segments in ascending doc_id order, return the written table.

    The tokenizer must treat white space only as a border of words.  Texts are dealt by ranges
    of doc_id and sorted within them before they are cut into blocks, so ids are never
    shuffled: segments ascend by (block, packet).  NULL texts are empty and give the end id alone; a NULL doc_id comes
    first; repeated doc_ids lie next to each other, in the order of a hash of their texts.
    """
    first = F.col("doc_id").asc_nulls_first()
    source = texts(docs).repartitionByRange(first).sortWithinPartitions(first, F.xxhash64("text"))
    end = np.array([end_id], np.uint32)

    def finish(block: int, packet: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate([x for one in ids for x in (one, end)])
        row = [block, packet, doc_ids, [len(x) + 1 for x in ids], len(flat), *build(flat)]
        return pa.RecordBatch.from_arrays(
            [pa.array([c], f.type) for c, f in zip(row, _ARROW)], schema=_ARROW
        )

    return encode_blocks(
        source, bare_words, word_coder, word_vocabulary(docs.sparkSession, tokenizer), finish, SEGMENT,
        buckets=bucket_count(texts(docs)), purpose="token_codes",
    )


def read_codes(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the segments.

    ``start`` counts the ids of all segments before, from the segments' own counts, and those
    before the document in its segment.
    """
    sizes = segments.select("block", "packet", "n_ids")
    # Written, so that its size is known and decides how the segments meet it.
    starts = written(
        running_totals(sizes, ["block", "packet"], ["n_ids"]).select(
            "block", "packet", F.col("n_ids_before").alias("start")
        ),
        "token_starts",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                codes = Codes(row["chunks"], row["bitmaps"], row["ranks"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crcs = [
                    zlib.crc32(codes.slice(a, b).astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["start"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.join(starts, ["block", "packet"]).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def get_ids(segments: DataFrame, positions: DataFrame) -> DataFrame:
    """The ids at (block, packet, position) rows, each read alone: block, packet, position, id."""
    asked = positions.groupBy("block", "packet").agg(F.collect_set("position").alias("positions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                codes = Codes(row["chunks"], row["bitmaps"], row["ranks"])
                places = row["positions"]
                yield pa.RecordBatch.from_pydict({
                    "block": [row["block"]] * len(places),
                    "packet": pa.array([row["packet"]] * len(places), pa.int32()),
                    "position": places, "id": [codes.get(p) for p in places],
                })

    return segments.join(asked, ["block", "packet"]).select(
        "block", "packet", "positions", "chunks", "bitmaps", "ranks"
    ).mapInArrow(run, "block long, packet int, position long, id long")
