"""Near-duplicate documents by circulant MinHash, confirmed by exact Jaccard similarity.

One permutation scatters the shingles, a second one, read at circular shifts 0, 1, 2, ..., gives
every signature coordinate.  Bands of coordinates bring documents together; a link counts only
if the full shingle sets confirm it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts, tidy, written
from farestar.llm.components import components
from farestar.llm.keycounts import DOCS, KEYS, ROW, answers, packets, restore, row, squeeze
from farestar.llm.shingles import Shingler, mix
from farestar.llm.wordshuffle import PART_SHIFT, bucket_count, by_block
from farestar.session import scratch_folder

#: Links: 100 * intersection >= 75 * union.
THRESHOLD = (75, 100)
#: 32 bands of 4: a pair at similarity 0.75 shares a band with probability 0.999995.
BANDS, ROWS = 32, 4
UNIVERSE_BITS = 20
SEED = 20240229
GATHER = 4096
#: Shingles whose holders a task asks for at once.
BLOCK_SHINGLES = 1 << 21


class Circulant:
    """Signatures over a universe of 2^20 shingle positions."""

    def __init__(self):
        size = 1 << UNIVERSE_BITS
        random = np.random.default_rng(SEED)
        self.scatter = random.permutation(size).astype(np.int32)
        shifted = random.permutation(size).astype(np.int32)
        self.windows = np.lib.stride_tricks.sliding_window_view(
            np.concatenate([shifted, shifted[:BANDS * ROWS]]), BANDS * ROWS
        )

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Coordinate k: the least value of the second permutation, shifted by k."""
        places = self.scatter[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
        least = np.full(BANDS * ROWS, np.iinfo(np.int32).max, np.int32)
        for start in range(0, len(places), GATHER):
            np.minimum(least, self.windows[places[start:start + GATHER]].min(axis=0), out=least)
        return least

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        """One 64-bit key a band."""
        rows = self.signature(shingles).reshape(BANDS, ROWS).astype(np.uint64)
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)
        for column in rows.T:
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        return keys.view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_shingles, set_hash and bands of every row (NULL without a word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, circulant = Shingler(), Circulant()
        for batch in batches:
            counts, hashes, bands = [], [], []
            for text in batch["text"]:
                shingles = shingler.set_of(text.as_py())
                counts.append(len(shingles))
                some = len(shingles) > 0
                hashes.append(xxhash.xxh3_128_digest(shingles.tobytes()) if some else None)
                bands.append(circulant.bands(shingles) if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["digest"], pa.array(counts, pa.int64()),
                 pa.array(hashes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "digest", "n_shingles", "set_hash", "bands"],
            )

    return texts(docs).withColumn("digest", F.xxhash64("text")).mapInArrow(
        tidy(run), "doc_id long, digest long, n_shingles long, set_hash binary, bands array<long>"
    )


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted classes, from the text of the row that stands for each."""
    source = texts(docs).withColumn("digest", F.xxhash64("text"))
    same = F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.digest") == F.col("w.digest"))
    rows = source.alias("r").join(wanted.alias("w"), same).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = [shingler.set_of(text.as_py()).tobytes() for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array(sets, pa.binary())], ["node", "shingles"]
            )

    return rows.mapInArrow(tidy(run), "node long, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs whose full sets are similar enough."""
    part, whole = THRESHOLD
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["set_a"], batch["set_b"]):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (a, b))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * common >= part * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b").mapInArrow(
        run, "a long, b long"
    )


def _labels(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(node, label) of the nodes that (a, b) links or ``before`` have, written.

    Links between components that are known already join their labels, not their nodes.
    """
    if before is not None:
        for end in ("a", "b"):
            known = before.select(F.col("node").alias(end), "label")
            links = links.join(known, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        links = written(links, "minhash_moves")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    labels = components(ends.distinct(), links)
    if before is not None:
        moved = written(labels, "minhash_moved")
        fresh = moved.join(before, "node", "left_anti").select("node", F.col("node").alias("label"))
        steps = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = before.unionByName(fresh).join(steps, "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
    return written(labels, "minhash_labels")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component label of their node; a node without links is its own."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The members of buckets that span several components."""
    keys = rows.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("key")
    return rows.join(written(keys, "minhash_keys"), "key")


def _star(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's pivot with the members of another component, by size."""
    part, whole = THRESHOLD
    return rows.join(written(pivots, "minhash_pivots"), "key").where(
        f"node <> pivot.node AND label <> pivot.label"
        f" AND {whole}L * least(n, pivot.n) >= {part}L * greatest(n, pivot.n)"
    ).selectExpr("least(node, pivot.node) AS a", "greatest(node, pivot.node) AS b").distinct()


def _heaviest(rows: DataFrame) -> DataFrame:
    """Of each bucket the member that stands in the largest buckets."""
    sizes = written(rows.groupBy("key").agg(F.count("*").alias("size")), "minhash_sizes")
    weights = written(
        rows.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("weight")), "minhash_weights"
    )
    return rows.join(weights, "node").groupBy("key").agg(
        F.max(F.struct("weight", "node", "n", "label")).alias("pivot")
    )


def _outsiders(rows: DataFrame) -> DataFrame:
    """The members of a bucket outside its largest component, where they span several themselves."""
    sizes = rows.groupBy("key", "label").agg(F.count("*").alias("members"))
    largest = written(
        sizes.groupBy("key").agg(F.max(F.struct("members", "label")).alias("largest"), F.count("*").alias("labels"))
        .where("labels > 2").select("key", F.col("largest.label").alias("major")),
        "minhash_major",
    )
    return written(rows.join(largest, "key").where("label <> major").drop("major"), "minhash_outsiders")


def _ordered_prefixes(sets: DataFrame, buckets: int) -> DataFrame:
    """(node, prefix): the shingles of each set that come first by (holders, shingle).

    Two sets of sizes m <= n that are similar enough share at least 3 / 7 * (m + n) shingles, so
    in any one order of all shingles they share one of the first n - ceil(3 / 4 n) + 1 of the
    larger and the first m - ceil(6 / 7 m) + 1 of the smaller.  Rare shingles come first, so few
    sets share them.  Holders are counted by the owners of shingles and sent back to the blocks.
    """
    folder = scratch_folder(sets.sparkSession, "minhash_blocks")
    part, whole = THRESHOLD

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, held, size, blocks = [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = part_of[0] << PART_SHIFT | blocks
            shingles = np.concatenate(held)
            keys, counts = np.unique(shingles, return_counts=True)
            yield row(block=block, kind=DOCS, part=0, doc_ids=nodes, sizes=[len(x) for x in held], keys=squeeze(shingles))
            yield from packets(block, keys, counts, (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64))

        part_of = [0]
        for batch in batches:
            if batch.num_rows:
                part_of[0] = batch["part"][0].as_py()
            for node, raw in zip(batch["node"].to_pylist(), batch["shingles"]):
                nodes.append(node)
                held.append(np.frombuffer(raw.as_py(), np.int64))
                size += len(held[-1])
                if size >= BLOCK_SHINGLES:
                    yield from flush()
                    nodes, held, size, blocks = [], [], 0, blocks + 1
        if held:
            yield from flush()

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, counts = None, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                got = {c: batch[c][i].as_py() for c in ("block", "kind", "doc_ids", "sizes", "keys", "counts")}
                if got["block"] != block:
                    block, keys, counts = got["block"], [], []
                if got["kind"] == KEYS:
                    keys.append(restore(got["keys"]))
                    counts.append(restore(got["counts"]))
                    continue
                known, holders = np.concatenate(keys), np.concatenate(counts)
                sort = np.argsort(known)
                known, holders = known[sort], holders[sort]
                found = []
                for shingles in np.split(restore(got["keys"]), np.cumsum(got["sizes"])[:-1]):
                    n = len(shingles)
                    rank = np.lexsort((shingles, holders[np.searchsorted(known, shingles)]))
                    found.append(shingles[rank[:n - -(-part * n // whole) + 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got["doc_ids"], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["node", "prefix"]
                )

    parted = sets.withColumn("part", F.spark_partition_id().cast("long"))
    parted.mapInArrow(tidy(split), ROW).write.parquet(folder)
    blocks = sets.sparkSession.read.schema(ROW).parquet(folder)
    asked = answers(blocks.where(F.col("kind") == KEYS), buckets, lambda keys, counts: counts)
    both = asked.unionByName(blocks.where(F.col("kind") == DOCS))
    return by_block(both, blocks, "part").mapInArrow(tidy(order), "node long, prefix array<long>")


def _prefix_pairs(rows: DataFrame, sets: DataFrame, buckets: int) -> DataFrame:
    """Pairs (a, b) of members of two components that a prefix index does not rule out.

    The larger of a pair probes with its longer prefix, the smaller is indexed with its shorter
    one.  At the first shingle that both prefixes share, what is left of both sets must still reach
    the overlap that a link needs; a pair is made where that holds for a shared shingle.
    """
    part, whole = THRESHOLD
    nodes = written(rows.select("node", "n", "label").distinct(), "minhash_open")
    prefixes = _ordered_prefixes(sets.join(nodes.select("node"), "node", "left_semi"), buckets)
    known = written(prefixes.join(nodes, "node"), "minhash_prefixes")
    probes = known.select(
        *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "label")), F.posexplode("prefix").alias("place_a", "shingle_a"),
    )
    short = F.slice("prefix", F.lit(1), F.expr(f"CAST(n - ceil({2 * part}L * n / {part + whole}) + 1 AS INT)"))
    indexed = known.withColumn("prefix", short).select(
        *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "label")), F.posexplode("prefix").alias("place_b", "shingle_b"),
    )
    # Shingles that one set alone has can make no pair; they are most of what is rare.
    shared = written(
        indexed.groupBy("shingle_b").agg(F.min("label_b").alias("low"), F.max("label_b").alias("high")),
        "minhash_indexed",
    )
    probes = probes.join(shared, F.expr("shingle_a = shingle_b AND (low <> label_a OR high <> label_a)"), "left_semi")
    condition = (
        "shingle_a = shingle_b AND label_a <> label_b AND (n_b < n_a OR (n_b = n_a AND node_b < node_a))"
        f" AND {whole}L * n_b >= {part}L * n_a"
        f" AND {part + whole}L * least(n_a - place_a, n_b - place_b) >= {part}L * (n_a + n_b)"
    )
    return probes.join(indexed, F.expr(condition)).selectExpr(
        "least(node_a, node_b) AS a", "greatest(node_a, node_b) AS b"
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_shingles, component_id and kept of every row of ``docs``.

    Rows with equal shingle sets form a class, linked without comparison; one row stands for
    it.  In a bucket (a band key) every class is compared with the member that stands in the
    largest buckets; links make components.  Where a bucket still spans several components, its
    members outside the largest are compared with one of their own in the same way, and what is
    still apart goes through an exact prefix index, which rules out only pairs that cannot be
    linked.  So no candidate is left out, and members of one component are never compared again.

    A text without words has n_shingles 0 and is linked with nothing; NULL counts as empty.  A
    NULL doc_id never names a component unless all its rows lack one.  Repeated rows share
    their component.  ``kept``: doc_id equals component_id, the least doc_id of the component.
    """
    prints = written(fingerprints(docs), "minhash_prints")
    classes = written(
        prints.where("set_hash IS NOT NULL").groupBy("set_hash").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("row"), F.min("doc_id").alias("first"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "minhash_classes",
    )
    members = classes.select("node", "n", F.posexplode("bands").alias("band", "key")).drop("band")
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(
        members.join(written(sizes, "minhash_sizes"), "key").drop("size").withColumn("label", F.col("node")),
        "minhash_members",
    )
    ends = shared.select("node").distinct()
    wanted = classes.join(ends, "node").select("node", "row.doc_id", "row.digest")
    sets = written(_shingle_sets(docs, wanted), "minhash_sets")

    compared = written(_star(shared, _heaviest(shared)), "minhash_pairs")
    labels = _labels(written(_confirmed(compared, sets), "minhash_links"))
    members = shared.drop("label")
    open_rows = written(_mixed(_labelled(members, labels)), "minhash_mixed")
    for last in (False, True):
        if last:
            pairs = _prefix_pairs(open_rows, sets, bucket_count(texts(docs)))
        else:
            outside = _outsiders(open_rows)
            pairs = _star(outside, _heaviest(outside))
        pairs = written(pairs.join(compared, ["a", "b"], "left_anti"), "minhash_pairs")
        more = written(_confirmed(pairs, sets), "minhash_links")
        compared = compared.unionByName(pairs)
        if more.isEmpty():
            continue
        labels = _labels(more, labels)
        if not last:
            open_rows = written(_mixed(_labelled(members, labels)), "minhash_mixed")

    firsts = _labelled(classes.select("node", "first", "set_hash"), labels)
    named = written(
        firsts.groupBy("label").agg(F.min("first").alias("component_id")), "minhash_names"
    )
    known = written(firsts.join(named, "label").select("set_hash", "component_id"), "minhash_known")
    return prints.drop("bands").join(known, "set_hash", "left").select(
        "doc_id", "digest", "n_shingles",
        F.expr("IF(set_hash IS NULL, doc_id, component_id)").alias("component_id"),
        F.expr("set_hash IS NULL OR doc_id <=> component_id").alias("kept"),
    )
