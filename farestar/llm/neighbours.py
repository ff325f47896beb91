"""Approximate nearest neighbours by cosine: one small-world graph per shard, results merged.

Vectors are dealt to shards by a hash, equal ones together as one node with its least ids.  A
shard's graph is one row of the index table: its vectors and flat neighbour arrays.  Every query
meets every shard; each shard returns its nearest nodes, measured again in double precision, and
the nearest of all shards are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from farestar.llm import hnsw
from farestar.llm.common import bounded_batches, written

#: Bounds of a shard: nodes, and bytes of its vectors.  What a task holds, whatever the table.
SHARD_NODES, SHARD_BYTES = 1 << 15, 64 << 20
#: Distinct vectors that a task holds before it passes them on.
COMBINED = 1 << 14

INDEX = "dim int, shard int, ids array<array<long>>, vectors binary, places binary, degrees array<int>, links array<binary>"


def _parts(schema: str) -> tuple[list[str], list]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}

    def kind(text: str):
        return pa.list_(kind(text[6:-1])) if text.startswith("array<") else kinds[text]

    names, types = zip(*(field.split() for field in schema.split(", ")))
    return list(names), list(map(kind, types))


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, types = _parts(schema)
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (binary, floats or doubles) of the rows that take part, dim and width.

    Left out are rows without vec_id, and vectors that are NULL, all zero or hold a NULL or a
    non-finite component.
    """
    bounded_batches(vectors.sparkSession)
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    width = 4 if single else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, value in zip(batch["vec_id"].to_pylist(), batch["embedding"]):
                vector = np.array(value.as_py(), float)  # a NULL component is not a number
                if np.isfinite(vector).all() and vector.any():
                    raw = (vector + 0.0).astype(f"<f{width}").tobytes()  # no negative zero
                    rows.append((vec_id, len(vector), raw))
            yield _rows("vec_id long, dim int, vector binary", rows)

    return vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).mapInArrow(run, "vec_id long, dim int, vector binary").withColumn("width", F.lit(width))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Doubles whose largest component is below 1; scaling by powers of two changes no cosine."""
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def build_index(vectors: DataFrame, copies: int) -> DataFrame:
    """The index table: one row a shard, written.  Shards are numbered over all dimensions.

    Of equal vectors the ``copies`` least vec_ids are kept, which is all that a search for fewer
    neighbours can return; they are one node.  A vector in any number of rows leaves each task
    as one row.
    """
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[int]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*key, sorted(set(ids))[:copies]) for key, ids in held.items()]
            held.clear()
            return _rows("dim int, width int, vector binary, ids array<long>", rows)

        for batch in batches:
            for key in zip(*(batch[c].to_pylist() for c in ("dim", "width", "vector", "vec_id"))):
                ids = held.setdefault(key[:3], [])
                ids.append(key[3])
                if len(ids) > 64 * copies:
                    ids[:] = sorted(set(ids))[:copies]
            if len(held) > COMBINED:
                yield flush()
        yield flush()

    nodes = written(
        usable(vectors).mapInArrow(combine, "dim int, width int, vector binary, ids array<long>"), "vector_nodes"
    )
    first, rooms = 0, []
    for dim, width, n in nodes.groupBy("dim", "width").agg(F.count("*")).collect():  # a row a dimension
        shards = -(-n // min(SHARD_NODES, max(1, SHARD_BYTES // (dim * width))))
        rooms.append((dim, first, shards))
        first += shards
    deal = nodes.sparkSession.createDataFrame(rooms, "dim int, first int, shards int")
    dealt = nodes.join(F.broadcast(deal), "dim").withColumn(
        "shard", F.expr("CAST(first + pmod(xxhash64(vector), shards) AS INT)")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, width, held = None, 4, {}

        def finish() -> pa.RecordBatch:
            exact = np.frombuffer(b"".join(held), f"<f{width}").reshape(len(held), -1)
            graph = hnsw.build(_unit(_scaled(exact.astype(float))))
            ids = [sorted(set(found))[:copies] for found in held.values()]
            return _rows(INDEX, [(
                *place, ids, exact.tobytes(), graph.order.astype("<i4").tobytes(),
                [x.shape[1] for x in graph.links], [x.astype("<i4").tobytes() for x in graph.links],
            )])

        for batch in batches:
            for *key, kind, vector, ids in zip(*(batch[c].to_pylist() for c in ("dim", "shard", "width", "vector", "ids"))):
                if key != place:
                    if held:
                        yield finish()
                    place, width, held = key, kind, {}
                held.setdefault(vector, []).extend(ids)
        if held:
            yield finish()

    return written(
        dealt.repartitionById(max(1, first), "shard").sortWithinPartitions("dim", "shard")
        .select("dim", "shard", "width", "vector", "ids").mapInArrow(build, INDEX),
        "vector_index",
    )


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = hnsw.SEARCH_BEAM) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of every query, itself left out.

    Nearest first by cosine, ties to the smaller vec_id; fewer where the index has fewer.  Only
    vectors of one dimension are compared.  Repeated query rows count once; rows that share a
    vec_id but not the vector are searched and found each by itself.  Unusable queries (see
    ``usable``) have no row.
    """
    shards = index.groupBy("dim").agg(F.collect_set("shard").alias("shards"))  # a number a shard
    asked = usable(queries).dropDuplicates(["vec_id", "vector"]).join(shards, "dim")
    dealt = asked.select(
        "dim", F.explode("shards").alias("shard"), "vec_id", "vector", "width",
        *(F.lit(None).cast(t).alias(c) for c, t in (
            ("ids", "array<array<long>>"), ("vectors", "binary"), ("places", "binary"),
            ("degrees", "array<int>"), ("links", "array<binary>"),
        )),
    )
    tables = index.select(
        "dim", "shard", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("binary").alias("vector"),
        F.lit(None).cast("int").alias("width"), "ids", "vectors", "places", "degrees", "links",
    )
    found = "query_id long, asked binary, vec_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = graph = exact = norms = ids = None

        def load(row: dict) -> None:
            nonlocal graph, exact, norms, ids
            ids, dim = row["ids"], row["dim"]
            width = len(row["vectors"]) // (len(ids) * dim)
            exact = _scaled(np.frombuffer(row["vectors"], f"<f{width}").reshape(len(ids), dim).astype(float))
            norms = np.linalg.norm(exact, axis=1)
            order = np.frombuffer(row["places"], "<i4")
            links = [np.frombuffer(x, "<i4").reshape(-1, d) for x, d in zip(row["links"], row["degrees"])]
            graph = hnsw.Graph(order, _unit(exact)[order], links)

        def answer(part: pa.RecordBatch) -> list[tuple]:
            width = part["width"][0].as_py()
            raw = part["vector"].to_pylist()
            asked = _scaled(np.frombuffer(b"".join(raw), f"<f{width}").reshape(len(raw), -1).astype(float))
            nearest = hnsw.search(graph, _unit(asked), beam) if len(ids) > beam else None
            rows = []
            for i, own in enumerate(part["vec_id"].to_pylist()):
                nodes = np.arange(len(ids)) if nearest is None else nearest[i][nearest[i] >= 0]
                score = np.einsum("kd,d->k", exact[nodes], asked[i]) / (norms[nodes] * np.linalg.norm(asked[i]))
                kept = np.argsort(-score, kind="stable")
                kept = kept[score[kept] >= score[kept[min(k, len(kept) - 1)]]]  # ties stay for their ids
                pairs = sorted((-score[j], v) for j in kept for v in ids[nodes[j]] if v != own)[:k]
                rows += [(own, raw[i], v, float(-s)) for s, v in pairs]
            return rows

        for batch in batches:
            at = 0
            keys = list(zip(batch["dim"].to_pylist(), batch["shard"].to_pylist()))
            is_table = batch["vectors"].is_valid().to_pylist()
            while at < batch.num_rows:
                if is_table[at]:
                    place = keys[at]
                    load({c: batch[c][at].as_py() for c in ("dim", "ids", "vectors", "places", "degrees", "links")})
                    at += 1
                    continue
                end = at
                while end < batch.num_rows and not is_table[end] and keys[end] == place:
                    end += 1
                yield _rows(found, answer(batch.slice(at, end - at)))
                at = end

    both = tables.unionByName(dealt)
    tasks = (index.agg(F.max("shard")).first()[0] or 0) + 1
    answers = (
        both.repartitionById(tasks, "shard").sortWithinPartitions("dim", "shard", F.col("vectors").isNull())
        .mapInArrow(run, found)
    )
    best = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest_of_every(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """The ``k`` nearest found, among all others, of each row whose vec_id is divisible by ``every``."""
    return search(build_index(vectors, k + 1), vectors.where(F.col("vec_id") % every == 0), k)
