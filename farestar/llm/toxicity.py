"""Toxicity by compression distance: two zstandard dictionaries, calibrated on labelled text.

zstandard trains one dictionary on ordinary text and one on toxic text, both cut into windows of
words between separators.  The gain of a window is how many bytes shorter it gets when the toxic
dictionary is added to the ordinary one.  A document's measure is its k-th largest gain over
distinct windows; the length of the windows, k and the threshold are calibrated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts, tidy, written

#: Bounds of the labelled sample, in documents of a class; half fits, half calibrates.
SAMPLE_TOXIC = 4000
SAMPLE_ORDINARY = 6000
#: Bound of what trains each dictionary: windows of TRAINING_WORDS words, picked by a hash.
TRAINING_WINDOWS, TRAINING_WORDS = 16_000, 8
DICTIONARY_BYTES = 4000
#: How zstandard picks segments of toxic windows: their length, and what it counts.
SEGMENT, COUNTED = 32, 8
#: Toxic documents are mostly ordinary text.  Their windows keep the words that follow so many
#: different words there, and are so many times as common there as in ordinary text.
LEAST_CONTEXTS = 4
LEAST_RATIO = 30
#: Words of a scored window; the calibration picks one.
WIDTHS = (1, 2, 4)
SEPARATOR = b"\n\n\n"
#: Stands before every window and ends both dictionaries, so no frame falls back to raw bytes.
CARRIER = b"0123456789abcdef01234567"
LEVEL = 12
RANKS = 2
CACHED_WINDOWS = 200_000


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes  # with the ordinary one before it
    width: int  # words of a window
    rank: int  # which of the largest gains counts
    threshold: float
    prior: float | None  # the score of every text where one class had no examples


def _length(content: bytes) -> Callable[[bytes], int]:
    """Compressed length of a window under a dictionary."""
    dictionary = zstandard.ZstdCompressionDict(
        content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=128, dict_size=len(content) + len(CARRIER),
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary.precompute_compress(compression_params=parameters)
    compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)
    return lambda window: len(compressor.compress(CARRIER + SEPARATOR + window + SEPARATOR))


def gain_meter(ordinary: bytes, toxic: bytes, width: int) -> Callable[[str], list[int]]:
    """A function from a text to its ``RANKS`` largest gains, largest first, padded with 0."""
    by_ordinary, by_toxic, known = _length(ordinary), _length(toxic), {}

    def gain(window: bytes) -> int:
        value = known.get(window)
        if value is None:
            if len(known) >= CACHED_WINDOWS:
                known.clear()
            value = known[window] = by_ordinary(window) - by_toxic(window)
        return value

    def largest(text: str) -> list[int]:
        words = text.lower().encode().split()
        if width > 1:
            words = [SEPARATOR.join(words[i:i + width]) for i in range(0, len(words), width)]
        gains = sorted(map(gain, set(words)), reverse=True)[:RANKS]
        return [max(g, 0) for g in gains] + [0] * (RANKS - len(gains))

    return largest


def _measure(docs: DataFrame, ordinary: bytes, toxic: bytes, width: int) -> DataFrame:
    """doc_id and the gains of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((ordinary, toxic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest = gain_meter(*shared.value, width)
        for batch in batches:
            gains = [largest(text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(gains, pa.list_(pa.int32()))], ["doc_id", "gains"]
            )

    return texts(docs).mapInArrow(tidy(run), "doc_id long, gains array<int>")


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled texts of a bounded sample: doc_id, text, toxic, fits (else it calibrates)."""
    order = F.xxhash64("doc_id")
    # Of several labels of a document the toxic one counts.
    classes = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    picked = [
        classes.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(bound)
        for label, bound in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))
    ]
    ids = picked[0].unionByName(picked[1]).withColumn("fits", F.pmod(order, F.lit(2)) == 0)
    # The ids are at most SAMPLE_TOXIC + SAMPLE_ORDINARY rows of 13 bytes.
    return texts(docs).join(F.broadcast(ids), "doc_id")


def calibrate(ordinary: list[list[int]], toxic: list[list[int]]) -> tuple[int, int, float]:
    """The fewest errors, and the rank and threshold of gains with them, the widest gap first on a tie."""
    best = None
    for rank in range(1, RANKS + 1):
        no = np.sort([g[rank - 1] for g in ordinary])
        yes = np.sort([g[rank - 1] for g in toxic])
        top = int(max([0, *no[-1:], *yes[-1:]]))
        errors = [
            int((len(no) - np.searchsorted(no, t)) + np.searchsorted(yes, t)) for t in range(1, top + 2)
        ]
        least = min(errors)
        if best is None or least < best[0]:
            run = [t for t, e in enumerate(errors, 1) if e == least]
            end = next((a for a, b in zip(run, run[1:]) if b > a + 1), run[-1])
            best = (least, rank, (run[0] + end) / 2 - 0.5)
    return best


def _windows(words: DataFrame) -> list[bytes]:
    """Distinct windows of (doc_id, words) rows, a bounded number picked by a hash."""
    rows = (
        words.where("size(words) > 0")
        .select("words", F.explode(F.expr(f"sequence(1, size(words), {TRAINING_WORDS})")).alias("i"))
        .select(F.slice("words", F.col("i"), TRAINING_WORDS).alias("s")).distinct()
        .orderBy(F.xxhash64("s"), "s").limit(TRAINING_WINDOWS).collect()
    )
    return [SEPARATOR + SEPARATOR.join(w.encode() for w in r["s"]) + SEPARATOR for r in rows]


def _dictionary(samples: list[bytes], **picking: int) -> bytes:
    """A dictionary that zstandard trains; of too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, **picking).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _train(sample: DataFrame) -> tuple[bytes, bytes] | None:
    """The ordinary and the toxic dictionary; None if either class has no word."""
    split = sample.select(
        "doc_id", "toxic",
        F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    pairs = (
        split.withColumn("before", F.concat(F.array(F.lit("")), "words"))
        .select("toxic", F.explode(F.arrays_zip("words", "before")).alias("x"))
        .where("x.words IS NOT NULL")
        .select("toxic", F.col("x.words").alias("word"), F.col("x.before").alias("before"))
    )
    contexts = (
        pairs.groupBy("toxic", "word", "before").agg(F.count("*").alias("uses"))
        .groupBy("toxic", "word").agg(F.count("*").alias("n"), F.sum("uses").alias("uses"))
    )
    counted = written(contexts, "toxicity_words")
    size = {r["toxic"]: r["n"] for r in counted.groupBy("toxic").agg(F.sum("uses").alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return None
    telling = (
        counted.groupBy("word").agg(
            F.expr("coalesce(sum(n) FILTER (WHERE toxic = 1), 0)").alias("t"),
            F.expr("coalesce(sum(n) FILTER (WHERE toxic = 0), 0)").alias("o"),
        )
        .where(f"t >= {LEAST_CONTEXTS} AND t / {size[1]}D > {LEAST_RATIO} * (o + 0.5D) / {size[0]}D")
    )
    placed = split.where("toxic = 1").select("doc_id", F.posexplode("words").alias("i", "word"))
    told = (  # a document's words again, at most all of them
        placed.join(telling.select("word"), "word", "left_semi").groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("found"))
        .select("doc_id", F.col("found.word").alias("words"))
    )
    ordinary = _dictionary(_windows(split.where("toxic = 0").select("doc_id", "words")))
    toxic = _dictionary(_windows(told), k=SEGMENT, d=COUNTED, steps=4, level=3)
    return ordinary, ordinary + toxic


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train and calibrate on a bounded sample of labelled rows (the constants above).

    The ordinary dictionary stands before the toxic one in both measures, so that only what is
    toxic tells them apart.  Toxic windows keep the words that are common in toxic text only and
    keep different company there (copies of one document count once).  Width, rank and threshold
    come from one half of the sample, measured by dictionaries of the other half; the final
    dictionaries use both.  Of several labels of a document the toxic one counts.
    """
    sample = written(_sample(docs, labels), "toxicity_sample")
    whole = _train(sample)
    if whole is None:
        return Model(b"", b"", 1, 1, 0.0, float(not sample.where("toxic = 1").isEmpty()))
    half = _train(sample.where("fits")) or whole
    best = None
    for width in WIDTHS:
        gains = {0: [], 1: []}
        rest = sample.where("NOT fits")
        for label in gains:
            measured = _measure(rest.where(f"toxic = {label}"), *half, width)
            gains[label] = [r["gains"] for r in measured.select("gains").collect()]
        errors, rank, threshold = calibrate(gains[0], gains[1])
        if best is None or errors < best[0]:
            best = (errors, width, rank, threshold)
    return Model(*whole, *best[1:], None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) of every row of ``docs``.

    Map-only.  NULL and empty texts have no window and score as the least toxic text; repeated
    rows give repeated rows.
    """
    if model.prior is not None:
        scored = texts(docs).select("doc_id", F.lit(model.prior).alias("score"))
    else:
        gain = F.col("gains")[model.rank - 1] - F.lit(float(model.threshold))
        scored = _measure(docs, model.ordinary, model.toxic, model.width).select(
            "doc_id", (1 / (1 + F.exp(-gain))).alias("score")
        )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_predicted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, map-only, with all their columns."""
    if model.prior is not None:
        return docs.where(F.lit(model.prior < 0.5))
    shared = docs.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic))
    at, width, rank, threshold = docs.columns.index("text"), model.width, model.rank, model.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest = gain_meter(*shared.value, width)
        for batch in batches:
            keep = [largest(text.as_py() or "")[rank - 1] < threshold for text in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
