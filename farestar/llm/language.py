"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import texts

ORDERS = (2, 3)
FEATURES = 1 << 15
SMOOTHING = 0.5
#: Expected number of learned documents of a language; of more, a hash of doc_id picks so many.
DOCS_PER_LANGUAGE = 6000
#: Texts are scored in blocks of about so many characters, to bound the arrays.
BLOCK_CHARS = 1 << 18
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Log-probabilities of every hashed n-gram by language, and log-priors."""

    languages: tuple[str, ...]
    log_prob: np.ndarray  # (FEATURES, languages) float32
    log_prior: np.ndarray


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of a text, lower case, with a space at either end.

    They come in slices of at most ``BLOCK_CHARS`` places, however long the text.
    """
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    for start in range(0, len(code), BLOCK_CHARS):
        parts = []
        for order in ORDERS:
            piece = code[start:start + BLOCK_CHARS + order - 1]
            value = np.full(max(len(piece) - order + 1, 0), order, np.uint32)
            for shift in range(order):
                value = value * np.uint32(0x01000193) ^ piece[shift:shift + len(value)]
            value = value * np.uint32(0x9E3779B1)
            parts.append(value >> np.uint32(32 - FEATURES.bit_length() + 1))
        yield np.concatenate(parts)


def picked_below(docs: int, expected: int) -> int | None:
    """Signed 64-bit hashes below this are sampled, so that ``expected`` of ``docs`` are; None: all."""
    return None if docs <= expected else (expected << 64) // docs - (1 << 63)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n-gram counts over this task: one row per language and feature met."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            total = counts.setdefault(lang.as_py(), np.zeros(FEATURES, np.int64))
            for features in ngrams(text.as_py()):
                total += np.bincount(features, minlength=FEATURES)
    for lang, total in counts.items():
        feature = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(feature), pa.string()), pa.array(feature, pa.int32()),
             pa.array(total[feature], pa.int64())],
            ["lang", "feature", "n"],
        )


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from (doc_id, text, lang) rows; rows without a language are left out.

    The priors come from all rows.  The n-gram counts come from a sample of ``docs_per_language``
    expected documents a language, all of them where there are fewer, picked by a hash of doc_id.
    """
    known = labelled.where("lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    picked = F.lit(False)
    for lang, n in sizes.items():
        below = picked_below(n, docs_per_language)
        sampled = F.lit(True) if below is None else F.xxhash64("doc_id") < F.lit(below)
        picked = picked | ((F.col("lang") == lang) & sampled)
    rows = (
        known.where(picked).select("lang", F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(_count, "lang string, feature int, n long")
        .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    )  # at most FEATURES rows a language
    counts = np.zeros((FEATURES, len(languages)))
    column = rows["lang"].map({lang: i for i, lang in enumerate(languages)})
    counts[rows["feature"].to_numpy(int), column.to_numpy(int)] = rows["n"]
    log_prob = np.log(counts + SMOOTHING) - np.log(counts.sum(0) + SMOOTHING * FEATURES)
    weight = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, log_prob.astype(np.float32), np.log(weight / weight.sum()))


def _blocks(values: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about BLOCK_CHARS characters; a longer text is one by itself."""
    block, size = [], 0
    for text in values:
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def score_texts(model: Model, values: list[str]) -> tuple[list[str], list[float]]:
    """Predicted language and its share of the posterior, tempered by the number of n-grams."""
    labels, scores = [], []
    for block in _blocks(values):
        # A sparse row per text times the matrix: gather the rows of its n-grams, add them up.
        if len(block) == 1:
            sizes, total = np.zeros(1), np.zeros((1, len(model.languages)))
            for features in ngrams(block[0]):
                sizes += len(features)
                total += model.log_prob[features].sum(0, dtype=float)
        else:
            features = [np.concatenate(list(ngrams(text))) for text in block]
            sizes = np.array([len(f) for f in features])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            total = np.add.reduceat(model.log_prob[np.concatenate(features)], starts, axis=0, dtype=float)
        total = total / np.sqrt(sizes)[:, None] + model.log_prior
        odds = np.exp(total - total.max(1, keepdims=True))
        best = odds.argmax(1)
        scores += (odds.max(1) / odds.sum(1)).tolist()
        labels += [model.languages[i] for i in best]
    return labels, scores


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of every row of ``docs``, map-only.

    A NULL text, or one without a letter, is ``und`` with score 0; so is every text when the
    model knows no language.  Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.log_prob, model.log_prior)
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            values = batch["text"].to_pylist()
            label, score = [UNKNOWN] * len(values), [0.0] * len(values)
            letters = [
                i for i, text in enumerate(values)
                if known.languages and any(map(str.isalpha, text))
            ]
            found = score_texts(known, [values[i] for i in letters])
            for i, name, value in zip(letters, *found):
                label[i], score[i] = name, value
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(label, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return texts(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")
