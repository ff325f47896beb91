"""Quality rules as a ledger of failure bits, judged by versioned policies.

Every rule is evaluated once for a document.  The ledger holds the measurements and one integer
whose bit i says that rule i failed; a policy is a mask over those bits, so a new policy or an
ablation never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from farestar.llm.common import SPACES, texts

SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule name -> SQL condition over the measurements that says the rule failed; all integers.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "2 * word_chars < 5 * n_words",
    "long_words": "word_chars > 12 * n_words",
}

BIT = {rule: 1 << i for i, rule in enumerate(RULES)}
BASE = ("few_words", "repeated_words")

#: Version -> rules that reject a document under it.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines"),
    3: tuple(RULES),
}


def policy_mask(version: int) -> int:
    return sum(BIT[rule] for rule in POLICIES[version])


def repeated_positions(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) >= 1 << 20:  # the product of three would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        windows = pairs[:-1] * (len(pairs) + 1) + pairs[1:]
    else:
        windows = pairs[:-1] * len(seen) + ids[2:]
    _, group, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[group] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, SPACES.encode()))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - blanks, symbols, len(lines), len(lines) - len(set(lines)),
        repeated_positions(words),
    )


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(x.as_py()) for x in batch["text"]]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 6
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *MEASURES])


def rule_ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements, failure_bits.

    Map-only.  NULL and empty texts measure 0 everywhere and fail ``few_words``; repeated rows
    give repeated rows; a NULL doc_id stays NULL.
    """
    schema = ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)])
    measured = texts(docs).mapInArrow(_measure_batches, schema)
    bits = " + ".join(f"IF({test}, {BIT[rule]}L, 0L)" for rule, test in RULES.items())
    return measured.withColumn("failure_bits", F.expr(bits))


def kept_by(version: int) -> Column:
    """Whether a ledger row passes every rule of a policy."""
    return F.col("failure_bits").bitwiseAND(F.lit(policy_mask(version))) == 0


def ablations(ledger: DataFrame) -> DataFrame:
    """What each rule does within each policy: one row per (version, rule).

    ``failed``: documents that fail the rule; ``removed_alone``: those that no other rule of the
    policy rejects; ``removed`` and ``kept``: by the whole policy; ``fails_with``: the rules of
    the policy that fail in any document together with this one, as bits.  The ledger is reduced
    to one row per bit pattern (at most 2^rules) before the policies meet it.
    """
    patterns = ledger.groupBy("failure_bits").agg(F.count("*").alias("documents"))
    cases = F.array(*[
        F.struct(
            F.lit(version).alias("version"), F.lit(rule).alias("rule"),
            F.lit(BIT[rule]).cast("long").alias("bit"),
            F.lit(policy_mask(version)).cast("long").alias("mask"),
        )
        for version, rules in POLICIES.items() for rule in rules
    ])
    total = "CAST(coalesce(sum(documents) FILTER (WHERE {}), 0) AS LONG)"
    return (
        patterns.withColumn("case", F.explode(cases)).select("failure_bits", "documents", "case.*")
        .groupBy("version", "rule").agg(
            F.expr(total.format("failure_bits & bit <> 0")).alias("failed"),
            F.expr(total.format("failure_bits & mask = bit")).alias("removed_alone"),
            F.expr(total.format("failure_bits & mask <> 0")).alias("removed"),
            F.expr(total.format("failure_bits & mask = 0")).alias("kept"),
            F.expr(
                "coalesce(bit_or(failure_bits & mask & ~bit) FILTER (WHERE failure_bits & bit <> 0), 0L)"
            ).alias("fails_with"),
        )
    )
