import re
from collections import Counter

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from farestar.llm import oracle, queries, toxicity
from farestar.llm.common import documents, id_remainder, keep_rows, text_digest, written
from harness.compare import differences
from tests.llm.brute import near_components


@pytest.mark.parametrize("name", oracle.all_sql())
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(queries.all_queries()[name](spark, sf_dir), sf_dir, oracle.all_sql()[name]) is None


def test_all_are_registered():
    found = entry_points.queries()
    numbers = {name[2:].split("_")[0] for name in found if name.startswith("op") and name[2].isdigit()}
    assert numbers == {str(n) for n in range(1, 14)} and "pipeline" in found
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"
    ]


def test_keep_rows(spark, docs_of):
    docs = docs_of([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d"), (None, "d"), (4, "e")])
    rows = docs.withColumn("digest", text_digest()).select("doc_id", "digest")
    order = "row_number() OVER (PARTITION BY doc_id ORDER BY digest)"
    decided = rows.selectExpr("*", f"(doc_id IS NULL OR doc_id < 3) AND {order} = 1 AS kept")
    kept = keep_rows(docs, decided)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(1, "a"), (2, None), (None, "d")]


def test_stages(spark, docs_of, odd_rows, prose, sf_dir):
    """Odd rows and extra columns with names that the operators use inside."""
    rows = odd_rows + [(100 + i, prose(100 + i)) for i in range(5)]
    docs = docs_of(rows).selectExpr("*", "1 AS ids", "'x' AS row", "2 AS block", "3L AS node", "'y' AS words")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            result = stage(spark, given, sf_dir)
            if name != "packing":
                assert result.columns == docs.columns
            count = result.count()
            if name in ("toxicity", "substring_dedup") and given is docs:
                assert count == len(rows)


def test_run(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    kept = pieces.select("doc_id").distinct().count()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0.6 * documents < kept < documents


def plain_exact(rows):
    """Of texts equal but for white space, the longest row, then the least doc_id."""
    groups = {}
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc_id, text))
    return {(d, t) for _, d, t in map(min, groups.values())}


def test_stages_equal_brute_force(spark, sf_dir):
    """Each stage over what the one before it kept, on a given table."""
    from tests.llm.test_duplicates import repeated_words
    from tests.llm.test_text_operators import BYTE_JSON, crc, library, plain_toxicity

    given = documents(spark, sf_dir)
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        found = written(stages[name](spark, docs, sf_dir), "brute")
        return found, {(r.doc_id, r.text) for r in found.collect()} if "text" in found.columns else None

    rows = {(r.doc_id, r.text) for r in given.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(given, labels.where(id_remainder(5) != 0))
    docs, kept = run("toxicity", given)
    assert kept == {(d, t) for d, t in rows if plain_toxicity(model, t) < 0.5}
    docs, singles = run("exact_dedup", docs)
    assert singles == plain_exact(kept)
    docs, apart = run("near_dedup", docs)
    component = near_components(sorted(singles))
    assert apart == {(d, t) for d, t in singles if component[d] == d}
    docs, cut = run("substring_dedup", docs)
    before, after = dict(apart), dict(cut)
    repeated, seen = repeated_words([(d, t or "") for d, t in apart]), set()
    for doc_id in sorted(before):
        words = (before[doc_id] or "").lower().split()
        fives = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        if not fives & seen:
            assert after[doc_id] == before[doc_id]
        left = Counter((after[doc_id] or "").lower().split())
        assert left <= Counter(words)
        assert sum((Counter(words) - left).values()) >= len(repeated[doc_id])
        seen |= fives
    assert set(after) == set(before)
    encode, pieces = library(BYTE_JSON), {}
    for piece in stages["packing"](spark, docs, sf_dir).collect():
        pieces.setdefault(piece.doc_id, []).append(piece)
    assert set(pieces) == set(after)
    for doc_id, text in after.items():
        ids, found = [*encode(text), 1], sorted(pieces[doc_id], key=lambda p: p.start)
        assert [p.start for p in found] == [sum(p.length for p in found[:i]) for i in range(len(found))]
        assert sum(p.length for p in found) == len(ids) == found[0].doc_tokens
        assert all(p.ids_crc32 == crc(ids[p.start:p.start + p.length]) for p in found)


def test_tasks_of_the_pipeline_hold_less_at_once(spark, docs_of, prose, monkeypatch):
    """Batches stay small in every stage, and packing is done in the smaller blocks."""
    from farestar.llm import common, packing

    held, given = spark.conf.get(common._BATCH_CONF), []
    blocks = packing.encode_blocks

    def seen(*values, **named):
        given.append((named["block_chars"], spark.conf.get(common._BATCH_CONF)))
        return blocks(*values, **named)

    monkeypatch.setattr(packing, "encode_blocks", seen)
    monkeypatch.setattr(corpus_pipeline, "documents", lambda *_: docs_of([(i, prose(i)) for i in range(9)]))
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:])
    try:
        for most in ("8388608", "64MB"):
            spark.conf.set(common._BATCH_CONF, most)
            assert corpus_pipeline.run(spark, "").select("doc_id").distinct().count() > 0
    finally:
        spark.conf.set(common._BATCH_CONF, held)
    assert set(given) == {(corpus_pipeline.PACKED_CHARS, str(corpus_pipeline.BATCH_BYTES))}
    assert corpus_pipeline.BATCH_BYTES < common.BATCH_BYTES
