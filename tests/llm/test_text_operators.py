import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from farestar.llm import bpe, dac, exact, language, packing, quality, toxicity
from tests.llm.brute import base_measures

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return (row[0] is None, row[0] or 0, *map(str, row[1:]))


def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


# --- bpe -------------------------------------------------------------------------------------


def test_bpe_equals_the_library_and_round_trips(docs_of, odd_rows):
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs_of(odd_rows), RANKS, public_tokenizers.PATTERN, buckets=4)
    got = sorted(map(tuple, bpe.decode(encoded, RANKS).collect()), key=key)
    expected = []
    for doc_id, text in odd_rows:
        ids = coder.encode_ordinary(text or "")
        expected.append((
            doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ))
    assert got == sorted(expected, key=key)
    texts = sorted(map(tuple, bpe.decode_texts(encoded, RANKS).collect()), key=key)
    assert texts == sorted([(d, t or "") for d, t in odd_rows], key=key)


def test_bpe_of_an_empty_table(docs_of):
    assert bpe.decode(bpe.encode(docs_of([]), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


# --- directly addressable codes --------------------------------------------------------------


def test_codes_read_back_what_the_library_gives(docs_of, odd_rows):
    encode = library(WORD_JSON)
    segments = dac.write_codes(docs_of(odd_rows), WORD_JSON, end_id=2)
    got = sorted(map(tuple, dac.read_codes(segments).collect()), key=lambda r: r[1])
    expected, start = [], 0
    for doc_id, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text), 2]
        expected.append((doc_id, len(ids), crc(ids)))
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert sorted(map(str, ((r[0], r[2], r[3]) for r in got))) == sorted(map(str, expected))


def test_single_ids_are_read_alone(spark, docs_of, prose):
    encode = library(WORD_JSON)
    rows = [(i, prose(i, 3)) for i in range(20)]
    segments = dac.write_codes(docs_of(rows), WORD_JSON, end_id=2)
    flat = {}
    for row in segments.orderBy("block", "packet").collect():
        ids = [i for d in row.doc_ids for i in [*encode(dict(rows)[d]), 2]]
        flat.update({(row.block, row.packet, p): v for p, v in enumerate(ids)})
    asked = spark.createDataFrame(list(flat)[::7], "block long, packet int, position long")
    got = {tuple(r)[:3]: r.id for r in dac.get_ids(segments, asked).collect()}
    assert got == {place: flat[place] for place in list(flat)[::7]}


def test_segment_files_ascend_by_doc_id(spark, docs_of, prose):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = dac.write_codes(docs_of([(i, prose(i)) for i in range(90, 0, -1)]), WORD_JSON, end_id=2)
        rows = segments.select(F.input_file_name().alias("file"), "block", "packet", "doc_ids").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.file for r in rows}) > 1
    rows.sort(key=lambda r: (r.file, r.block, r.packet))
    assert [d for r in rows for d in r.doc_ids] == list(range(1, 91))


def test_added_tokens_in_texts_are_as_the_library_has_them(docs_of, prose):
    rows = [(1, "hello <|endoftext|> x"), (2, prose(1) + "<|endoftext|>"), (3, "<|startoftext|>a <|ENDOFTEXT|>")]
    codes = {r.doc_id: r for r in dac.read_codes(dac.write_codes(docs_of(rows), WORD_JSON, end_id=2)).collect()}
    packed = {r.doc_id: r for r in packing.pack(docs_of(rows), BYTE_JSON, end_id=1).collect()}
    for doc_id, text in rows:
        assert codes[doc_id].ids_crc32 == crc(library(WORD_JSON)(text) + [2])
        assert packed[doc_id].ids_crc32 == crc(library(BYTE_JSON)(text) + [1])
    assert 50256 in library(BYTE_JSON)(rows[0][1])


def test_codes_of_an_empty_table(docs_of):
    assert dac.read_codes(dac.write_codes(docs_of([]), WORD_JSON, end_id=2)).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**32 - 1, 7], list(range(0, 70000, 13))])
def test_code_levels(ids):
    import numpy as np

    codes = dac.Codes(*dac.build(np.array(ids, np.uint32)))
    assert [codes.get(i) for i in range(0, len(ids), 11)] == ids[::11]
    for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2)):
        assert codes.slice(a, b).tolist() == ids[a:b]


# --- packing ---------------------------------------------------------------------------------


@pytest.mark.parametrize("window", [2048, 64])
def test_packing_places_every_id_once(docs_of, odd_rows, prose, window):
    rows = odd_rows + [(100 + i, prose(i)) for i in range(60)] + [(500 + i, "one two three") for i in range(90)]
    encode = library(BYTE_JSON)
    pieces = packing.pack(docs_of(rows), BYTE_JSON, end_id=1, window=window).collect()
    by_document = {}
    for doc_id, text in rows:
        by_document.setdefault(doc_id, []).append([*encode(text), 1])
    placed = {}
    for piece in pieces:
        placed.setdefault(piece.doc_id, []).append(piece)
        versions = [ids for ids in by_document[piece.doc_id] if len(ids) == piece.doc_tokens]
        cuts = {crc(ids[piece.start:piece.start + piece.length]) for ids in versions}
        assert piece.ids_crc32 in cuts
    for doc_id, versions in by_document.items():
        assert sum(p.length for p in placed[doc_id]) == sum(map(len, versions))
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append((piece.offset, piece.length))
    short = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
        short += at < window
    assert short <= 1 and sorted(sequences) == list(range(len(sequences)))


def test_plan_uses_solved_combinations():
    import numpy as np

    histogram = np.zeros(64, np.int64)
    histogram[[10, 54, 20, 44, 12, 22, 30]] = [400, 400, 300, 300, 90, 90, 90]
    plan = packing.make_plan(histogram, whole_windows=5, window=64)
    assert plan.planned.sum() >= 0.9 * histogram.sum()
    filled = {}
    for length in np.flatnonzero(histogram):
        for rank in range(histogram[length]):
            for sequence, offset, size in plan.place(int(length), rank):
                filled.setdefault(sequence, []).append((offset, size))
    assert min(filled) == 5 and max(filled) == plan.end - 1
    for found in filled.values():
        at = 0
        for offset, size in sorted(found):
            assert offset == at
            at += size


def test_packing_an_empty_table(docs_of):
    assert packing.pack(docs_of([]), BYTE_JSON, end_id=1).count() == 0


# --- exact dedup -----------------------------------------------------------------------------


def test_exact_groups(docs_of, odd_rows):
    got = exact.exact_groups(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    groups = {}
    for doc_id, text in odd_rows:
        bare = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(hashlib.sha256(bare.encode()).hexdigest(), []).append((doc_id, len(text or "")))
    for row in got:
        group = groups[row.text_sha256]
        longest = max(n for _, n in group)
        ids = [d for d, n in group if n == longest and d is not None]
        assert row.group_size == len(group) and row.keep_id == (min(ids) if ids else None)
    for digest, group in groups.items():
        assert sum(r.kept for r in got if r.text_sha256 == digest) == 1
    assert exact.exact_groups(docs_of([])).count() == 0


# --- quality ---------------------------------------------------------------------------------


def test_ledger_equals_brute_force(docs_of, odd_rows):
    rows = odd_rows + [(20, "a b c a b c\nx\nx\n\n y # <b>\nx"), (21, "z z z z z"), (22, "#*$%&|<>")]
    got = sorted(
        (tuple(r)[:6] for r in quality.rule_ledger(docs_of(rows)).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
        ).collect()), key=key,
    )
    assert got == sorted([(d, *base_measures(t)) for d, t in rows], key=key)
    assert quality.rule_ledger(docs_of([])).count() == 0


def test_policies_and_ablations(docs_of, prose):
    rows = [(1, prose(1)), (2, "short"), (3, " ".join(["again and again"] * 40)), (4, prose(4) + " #" * 30)]
    ledger = quality.rule_ledger(docs_of(rows))
    bits = {r.doc_id: r.failure_bits for r in ledger.collect()}
    assert bits == {
        1: 0, 2: quality.BIT["few_words"], 3: quality.BIT["repeated_words"],
        4: quality.BIT["symbols"],
    }
    kept = {v: {r.doc_id for r in ledger.where(quality.kept_by(v)).collect()} for v in quality.POLICIES}
    assert kept == {1: {1, 4}, 2: {1}, 3: {1}}
    table = {(r.version, r.rule): r for r in quality.ablations(ledger).collect()}
    assert len(table) == sum(map(len, quality.POLICIES.values()))
    assert table[1, "few_words"].removed_alone == 1 and table[1, "few_words"].removed == 2
    assert table[2, "symbols"].failed == 1 and table[2, "symbols"].kept == 1
    assert table[2, "symbols"].fails_with == 0


# --- language --------------------------------------------------------------------------------


def test_language_learns_and_holds_out(spark, sf_dir):
    from farestar.llm.queries import op10_language

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op10_language(spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def plain_language(model, text):
    """The language of a text and its score, n-gram by n-gram."""
    code = [ord(c) for c in f" {text.lower()} "]
    total, n = [0.0] * len(model.languages), 0
    for order in language.ORDERS:
        for at in range(len(code) - order + 1):
            value = order
            for c in code[at:at + order]:
                value = (value * 0x01000193 ^ c) % (1 << 32)
            feature = (value * 0x9E3779B1) % (1 << 32) >> (32 - 15)
            total = [t + float(p) for t, p in zip(total, model.log_prob[feature])]
            n += 1
    total = [t / n ** 0.5 + float(p) for t, p in zip(total, model.log_prior)]
    odds = [math.exp(t - max(total)) for t in total]
    return model.languages[odds.index(max(odds))], max(odds) / sum(odds)


def test_language_equals_brute_force(spark, sf_dir, odd_rows, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs)
    texts = [r.text for r in docs.where("text <> ''").limit(40).collect()] + [t for _, t in odd_rows if t]
    for block in (language.BLOCK_CHARS, 700):
        monkeypatch.setattr(language, "BLOCK_CHARS", block)
        for text, *got in zip(texts, *language.score_texts(model, texts)):
            expected = plain_language(model, text)
            assert got[0] == expected[0] and abs(got[1] - expected[1]) < 1e-5


@pytest.mark.parametrize("docs", [7000, 10**6, 10**10, 10**13])
def test_a_language_of_any_size_is_learned_from(docs):
    assert language.picked_below(6000, 6000) is None
    share = (language.picked_below(docs, 6000) + 2**63) / 2**64
    assert share * docs == pytest.approx(6000, rel=1e-5)


def test_a_very_long_text_is_scored_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    model = language.Model(("a", "b"), rng.random((language.FEATURES, 2), np.float32), np.zeros(2))
    text = "some words of a long text " * 800_000
    tracemalloc.start()
    language.score_texts(model, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 20_000_000 and peak < 300 << 20


def test_language_of_odd_texts(spark, docs_of, odd_rows):
    labelled = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None)],
        "doc_id long, text string, lang string",
    )
    model = language.fit(labelled)
    assert model.languages == ("de", "en")
    got = language.identify(docs_of(odd_rows + [(30, "12 34 !"), (31, "und der hund")]), model).collect()
    assert len(got) == len(odd_rows) + 2
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].lang_pred == by_id[2].lang_pred == by_id[3].lang_pred == by_id[30].lang_pred == "und"
    assert by_id[31].lang_pred == "de" and by_id[8].lang_pred == "en"
    nothing = language.fit(labelled.where("lang = 'fr'"))
    assert {r.lang_pred for r in language.identify(docs_of(odd_rows), nothing).collect()} == {"und"}


# --- toxicity --------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    from farestar.llm.queries import op3_toxicity

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    rows = op3_toxicity(spark, folder).join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert sum(r.predicted != r.toxic for r in held) <= 0.06 * len(held)
    learned = [r for r in rows if not r.held_out and r.toxic is not None]
    assert sum(r.predicted and not r.toxic for r in learned) <= 0.02 * len(learned)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def plain_toxicity(model, text):
    """The score of a text: every window compressed afresh under both dictionaries."""
    import zstandard

    def length(content, window):
        dictionary = zstandard.ZstdCompressionDict(
            content + toxicity.CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        parameters = zstandard.ZstdCompressionParameters.from_level(
            toxicity.LEVEL, source_size=128, dict_size=len(content) + len(toxicity.CARRIER),
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        dictionary.precompute_compress(compression_params=parameters)
        packed = zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)
        return len(packed.compress(toxicity.CARRIER + window))

    words = (text or "").lower().encode().split()
    gains = []
    for at in range(0, len(words), model.width):
        window = b"".join(toxicity.SEPARATOR + w for w in words[at:at + model.width]) + toxicity.SEPARATOR
        if window not in (w for w, _ in gains):
            gains.append((window, length(model.ordinary, window) - length(model.toxic, window)))
    ranked = sorted((g for _, g in gains), reverse=True) + [0] * model.rank
    return 1 / (1 + math.exp(model.threshold - max(ranked[model.rank - 1], 0)))


@pytest.mark.parametrize("width, rank", [(1, 1), (1, 2), (4, 2)])
def test_toxicity_equals_brute_force(docs_of, odd_rows, prose, width, rank):
    samples = [b"\n\n\nvile\n\n\nscoundrel\n\n\n", b"\n\n\nthe\n\n\nquick\n\n\nriver\n\n\n" * 3]
    model = toxicity.Model(samples[1], samples[1] + samples[0], width, rank, 2.5, None)
    rows = [(d, t) for d, t in odd_rows if len(t or "") < 5000]
    rows += [(50, "a vile scoundrel"), (51, prose(3) + " Vile  scoundrel vile"), (52, "vile " * 9)]
    got = sorted(map(tuple, toxicity.score(docs_of(rows), model).collect()), key=key)
    expected = [(d, s := plain_toxicity(model, t), int(s >= 0.5)) for d, t in rows]
    assert [(r[0], round(r[1], 9), r[2]) for r in got] == [
        (r[0], round(r[1], 9), r[2]) for r in sorted(expected, key=key)
    ]
    assert {r[2] for r in got} == ({0, 1} if (width, rank) == (1, 1) else {r[2] for r in expected})


def test_toxicity_of_odd_texts(spark, docs_of, odd_rows, prose):
    rows = [(i, prose(i) + (" vile scoundrel" if i % 2 else "")) for i in range(100, 160)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels)
    docs = docs_of(odd_rows + [(900, prose(900)), (901, "what a vile scoundrel he is")])
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[901].predicted == 1 and got[900].predicted == 0
    assert got[1].predicted == got[2].predicted == 0
    kept = toxicity.drop_predicted(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    for label in (0, 1):
        one = toxicity.fit(docs_of(rows), labels.where(f"toxic = {label}"))
        assert {r.predicted for r in toxicity.score(docs, one).collect()} == {label}
