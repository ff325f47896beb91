import random

import numpy as np
import pytest

from farestar.llm import chaining, minhash, substrings
from farestar.llm.components import components
from farestar.llm.suffixes import suffix_order
from tests.llm.brute import near_components, shingles, without_repeats


def edited(text, changes, seed):
    words, pick = text.split(), random.Random(seed)
    for at in pick.sample(range(len(words)), changes):
        words[at] = f"edit{seed}n{at}"
    return " ".join(words)


@pytest.fixture
def corpus(prose, odd_rows):
    base = prose(50, 3)
    rows = odd_rows + [(100 + i, prose(100 + i, 2)) for i in range(15)]
    rows += [(200 + i, edited(base, 3, i)) for i in range(25)]
    rows += [(300 + i, prose(7, 2)) for i in range(12)]
    return rows + [(400, base), (401, prose(60) + " " + base), (402, base + " " + prose(61))]


# --- near duplicates -------------------------------------------------------------------------


def test_components_of_a_path_and_a_star(spark):
    nodes = spark.range(60).withColumnRenamed("id", "node")
    links = [(i, i + 1) for i in range(20)] + [(30, 31 + i) for i in range(20)]
    found = components(nodes, spark.createDataFrame(links, "a long, b long")).collect()
    label = {r.node: r.label for r in found}
    assert {label[i] for i in range(21)} == {0} and {label[i] for i in range(30, 51)} == {30}
    assert label[25] == 25 and len(found) == 60


def test_near_duplicates_equal_brute_force(docs_of, corpus):
    rows = [(d, t) for d, t in corpus if d is not None]
    got = minhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    expected = near_components(rows)
    sizes = {}
    for doc_id, text in rows:
        sizes.setdefault(doc_id, set()).add(len(shingles(text)))
    for row in got:
        assert row.component_id == expected[row.doc_id] and row.n_shingles in sizes[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def test_near_duplicates_of_odd_tables(docs_of, prose):
    rows = [(None, prose(1)), (None, prose(1)), (3, prose(1)), (None, None), (4, None), (5, "")]
    got = sorted(
        ((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in
         minhash.near_duplicates(docs_of(rows)).collect()), key=str,
    )
    assert got == sorted(
        [(None, True, 3, False), (None, True, 3, False), (3, True, 3, True), (None, False, None, True),
         (4, False, 4, True), (5, False, 5, True)], key=str,
    )
    assert minhash.near_duplicates(docs_of([])).count() == 0


def test_a_bucket_that_spans_components_is_searched_whole(docs_of, prose, monkeypatch):
    """With one band of one row nearly all documents share buckets; the rounds still find all."""
    monkeypatch.setattr(minhash, "BANDS", 2)
    monkeypatch.setattr(minhash, "ROWS", 1)
    rows = [(i, edited(prose(i % 7, 2), 2, i)) for i in range(60)]
    rows = [(i, "common words stand in all of them " * 3 + t) for i, t in rows]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == near_components(rows)


def half_shared(n):
    """Documents of one base whose edits each stand in about two of them: alike, but not linked."""
    pick = random.Random(n)
    base, pool = [f"b{i}" for i in range(300)], [f"e{i}" for i in range(9 * n)]
    rows = []
    for doc_id in range(n):
        words = list(base)
        for at in pick.sample(range(300), 18):
            words[at] = pick.choice(pool)
        rows.append((doc_id, " ".join(words)))
    return rows


def test_candidates_grow_with_the_rows(docs_of, monkeypatch):
    made, confirmed = [], minhash._confirmed

    def counted(pairs, sets):
        made.append(pairs.count())
        return confirmed(pairs, sets)

    monkeypatch.setattr(minhash, "_confirmed", counted)
    totals = []
    for n in (100, 200):
        rows = half_shared(n)
        made.clear()
        found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
        assert found == near_components(rows)
        totals.append(sum(made))
    assert totals[0] < 10 * 100 and totals[1] < 2.5 * totals[0]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    circulant = minhash.Circulant()
    pool = rng.integers(0, 2**63, 3000, np.uint64) * np.uint64(2)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    same = (circulant.signature(a) == circulant.signature(b)).mean()
    assert abs(same - 1500 / 2500) < 0.15


# --- suffix order and exact substrings -------------------------------------------------------


@pytest.mark.parametrize("budget", [0, 64, 1 << 20])
def test_suffix_order_equals_sorting(budget):
    rng = np.random.default_rng(1)
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 6)):
            parts += [rng.integers(2, 2 + rng.integers(1, 5), rng.integers(0, 30)), [1]]
        text = np.concatenate([*parts, [0]]).astype(np.uint16)
        symbols = text.tolist()
        expected = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert suffix_order(text, len(text), budget).tolist() == expected


def test_suffixes_told_apart_are_not_sorted_again(monkeypatch):
    """Only equal runs that are shorter than the depth are ranked anew, and order holds to the depth."""
    rng = np.random.default_rng(2)
    repeated, single = rng.integers(2, 6, 120), rng.integers(2, 200, 20000)
    text = np.concatenate([repeated, [1], single, [1], repeated, [1], [0]]).astype(np.uint16)
    sizes, argsort = [], np.argsort

    def counted(values, kind=None, **named):
        if kind is None:
            sizes.append(len(values))
        return argsort(values, kind=kind, **named)

    monkeypatch.setattr(np, "argsort", counted)
    order = suffix_order(text, 50).tolist()
    assert sum(sizes) < 1000
    symbols = text.tolist()
    cut = [symbols[i:i + 50] for i in order]
    assert sorted(order) == list(range(len(symbols))) and cut == sorted(cut)


def test_shards_sorted_in_parts_equal_brute_force(corpus, monkeypatch):
    """Segments of different minimizers are sorted apart; small shards take every path of it."""
    most, sort = [], substrings._gone

    def seen(raw, *rest):
        most.append(len(raw))
        return sort(raw, *rest)

    rows = corpus
    texts = [(i, (t or "").encode()) for i, t in rows if i is not None]
    raw = np.frombuffer(b"".join(t for _, t in texts), np.uint8)
    value, doc, start, count = substrings.segments(raw, np.array([len(t) for _, t in texts], np.int64))
    ids = np.array([i for i, _ in texts])[doc].tolist()
    pieces = [raw[a:a + n + substrings.LENGTH - 1].tobytes() for a, n in zip(start.tolist(), count.tolist())]
    parts = [substrings.pack_numbers(x) for x in (count, np.ones_like(count), start)]
    parts.append(substrings.zstandard.compress(b"".join(pieces)))
    row = {"block": 0, "doc_ids": ids, "sizes": [len(p) for p in parts], "content": b"".join(parts)}
    monkeypatch.setattr(substrings, "_gone", seen, raising=False)
    removed = []
    for size in (1 << 30, 1 << 9):
        monkeypatch.setattr(substrings, "SORT_BYTES", size, raising=False)
        runs = [substrings._read_runs(p["content"][0].as_py()) for p in substrings._judge([row])]
        removed.append({i for first, last in runs for a, b in zip(first.tolist(), last.tolist()) for i in range(a, b)})
    assert len(most) > 2 and max(most[1:]) < most[0]
    first = {}
    strings = [(a + i, d, p[i:i + substrings.LENGTH]) for a, d, p in zip(start.tolist(), ids, pieces) for i in range(len(p) - substrings.LENGTH + 1)]
    for _, d, text in strings:
        first[text] = min(d, first.get(text, d))
    assert removed[0] == removed[1] == {at for at, d, text in strings if d > first[text]}


def test_segments_are_runs_of_one_minimizer():
    pick = random.Random(3)
    for _ in range(60):
        texts = [bytes(pick.choice(b"abc") for _ in range(pick.choice([0, 1, 49, 50, 51, 70, 300]))) for _ in range(pick.randrange(7))]
        expected = []
        for n, text in enumerate(texts):
            least = substrings.minimizers(np.frombuffer(text, np.uint8)).tolist() if len(text) >= 50 else []
            for i, value in enumerate(least):
                if i and least[i - 1] == value:
                    expected[-1][3] += 1
                else:
                    expected.append([value, n, sum(map(len, texts[:n])) + i, 1])
        found = substrings.segments(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64))
        assert [list(x) for x in zip(*(c.tolist() for c in found))] == expected


def test_substrings_equal_brute_force(docs_of, corpus):
    got = substrings.remove_repeats(docs_of(corpus)).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    expected = [(d, *rest) for (d, _), rest in zip(corpus, without_repeats(corpus))]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert substrings.remove_repeats(docs_of([])).count() == 0


def test_substrings_over_many_blocks(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(substrings, "RUN_BYTES", 500)
    got = substrings.remove_repeats(docs_of(corpus, 5)).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    expected = [(d, *rest) for (d, _), rest in zip(corpus, without_repeats(corpus))]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("hot", [1, 2, 20])
def test_frequent_pieces_are_spread(docs_of, corpus, monkeypatch, hot):
    """A template line in many documents, with varying surroundings, some of which repeat."""
    monkeypatch.setattr(substrings, "HOT_DOCUMENTS", hot)
    monkeypatch.setattr(substrings, "RUN_BYTES", 700)
    rows = corpus + [
        (700 + i, f"{i % 37}th note of {i}: all rights to this line are kept by nobody in {i % 11} places, {'z' * (i % 70)}")
        for i in range(80)
    ]
    rows += [(800 + i, "a" * (60 + i)) for i in range(3)] + [(810, "ab" * 50), (811, "ab" * 40)]
    got = substrings.remove_repeats(docs_of(rows, 4)).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    expected = [(d, *rest) for (d, _), rest in zip(rows, without_repeats(rows))]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_hot_segments_are_cut_alike():
    rng = np.random.default_rng(9)
    line = rng.integers(97, 123, 24).astype(np.uint8)
    raw = np.concatenate([np.concatenate([rng.integers(97, 123, 60).astype(np.uint8), line]) for _ in range(50)])
    raw = np.concatenate([raw, raw[300:900]])
    value, doc, start, count = substrings.segments(raw, np.array([4200, 600]))
    cut = substrings._cut_hot(raw, value, doc, start, count)
    assert cut[3].sum() == count.sum() and len(cut[0]) > len(value)
    keys = {}
    for key, first, n in zip(cut[0].tolist(), cut[2].tolist(), cut[3].tolist()):
        for at in range(first, first + n):
            keys.setdefault(raw[at:at + 50].tobytes(), set()).add(key)
    assert all(len(k) == 1 for k in keys.values()) and len(keys) > 3000


def test_a_copy_without_doc_id_does_not_hide_its_class(docs_of, prose):
    base, alone = prose(70, 3), prose(80, 3)
    rows = [(None, base), (5, base), (9, edited(base, 2, 1)), (None, alone), (12, edited(alone, 2, 2))]
    rows += [(13, edited(alone, 2, 3))]
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect() if r.doc_id}
    assert found == {5: 5, 9: 5, 12: 12, 13: 12}


# --- chaining --------------------------------------------------------------------------------


def test_chain_prefers_order_and_short_gaps():
    x = [0, 10, 20, 30, 500, 31]
    y = [5, 15, 25, 35, 900, 2]
    order = sorted(range(6), key=lambda i: (x[i], -y[i]))
    found = chaining.chain([x[i] for i in order], [y[i] for i in order], [1, 0, 0, 0, 0, 0])
    assert [[x[order[i]] for i in links] for links in found] == [[0, 10, 20, 30]]


def test_common_words_equals_the_table():
    pick = random.Random(2)
    for _ in range(200):
        a, b = ([bytes([pick.randrange(97, 101)]) for _ in range(pick.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        assert chaining.common_words(a, b) == table[-1][-1]


def test_passages_are_found_and_clean_text_stays(docs_of):
    pick = random.Random(4)

    def fresh(n):
        return " ".join(f"v{pick.randrange(10**6)}" for _ in range(n))

    shared = fresh(80)
    rows = [(i, fresh(200)) for i in range(10)]
    rows += [(20, fresh(90) + " " + shared), (21, shared.upper() + "\n" + fresh(70)), (22, fresh(80) + " " + edited(shared, 4, 9))]
    rows += [(23, None), (24, ""), (None, shared), (25, "few words"), (26, fresh(80) + " " + " ".join(shared.split()[:30]))]
    passages = chaining.repeated_passages(docs_of(rows)).collect()
    assert {p.doc for p in passages} == {21, 22} and {p.owner for p in passages} <= {20, 21}
    summary = {r.doc_id: r for r in chaining.summary(docs_of(rows)).collect()}
    assert len(summary) == len({d for d, _ in rows})
    assert summary[21].n_removed == 80 and summary[21].n_spans == 1 and summary[21].duplicate_of == [20]
    assert summary[22].duplicate_of[0] == 20 and summary[22].n_removed >= 60
    assert all(r.n_removed == 0 for d, r in summary.items() if d not in (21, 22))
    docs = docs_of(rows)
    cut = chaining.remove_passages(docs)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert len(left[21].split()) == 70 and left[23] is None and left[24] == ""
    assert all(left[d] == t for d, t in rows if d not in (21, 22))


def test_passages_of_odd_tables(docs_of, odd_rows):
    assert chaining.summary(docs_of(odd_rows)).count() == len(odd_rows)
    assert chaining.summary(docs_of([])).count() == 0
    assert chaining.remove_passages(docs_of([])).count() == 0


def test_exact_passages_are_covered(spark):
    """Words of exact runs of 50 words that an earlier document has, over a given table."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r.n_removed for r in chaining.summary(docs).collect()}
    seen, exact, caught = set(), 0, 0
    for row in sorted(docs.collect()):
        words = (row.text or "").encode().lower().split()
        windows = [tuple(words[k:k + 50]) for k in range(len(words) - 49)]
        covered = {k + i for k, w in enumerate(windows) if w in seen for i in range(50)}
        seen.update(windows)
        exact += len(covered)
        caught += min(len(covered), found[row.doc_id])
        assert covered == set() or found[row.doc_id] > 0
    assert exact and caught >= 0.99 * exact


def repeated_words(rows):
    """By doc_id the places of words in runs of 50 that an earlier document has."""
    seen, found = set(), {}
    for doc_id, text in sorted(rows):
        words = text.encode().lower().split()
        windows = [tuple(words[k:k + 50]) for k in range(len(words) - 49)]
        found[doc_id] = {k + i for k, w in enumerate(windows) if w in seen for i in range(50)}
        seen.update(windows)
    return found


def removed_words(docs):
    found = {}
    for p in chaining.repeated_passages(docs).collect():
        assert p.owner < p.doc and p.stop - p.start >= 50
        found.setdefault(p.doc, set()).update(range(p.start, p.stop))
    return found


def fresh_words(pick, n):
    return " ".join(f"v{pick.randrange(10**6)}" for _ in range(n))


def test_text_that_repeats_itself_is_found(docs_of):
    own = [fresh_words(random.Random(i), 80) for i in range(5)]  # ``prose`` has 7 of 8 words in common
    heti, refrain = " ".join(["Heti"] * 93), " ".join(["la", "lo", "li"] * 30)
    rows = [(1, own[1] + " " + heti), (2, heti + " " + own[2]), (3, own[3] + " " + refrain)]
    rows += [(4, refrain + " " + own[4] + " " + heti), (5, " ".join(["Heti"] * 49))]
    expected, found = repeated_words(rows), removed_words(docs_of(rows))
    assert {d: len(w) for d, w in expected.items()} == {1: 0, 2: 93, 3: 0, 4: 183, 5: 0}
    assert all(expected[d] <= found.get(d, set()) for d in expected) and set(found) == {2, 4}


@pytest.mark.parametrize("partitions", [1, 5])
def test_a_passage_whose_lines_earlier_documents_have_is_found(docs_of, partitions):
    pick = random.Random(5)

    def fresh(n):
        return " ".join(f"v{pick.randrange(10**6)}" for _ in range(n))

    rows = []
    for k in range(0, 120, 4):
        one, two = fresh(30), fresh(30)
        rows += [(k, fresh(20) + " " + one), (k + 1, two + " " + fresh(20))]
        rows += [(k + 2, fresh(20) + f" {one} {two} " + fresh(9)), (k + 3, f"{one} {two}")]
    expected, found = repeated_words(rows), removed_words(docs_of(rows, partitions))
    assert all(len(expected[k + 3]) == 60 for k in range(0, 120, 4))
    assert all(expected[d] <= found.get(d, set()) for d in expected)


def test_nth_occurrence_meets_the_nth_of_the_owner():
    key = np.array([7] * 7 + [8], np.int64)
    doc = np.array([1, 1, 1, 2, 2, 2, 2, 2], np.int64)
    place = np.array([4, 4, 9, 0, 0, 3, 6, 5], np.int64)  # a repeated row has its places twice
    owner, other = chaining._owned(key, doc, place)
    assert owner.tolist() == [1] * 7 + [2] and other.tolist() == [4, 4, 9, 4, 4, 9, 9, 5]


def test_cut_words():
    text = "  One two\nthree  four five "
    assert chaining.cut_words(text, [(1, 3)]) == "  One four five "
    assert chaining.cut_words(text, [(0, 1), (4, 9)]) == "  two\nthree  four "
    assert chaining.cut_words(text, []) == text


def found_share(rows, targets, docs_of):
    """Of the targets {doc_id: words planted}, the share of which at least 40 words are removed."""
    found = removed_words(docs_of(rows))
    assert set(found) <= set(targets)
    return sum(len(found.get(d, set()) & words) >= 40 for d, words in targets.items()) / len(targets)


@pytest.mark.parametrize("rate", [0.05, 0.1, 0.15, 0.2])
def test_recall_of_passages_with_replaced_words(docs_of, rate):
    pick, rows, targets = random.Random(11), [], {}
    for k in range(0, 300, 2):
        shared = fresh_words(pick, 70)
        copy = edited(shared, round(70 * rate), k)
        rows += [(k, f"{fresh_words(pick, 40)} {shared} {fresh_words(pick, 30)}")]
        rows += [(k + 1, f"{fresh_words(pick, 25)} {copy} {fresh_words(pick, 45)}")]
        targets[k + 1] = set(range(25, 95))
    assert found_share(rows, targets, docs_of) >= 0.9


def test_recall_where_earlier_documents_have_the_halves(docs_of):
    pick, rows, targets = random.Random(12), [], {}
    for k in range(0, 400, 4):
        shared = fresh_words(pick, 80).split()
        copy = list(shared)
        copy[::12] = [f"other{k}n{i}" for i in range(7)]
        rows += [(k + i, f"{fresh_words(pick, 20)} {' '.join(copy[40 * i:40 * i + 40])} {fresh_words(pick, 20)}") for i in (0, 1)]
        rows += [(k + 2, " ".join(shared)), (k + 3, f"{fresh_words(pick, 30)} {' '.join(copy)}")]
        targets[k + 3] = set(range(30, 110))
    assert found_share(rows, targets, docs_of) >= 0.9


def test_passages_equal_a_search_of_all_pairs(docs_of):
    """Edited passages, with words left out and put in, against an alignment of every pair."""
    pick, rows = random.Random(13), []
    for k in range(12):
        shared = fresh_words(pick, 90)
        for i in range(3):
            words = edited(shared, 4 * i, k).split()
            del words[30:30 + 2 * i]
            words[60:60] = ["put", "in"] * i
            rows.append((3 * k + i, f"{fresh_words(pick, 30)} {' '.join(words)} {fresh_words(pick, 30)}"))

    def repeats(a, b):
        """Words that a has too, in windows of b of which three quarters stand in a in order."""
        a, b = (x.encode().split() for x in (a, b))
        known, found = set(a), set()
        for at in range(0, len(b) - 49):
            same = {at + i for i, w in enumerate(b[at:at + 50]) if w in known}
            if len(same) >= 38 and chaining.common_words(a, b[at:at + 50]) >= 38:
                found |= same
        return found

    found = removed_words(docs_of(rows))
    for n, (doc_id, text) in enumerate(rows):
        expected = set().union(*(repeats(a, text) for _, a in rows[:n]))
        got = found.get(doc_id, set())
        assert bool(got) == bool(expected)
        assert len(got & expected) >= 0.95 * len(expected)
        assert not got or min(expected) - 3 <= min(got) and max(got) <= max(expected) + 3


def test_rows_of_one_doc_id_with_several_texts(docs_of):
    pick = random.Random(14)
    shared = fresh_words(pick, 80)
    rows = [(1, shared), (2, fresh_words(pick, 50) + " " + shared), (2, "two words"), (3, shared)]
    got = sorted(map(tuple, chaining.summary(docs_of(rows)).collect()), key=str)
    assert [r[:2] for r in got] == [(1, 80), (2, 130), (2, 2), (3, 80)]
    assert got[3][2] == 80 and got[0][2] == 0 and got[2][2] == 0 and got[1][2] in (0, 80)
    left = sorted((r.doc_id, r.text) for r in chaining.remove_passages(docs_of(rows)).collect())
    assert [d for d, _ in left] == [1, 2, 2, 3] and ("two words" in (t for _, t in left)) and left[3][1] == ""


def test_clashing_columns_survive(spark):
    from farestar.llm import exact
    from farestar.llm.common import keep_rows

    shared = fresh_words(random.Random(15), 60)
    names = "doc_id long, text string, spans int, doc string, `__id` int, id int, digest int, row int, `a b` int"
    rows = [(i, shared, 1, "d", 2, 3, 4, 5, 6) for i in (1, 2)]
    docs = spark.createDataFrame(rows, names)
    cut = chaining.remove_passages(docs)
    assert cut.columns == docs.columns and sorted(map(tuple, cut.collect())) == [rows[0], (2, "", *rows[1][2:])]
    kept = keep_rows(docs, exact.exact_groups(docs))
    assert kept.columns == docs.columns and list(map(tuple, kept.collect())) == rows[:1]


@pytest.mark.parametrize("partitions", [1, 5])
def test_recall_of_passages_whose_seeds_are_all_frequent(docs_of, partitions):
    """Ten earlier documents have the lines of a passage in another order, one has the passage."""
    pick, rows, targets = random.Random(21), [], {}

    def fresh(n):
        return [f"v{pick.randrange(10**6)}" for _ in range(n)]

    for k in range(0, 1000, 50):
        shared = fresh(72)
        for d in range(10):
            lines = [shared[i:i + 12] for i in range(6 * (d % 2), 72, 12)]
            rows.append((k + d, " ".join(w for line in lines[::-1] for w in fresh(30) + line)))
        copy = list(shared)
        copy[6::12] = fresh(6)
        rows += [(k + 20, " ".join(fresh(20) + shared + fresh(20))), (k + 21, " ".join(fresh(20) + copy + fresh(20)))]
        targets[k + 21] = set(range(20, 92))
    assert found_share(rows, targets, lambda given: docs_of(given, partitions)) >= 0.9


def test_twos_and_their_matches_equal_brute_force():
    pick = random.Random(22)
    low, high = chaining.APART
    sizes = np.array([40, 0, 60, 25])
    place = np.concatenate([np.sort(pick.sample(range(200), n)) for n in sizes if n]).astype(np.int64)
    key = np.array([pick.randrange(8) for _ in place], np.uint32)
    spans = [(0, 10, 70, True), (0, 60, 120, False), (2, 0, 90, True), (2, 80, 150, True), (2, 150, 170, False)]
    doc, start, both, other = chaining._twos(
        sizes, place, key, [np.array(c) for c in list(zip(*spans))[:3]], np.array([s[3] for s in spans])
    )
    expected, at = [], np.repeat(np.arange(4), sizes)
    for i in range(len(place)):
        for j in range(len(place)):
            if at[i] != at[j] or not low <= place[j] - place[i] <= high or not (key[i] | key[j]) & 1:
                continue
            mine, stop = [s for s in spans if s[0] == at[i]], place[j] + chaining.KMER
            if any(s[3] and s[1] <= place[i] and stop <= s[2] for s in mine):
                continue
            covered = {w for s in mine for w in range(s[1], s[2])}
            expected.append((at[i], place[i], place[j] - place[i], not set(range(place[i], stop)) <= covered))
    got = sorted(zip(doc.tolist(), start.tolist(), (other >> 1).tolist(), (other & 1 > 0).tolist()))
    assert got == sorted(expected) and {x[3] for x in got} == {True, False}
    key, doc, start, other = chaining._once(both, doc, start, other)
    found = {pair for rows in chaining._all_matches(key, doc, start, other) for pair in zip(*(c.tolist() for c in rows[:2]))}
    assert found == {
        (int(doc[i]), int(doc[j])) for i in range(len(key)) for j in range(len(key))
        if key[i] == key[j] and doc[j] < doc[i] and other[i] & 1
    }


def test_passages_leave_no_shuffles_and_no_intermediate_texts(spark, docs_of, prose, monkeypatch, tmp_path):
    """The files of a step go when it ends, not when the driver happens to collect garbage."""
    import re
    import time

    from farestar.llm import common

    def folder(_, purpose):
        return str(tmp_path / f"{purpose}-{time.time_ns()}")

    def shuffles():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {int(n) for n in re.findall(r"shuffle_(\d+)_", disk.getAllBlocks().mkString(" "))}

    monkeypatch.setattr(common, "scratch_folder", folder)
    monkeypatch.setattr(chaining, "scratch_folder", folder, raising=False)
    before = shuffles()
    docs = docs_of([(i, prose(i % 5) + " " + prose(90 + i)) for i in range(20)])
    assert chaining.repeated_passages(docs).localCheckpoint().count() > 0
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    names = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert "passage_first" in names and not names & {"passage_candidates", "passage_segments"}


def test_words_of_many_texts_have_the_hashes_of_single_ones():
    import pyarrow as pa

    from farestar.llm.shingles import Shingler, word_hashes

    texts = ["", " \n", "One two\tTWO", "one", "é É ab\x85c \x1c abcdefghi\x00\x0b\x0c  abc", "  x ", "one two two"]
    for first, last in ((0, 7), (2, 4), (0, 1), (0, 0)):
        values, sizes = word_hashes(pa.array(texts, pa.string())[first:last])
        expected = [Shingler().words(t).tolist() for t in texts[first:last]]
        assert sizes.tolist() == [len(x) for x in expected]
        assert values.tolist() == [x for row in expected for x in row]


def test_packets_follow_the_parts_and_not_the_blocks():
    """A task that meets many blocks sends one packet a part and kind, and all packets in a few batches."""
    from farestar.llm import rowpackets

    pick = np.random.default_rng(7)
    edge = np.iinfo(np.int64)
    blocks, hashed = [], {0: np.uint32, 2: np.int64}
    for _ in range(60):
        n = int(pick.integers(0, 40))
        doc = np.concatenate([pick.integers(edge.min, edge.max, n), [edge.min, edge.max, -1, 0]])
        for kind in range(3):
            n, big = len(doc), pick.integers(edge.min, edge.max, len(doc))
            key = (big % 2**32).astype(np.uint32) if kind == 0 else big
            blocks.append((kind, pick.integers(0, 8, n), doc, pick.integers(0, 2**31 - 1, n), key, pick.integers(0, 3, n)))
    batches = list(rowpackets.packed(iter(blocks), hashed))
    assert len(batches) <= 3 and sum(b.num_rows for b in batches) == 3 * 8
    rows = [(int(b["part"][i].as_py()), b["kind"][i].as_py(), n, i) for n, b in enumerate(batches) for i in range(b.num_rows)]
    got = {
        (part, kind, *row)
        for part, kinds in rowpackets.received((batches[n].slice(i, 1) for *_, n, i in sorted(rows)), hashed)
        for kind, columns in kinds.items() for row in zip(*(c.tolist() for c in columns))
    }
    assert got == {
        (int(row[0]), kind, *map(int, row[1:])) for kind, *columns in blocks for row in zip(*columns)
    }
    assert not list(rowpackets.packed(iter(()), hashed)) and not list(rowpackets.received(iter(()), hashed))


def lines_by_chance(pick, count):
    """Texts of random words of their own in which two short lines stand some way apart, and some real copies."""
    lines = [[f"line{n}x{i}" for i in range(size)] for n, size in ((0, 14), (1, 9))]
    common = ["the", "of", "and", "to", "in"]

    def fresh(n):
        return [pick.choice(common) if pick.random() < 0.3 else f"v{pick.randrange(10**6)}" for _ in range(n)]

    texts = []
    for n in range(count):
        if n % 10 == 9:
            copy = list(texts[pick.randrange(n)])
            for i in range(0, len(copy), pick.choice((6, 9, 14))):
                copy[i:i + 1] = fresh(pick.choice((0, 1, 1, 2)))
            texts.append(fresh(7) + copy + fresh(5))
        else:
            texts.append(fresh(pick.randrange(3, 30)) + lines[0] + fresh(pick.randrange(14, 34)) + lines[1] + fresh(30))
    return texts


def test_matches_without_hope_have_no_passage():
    import pyarrow as pa

    from farestar.llm.shingles import word_hashes

    texts = lines_by_chance(random.Random(31), 90)
    words = [t[:] and [w.encode() for w in t] for t in texts]
    hashes, sizes = word_hashes(pa.array([" ".join(t) for t in texts]))
    value, doc, place = chaining.seeds(hashes, sizes)
    counts = np.bincount(doc, minlength=len(texts))
    none = np.zeros(0, np.int64)
    doc, place, key, other = chaining._twos(
        counts, place, (value >> np.uint64(32)).astype(np.uint32) | np.uint32(1), [none] * 3, none > 0
    )
    key, doc, place, other = chaining._once(key, doc, place, other)
    codes = chaining._Codes()
    around = np.concatenate([chaining._around(words[d], place[i:i + 1], codes) for i, d in enumerate(doc)])
    found = [np.concatenate(c) for c in zip(*chaining._all_matches(key, doc, place, other, around))]
    mine, owner, x, y, fields = found
    kept = set(zip(*(c.tolist() for c in chaining._hopeful(mine, x, owner, fields)[:3:2])))
    near, far = fields >> 17 & 63, fields >> 11 & 63
    rows = [np.tile(mine, 2), np.tile(owner, 2), np.concatenate([x, x + near]), np.concatenate([y, y + far])]
    order = np.lexsort((rows[2], rows[2] - rows[3], rows[1], rows[0]))
    pairs = list(chaining._pairs(chaining.runs_of(*(c[order] for c in rows))))
    real = {
        (a, b) for a, b, *places in pairs for row in chaining.link(a, b, *places)
        if chaining.align(words[a], words[b], *row[6:])
    }
    assert real and real <= kept and len(pairs) > 20 * len(kept)


def test_lines_that_many_documents_have_by_chance_are_not_aligned(docs_of, monkeypatch):
    texts = lines_by_chance(random.Random(32), 60)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    chains, real = [], chaining.by_twos

    def spied(*given):
        made = real(*given).localCheckpoint()
        chains.append(made.count())
        return made

    monkeypatch.setattr(chaining, "by_twos", spied)
    assert {p.doc for p in chaining.repeated_passages(docs_of(rows)).collect()} <= set(range(9, 60, 10))
    assert chains[0] < 60


def test_matches_of_a_key_are_dealt_out_whole(monkeypatch):
    pick = np.random.default_rng(33)
    key, doc = np.repeat([5, 6, 7], 70), pick.integers(0, 30, 210)
    place, other = pick.integers(0, 400, 210), pick.integers(30, 61, 210) << 1 | (pick.random(210) < 0.5)

    def matched():
        found = []
        for d, k, p, o in chaining._live(doc, place, key, other):
            k, d, p, o = chaining._once(k, d, p, o)
            found += [tuple(row) for rows in chaining._all_matches(k, d, p, o) for row in zip(*(c.tolist() for c in rows))]
        return sorted(found)

    whole = matched()
    k, d, p, o = chaining._once(key, doc, place, other)
    assert whole == sorted(row for rows in chaining._all_matches(k, d, p, o) for row in zip(*(c.tolist() for c in rows)))
    monkeypatch.setattr(chaining, "KEY_MATCHES", 40)
    assert matched() == whole and len(list(chaining._live(doc, place, key, other))) > 5
