import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from farestar.llm import alignment, keycounts, tokens
from farestar.llm.queries import op13_alignment

BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """{position: result} of (doc_id, text) rows: whole texts by both libraries, ends by set intersection."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTE_JSON)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(BYTE_JSON, "rb") as file:
        spelled = tokens.token_bytes(file.read())

    def piece(i):
        shown = second.id_to_piece(i)
        return bytes([int(shown[3:5], 16)]) if second.is_byte(i) else shown.replace("▁", " ").encode()

    def laid(ids, spell):
        at, found = 0, []
        for i in ids:
            found.append((i, at, at := at + len(spell(i))))
        return found

    def one(text):
        raw = (" " + (text or "")).encode()
        a, b = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")
        if not text or any(b"".join(map(s, ids)) != raw for s, ids in ((spelled.__getitem__, a), (piece, b))):
            return None
        a, b = laid(a, spelled.__getitem__), laid(b, piece)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        place = {end: n for n, end in enumerate(cuts)}
        sides = []
        for side in (a, b):
            parts, open_at = [[] for _ in cuts], 0
            for i, _, hi in side:
                parts[open_at].append(i)
                open_at = place[hi] + 1 if hi in place else open_at
            sides.append(parts)
        links = Counter((x, y) for xs, ys in zip(*sides) for x in xs for y in ys)
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in zip(*sides))
        return len(a), len(b), len(cuts), links, hashlib.sha256(shown.encode()).hexdigest()

    def all_of(rows):
        found = [(doc_id, one(text)) for doc_id, text in rows]
        held = Counter(pair for _, f in found if f for pair in f[3])
        best = {}
        for (a, _), n in held.items():
            best[a] = max(n, best.get(a, 0))
        result = []
        for doc_id, f in found:
            if f is None:
                result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            a, b, g, links, digest = f
            most = sum(n for pair, n in links.items() if held[pair] == best[pair[0]])
            result.append((doc_id, a, b, g, links.total(), most, sum(held[p] * n for p, n in links.items()), digest))
        return result, held, best

    return all_of


ODD = [
    "<|endoftext|> a<|endoftext|>b", "<s> x </s> <0x41>", "a▁b and ▁", "naïve Ünïcode 漢字かな 漢 字", "\U0001F600\U0001F600 é",
    " lead", "trail ", "two  spaces   three\n\n\n a \t b", "\x00 \x1c \x85 \xa0 x", " ", "\n", "　 a", "x" * 300 + " " + "ab" * 200,
    "1234567 3.14159 $%&*|", "ﬁ ½ ǅ İı Σς", "don't we'll I'M", " " * 3000, "漢字" * 500,
]


@pytest.mark.parametrize("block", [alignment.BLOCK_CHARS, 3000])
def test_alignment_equals_brute_force(docs_of, odd_rows, prose, plain, monkeypatch, block):
    pick = random.Random(6)
    letters = "ab éß漢\n\t.,'1 ▁<|>  "
    rows = odd_rows + [(100 + i, text) for i, text in enumerate(ODD)] + [(300 + i, prose(i % 9)) for i in range(20)]
    rows += [(400 + i, "".join(pick.choice(letters) for _ in range(pick.randrange(60)))) for i in range(150)]
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    monkeypatch.setattr(alignment, "PACKET_DOCS", 16)
    monkeypatch.setattr(keycounts, "GATHERED", 50)
    expected, held, best = plain(rows)
    assert sum(r[1] > 0 for r in expected) > 80 and any(t and not r[1] for (_, t), r in zip(rows, expected))
    got = alignment.align(docs_of(rows), BYTE_JSON, PIECES, buckets=5).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    pairs = alignment.id_pairs(docs_of(rows), BYTE_JSON, PIECES, buckets=3).collect()
    assert {(r.a, r.b): (r.n_docs, r.best) for r in pairs} == {p: (n, best[p[0]] == n) for p, n in held.items()}


def test_alignment_of_given_documents(spark, sf_dir, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op13_alignment(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows)[0])


def test_alignment_of_an_empty_table(docs_of):
    assert alignment.align(docs_of([]), BYTE_JSON, PIECES).count() == 0
    found = alignment.align(docs_of([(1, None), (2, "")]), BYTE_JSON, PIECES).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_are_cut_at_every_common_end():
    pick = random.Random(7)
    for _ in range(300):
        last = pick.randrange(1, 60)
        a, b = (sorted({*pick.sample(range(1, last + 1), pick.randrange(last + 1)), last}) for _ in range(2))
        found = alignment.groups(a, b)
        assert [a[hi - 1] for _, hi, *_ in found] == sorted(set(a) & set(b)) == [b[high - 1] for *_, high in found]
        assert [x[0] for x in found] == [0, *(x[1] for x in found[:-1])] and found[-1][1] == len(a)
        assert [x[2] for x in found] == [0, *(x[3] for x in found[:-1])] and found[-1][3] == len(b)
    assert alignment.groups([], []) == []
