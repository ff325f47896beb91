import random

import public_tokenizers
import pyarrow as pa
import pytest

from farestar.llm import tokens

ODD = "abc dzéÉßñÀΣσςİıǅ́0٣1'’sTtLl.,!#\x00\x1c\x85\xa0漢字\U0001F600ﬁŸ \n\t"


#: Strings that the files turn into one token, alone, within words and beside white space.
SPECIAL = [
    text for token in ("<|endoftext|>", "<|startoftext|>")
    for text in (token, f"{token} x", f"a {token}{token}b c", f"x  {token} \n {token}", f"é{token}é", token.upper())
]


def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def samples(spark, sf_dir):
    pick = random.Random(5)
    odd = ["".join(pick.choice(ODD) for _ in range(pick.randrange(40))) for _ in range(3000)]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(100).collect()
    return odd + ["", " ", "a", "  a  b ", *SPECIAL] + [r.text for r in rows]


@pytest.mark.parametrize("file, splitter, vocabulary, coder", [
    ("byte_bpe_50k.json", tokens.space_words, tokens.byte_vocabulary, tokens.byte_coder),
    ("word_bpe_49k.json", tokens.bare_words, tokens.word_vocabulary, tokens.word_coder),
])
@pytest.mark.parametrize("by_rank", [True, False])
def test_ids_of_words_are_ids_of_texts(spark, samples, file, splitter, vocabulary, coder, by_rank):
    path = public_tokenizers.path(file)
    expected = library(path)
    shared = vocabulary(spark, path).value
    assert shared[1] is not None
    sizes, numbers, words = splitter()(pa.array(samples))
    ids = coder(shared if by_rank else (shared[0], None, ()))(words.to_pylist())
    at = 0
    for text, size in zip(samples, sizes):
        assert [i for n in numbers[at:at + size] for i in ids[n]] == expected(text)
        at += size


def test_numbers_survive_packing():
    import numpy as np

    from farestar.llm.wordshuffle import pack_numbers, unpack_numbers

    for values in ([], [0], [0, 127, 128, 1 << 14, (1 << 14) - 1, 1 << 21, 1 << 28, (1 << 32) - 1, 5]):
        assert unpack_numbers(pack_numbers(np.array(values, np.uint32))).tolist() == values


@pytest.mark.parametrize("file, vocabulary, coder, separator", [
    ("byte_bpe_50k.json", tokens.byte_vocabulary, tokens.byte_coder, " "),
    ("word_bpe_49k.json", tokens.word_vocabulary, tokens.word_coder, ""),
])
def test_words_are_encoded_many_at_a_time(spark, monkeypatch, file, vocabulary, coder, separator):
    """Few calls for many words, and words that white space or marks would join are still right."""
    import tiktoken

    calls = []
    for name in ("encode_ordinary", "encode_to_numpy"):
        def counted(self, *values, _real=getattr(tiktoken.Encoding, name), **named):
            calls.append(1)
            return _real(self, *values, **named)

        monkeypatch.setattr(tiktoken.Encoding, name, counted)
    path = public_tokenizers.path(file)
    encode, expected = coder(vocabulary(spark, path).value), library(path)
    words = [f"{separator}word{i}'s,Zürich{i}x" for i in range(500)]
    assert encode([w.encode() for w in words]) == [expected(w) for w in words]
    assert len(calls) < 10
    odd = ["", "a", "a\x0b", "\x0bb", "c\x0b\x0bd", "'s", "x\n", "\x85", "y\xa0", "\x1cz", "<|endoftext|>", "ß", "ΑΣ", "ok"]
    odd += [" " + w for w in odd] if separator else []
    for mixed in (odd, odd[::-1], odd[1:2], [odd[1], odd[-1]], []):
        assert encode([w.encode() for w in mixed]) == [expected(w) for w in mixed]
