"""Words and ids of public tokenizer files (JSON), for the word shuffle."""

from __future__ import annotations

import json
import os
import re
import string
from itertools import compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

from farestar.llm.wordshuffle import by_text

#: The patterns that split texts for the two kinds of files.
BYTE_PATTERN = public_tokenizers.PATTERN
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_LOWER = frozenset(string.ascii_lowercase)

_BLANK = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: A space next to other white space, or at an end; such texts are cut more carefully.
_RUN = rf"{_BLANK} | {_BLANK}|^ | $"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's bytes (a few MB, whatever the data), for executors without it."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _tokenizer(content: bytes, plain: bool = False):
    """Distinct words -> ids by the tokenizers library, which adds no tokens of its own.

    A string in a text that spells an added token of the file gets that token's id, as the
    library has it; with ``plain`` it is ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(content)
    tokenizer.encode_special_tokens = plain

    def encode(words: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    return encode


def _added(file: dict) -> tuple[str, ...]:
    """The strings that the file turns into one token wherever a text holds them.

    Words are encoded one by one, so such a string must lie in one word and take no white space
    from its neighbours.
    """
    tokens = [t for t in file.get("added_tokens") or () if t["content"]]
    for t in tokens:
        if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or t["content"].split() != [t["content"]]:
            raise ValueError(f"added token {t['content']!r} does not stay within a word")
    return tuple(t["content"] for t in tokens)


def _holds(added: tuple[str, ...]):
    """Whether a word holds one of the strings."""
    return re.compile("|".join(map(re.escape, added)) or r"(?!)").search


def _ranked(vocabulary: dict[str, int], merges: list, first: int) -> bool:
    """Whether ids follow the order of the merges, so that an id is the rank of its merge."""
    pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
    return all(vocabulary.get("".join(pair)) == first + i for i, pair in enumerate(pairs))


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(content: bytes) -> list[bytes]:
    """The bytes of every token of a byte-level BPE file, by id; added tokens by their string."""
    file, symbol = json.loads(content), _bytes_of_symbols()
    added = {t["id"]: t["content"].encode() for t in file.get("added_tokens") or ()}
    spelled = {i: bytes(map(symbol.__getitem__, t)) for t, i in file["model"]["vocab"].items() if i not in added}
    spelled |= added
    return [spelled.get(i, b"") for i in range(max(spelled) + 1)]


#: Stands between words that are encoded at once: white space that is a pre-token by itself there.
_MARK, _SEPARATOR = "\x0b", b"\x0b"
#: A word that a mark on either side leaves as it is: at most one space before it, none after it.
_BOUND = re.compile(r" ?\S(?:[^\x0b]*\S)?").fullmatch
#: Whether joined words hold one that is not bound.
_LOOSE = re.compile(r"(?:\A|\x0b)(?! ?\S)|[^\S\x0b](?:\x0b|\Z)").search


def _split_ids(merges, joined: str) -> list[list[int]]:
    """The ids of each of the words that marks join, encoded at once."""
    found = merges.encode_to_numpy(joined, disallowed_special=())
    ends = np.append(np.flatnonzero(found == merges.encode_single_token(_SEPARATOR)), len(found)).tolist()
    ids = found.tolist()
    return [ids[a:b] for a, b in zip([0, *(e + 1 for e in ends)], ends)]


def byte_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """For ``byte_coder``: the file, and the rank of every token where ids follow the merges."""
    with open(path, "rb") as handle:
        content = handle.read()
    file = json.loads(content)
    model = file["model"]
    plain = file["normalizer"] is None and file["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
    }
    ranks = None
    if plain and _ranked(model["vocab"], model["merges"], 256):
        symbol = _bytes_of_symbols()
        ranks = {
            bytes(map(symbol.__getitem__, token)): i for token, i in model["vocab"].items()
            if set(token) <= set(symbol)
        }
    return spark.sparkContext.broadcast((content, ranks, _added(file)))


def byte_coder(vocabulary: tuple[bytes, dict | None, tuple], plain: bool = False):
    """Ids of words by a byte-level BPE file; with ``plain`` no string in a word spells a token.

    Where ids follow the order of the merges, the merges are done by rank, several times faster
    than by the tokenizers library and with the same ids; other files go through the library.
    """
    import tiktoken

    content, ranks, added = vocabulary
    encode, special = _tokenizer(content, plain), _holds(() if plain else added)
    if ranks is None:
        return lambda words: encode([word.decode() for word in words])
    merges = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def one(text: str) -> list[int]:
        return encode([text])[0] if special(text) else merges.encode_ordinary(text)

    def ids(words: list[bytes]) -> list[list[int]]:
        joined = _SEPARATOR.join(words).decode()
        if joined.count(_MARK) == len(words) - 1 and not special(joined) and not _LOOSE(joined):
            return _split_ids(merges, joined)
        texts = [word.decode() for word in words]
        bound = [bool(_BOUND(text)) and not special(text) for text in texts]
        found = iter(_split_ids(merges, _MARK.join(compress(texts, bound))) if any(bound) else ())
        return [next(found) if at_once else one(text) for text, at_once in zip(texts, bound)]

    return ids


def word_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """For ``word_coder``: the file, and the rank of every token where ids follow the merges.

    A token's last letter is written in upper case if a word ends there; lower-case text leaves
    upper case free.
    """
    with open(path, "rb") as handle:
        content = handle.read()
    file = json.loads(content)
    model = file["model"]
    ranks = None
    if model.get("end_of_word_suffix") == "</w>" and _ranked(model["vocab"], model["merges"], 512):
        symbol, ranks = _bytes_of_symbols(), {}
        for token, i in model["vocab"].items():
            bare = token.removesuffix("</w>")
            raw = bytes(map(symbol.__getitem__, bare)) if set(bare) <= set(symbol) else b""
            if not raw or raw != raw.lower():
                continue
            if bare == token:
                ranks[raw] = i
            elif raw[-1:].isalpha():
                ranks[raw[:-1] + raw[-1:].upper()] = i
        # Bytes that no lower-case word holds still need a rank.
        ranks |= {bytes([b]): len(model["vocab"]) + b for b in range(256) if bytes([b]) not in ranks}
    return spark.sparkContext.broadcast((content, ranks, _added(file)))


def word_coder(vocabulary: tuple[bytes, dict | None, tuple]):
    """Ids of words by a BPE file with word ends (``</w>``), lower case.

    Where ids follow the order of the merges, runs of letters that end in a-z are merged by rank;
    all other pieces go through the tokenizers library, once each.  Words that hold an added token
    go there whole.
    """
    import regex
    import tiktoken

    content, ranks, added = vocabulary
    encode, special = _tokenizer(content), _holds(added)
    if ranks is None:
        return lambda words: encode([word.decode() for word in words])
    # Neither words nor pieces hold the mark, so a stretch without it is merged as a whole.
    merges = tiktoken.Encoding("ranks", pat_str=r"[^\x0b]+|\x0b", mergeable_ranks=ranks, special_tokens={})
    split = regex.compile(WORD_PATTERN + r"|\x0b").findall
    # Letters of these blocks have no combining marks and one-character lower case.
    simple = regex.compile(r"[\x00-\x7f\u00a1-\u012f\u0131-\u017f]*").fullmatch
    known: dict[str, list[int]] = {_MARK: []}

    def piece(text: str) -> list[int]:
        if text not in known:
            if len(known) > 100_000:
                known.clear()
                known[_MARK] = []
            known[text] = encode([text])[0]
        return known[text]

    def pieces(texts: list[str]) -> list[list[int]]:
        """The ids of simple words: of their pieces, those that end in a-z are merged at once."""
        parts = split(_MARK.join(texts).lower() + _MARK)
        ranked = [part[:-1] + part[-1].upper() for part in parts if part[-1] in _LOWER]
        merged = iter(_split_ids(merges, _MARK.join(ranked)) if ranked else ())
        found, word = [], []
        for part in parts:
            if part[-1] in _LOWER:
                word = word + next(merged) if word else next(merged)
            elif part == _MARK:
                found.append(word)
                word = []
            else:
                word = word + piece(part)
        return found

    def ids(words: list[bytes]) -> list[list[int]]:
        joined = _SEPARATOR.join(words).decode()
        if joined.count(_MARK) == len(words) - 1 and simple(joined) and not special(joined):
            return pieces(joined.split(_MARK))
        texts = [word.decode() for word in words]
        hard = [text for text in texts if not simple(text) or special(text) or _MARK in text]
        others = dict(zip(hard, encode(hard) if hard else ()))
        easy = iter(pieces([text for text in texts if text not in others]) if len(others) < len(set(texts)) else ())
        return [others[text] if text in others else next(easy) for text in texts]

    return ids


def space_words():
    """Splits texts before each space that stands alone between other characters.

    Byte-level pre-tokens may begin with one space and never hold one after another character,
    so no pre-token spans such a cut.
    """

    def cut(text: str) -> list[str]:
        parts = _LONE_SPACE.split(text)
        return parts[:1] + [" " + part for part in parts[1:]]

    slowly = by_text(cut)

    def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
        if pc.any(pc.match_substring_regex(texts, _RUN)).as_py():
            return _mixed(texts, pc.match_substring_regex(texts, _RUN), split, slowly)
        parts = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
        words = coded.dictionary.cast(pa.binary())
        # The first word of a text has no space before it: a word of its own.
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        which, numbers[first] = np.unique(numbers[first], return_inverse=True)
        numbers[first] += len(words)
        spaced = pc.binary_join_element_wise(pa.scalar(b" "), words, pa.scalar(b""))
        return sizes, numbers, pa.concat_arrays([spaced, words.take(pa.array(which))])

    return split


def space_units():
    """Splits texts like ``space_words``, into what stands between the cuts.

    A text is its units joined by single spaces.
    """
    slowly = by_text(_LONE_SPACE.split)

    def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
        slow = pc.match_substring_regex(texts, _RUN)
        if pc.any(slow).as_py():
            return _mixed(texts, slow, split, slowly)
        parts = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
        return sizes, numbers, coded.dictionary.cast(pa.binary())

    return split


def _mixed(texts: pa.Array, slow: pa.BooleanArray, split, slowly):
    """Rows marked ``slow`` by one splitter, the others by the other, in the order of the rows."""
    slow = slow.to_numpy(zero_copy_only=False).astype(bool)
    size = np.zeros(len(texts), np.int64)
    parts, words, base = {}, [], 0
    for marked, way in ((False, split), (True, slowly)):
        rows = np.flatnonzero(slow == marked)
        if len(rows):
            sizes, numbers, known = way(texts.take(pa.array(rows)))
            size[rows] = sizes
            parts[marked] = numbers + np.uint32(base)
            words.append(known)
            base += len(known)
    stream = np.empty(int(size.sum()), np.uint32)
    where = np.repeat(slow, size)
    for marked, numbers in parts.items():
        stream[where == marked] = numbers
    return size, stream, pa.concat_arrays(words)


def bare_words():
    """Splits texts into runs without ASCII white space, for tokenizers that only see words."""

    def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
        parts = pc.ascii_split_whitespace(texts)
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
        return sizes, numbers, coded.dictionary.cast(pa.binary())

    return split
