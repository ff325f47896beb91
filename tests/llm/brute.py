"""Plain versions of the operators, for small inputs."""

import hashlib

import numpy as np


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text):
    words = words_of(text)
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_components(rows):
    """component_id by doc_id, over distinct doc_ids."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(shingles(text))
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(d, s) for d, many in sets.items() for s in many if s]
    for i, (a, x) in enumerate(flat):
        for b, y in flat[:i]:
            common = len(x & y)
            if 100 * common >= 75 * (len(x) + len(y) - common):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d in sets}


def without_repeats(rows, length=50):
    """(n_bytes, n_removed, n_spans, kept_sha256) by position of the row."""
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for doc_id, raw in texts:
        for k in range(len(raw) - length + 1):
            if doc_id is not None:
                piece = raw[k:k + length]
                first[piece] = min(first.get(piece, doc_id), doc_id)
    found = []
    for doc_id, raw in texts:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if doc_id is not None and first[raw[k:k + length]] < doc_id:
                gone[k:k + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        found.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def base_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, window by window."""
    import re

    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    lines = [line for line in text.split("\n") if word.search(line)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)
