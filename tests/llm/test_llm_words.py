import random

import numpy as np
import pyarrow as pa

from llm_helpers import alnum_words, blank_words
from tableflow.llm import words as W

PARTS = ["a", "B", "é", "Ü", "7", " ", "\n", "\t", "-", "_", "中", " ", "\x1f", "", "zz top"]


def texts(n=400, seed=1):
    rng = random.Random(seed)
    return [None, "", " "] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def split(column, alphabet, lower):
    w = W.Words(column, alphabet, lower)
    return [[w.data[a:b].tobytes().decode() for a, b in zip(w.start[x:y], w.end[x:y])] for x, y in zip(w.row[:-1], w.row[1:])]


def test_words_equal_the_patterns():
    t = texts()
    assert split(pa.array(t, pa.string()), W.ALNUM_WORDS, True) == [alnum_words(x) for x in t]
    assert split(pa.array(t, pa.string()), W.BLANK_WORDS, False) == [blank_words(x) for x in t]


def test_slices_and_empty_columns():
    column = pa.array(texts(), pa.string())
    assert split(column.slice(7, 50), W.BLANK_WORDS, False) == split(column, W.BLANK_WORDS, False)[7:57]
    assert split(pa.array([], pa.string()), W.BLANK_WORDS, False) == []
    assert split(pa.array([None, ""], pa.string()), W.BLANK_WORDS, False) == [[], []]


def test_equal_words_and_only_they_have_equal_hashes():
    t = texts(2000, seed=3)
    w = W.Words(pa.array(t, pa.string()), W.BLANK_WORDS, False)
    names = [x for y in t for x in blank_words(y)]
    assert len(set(zip(names, w.hash.tolist()))) == len(set(names)) == len(set(w.hash.tolist()))


def test_windows():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 100, 50).astype(np.uint64)
    for w in (1, 2, 7, 16, 50):
        assert W.sliding(x, w, np.minimum).tolist() == [min(x[i:i + w]) for i in range(51 - w)]
    assert len(W.sliding(x, 51, np.minimum)) == 0
    row = np.array([0, 3, 3, 10])
    assert W.inside_rows(row, 3).tolist() == [i + 3 <= 3 or i >= 3 for i in range(8)]
    assert W.covered(np.array([2, 3, 8]), 2, 12).tolist() == [i in (2, 3, 4, 8, 9) for i in range(12)]


def test_passes_bound_texts_and_keep_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["x" * 10, "y" * 50, None, "", "z" * 5, "q" * 5])], ["i", "text"])
    got = list(W.passes(iter([batch]), "text", 12))
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(6))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= 12 for b in got)


def thue_morse(n, letters="ab"):
    word = letters[0]
    for _ in range(n):
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


def test_regular_words_have_their_own_hashes():
    words = [thue_morse(11), thue_morse(11, "ba"), "a" * 2048, "a" * 2047 + "b", *[thue_morse(k, x) for k in range(11) for x in ("ab", "ba", "ai")],
             *["a" * k for k in range(2, 40)], *["a\x00"[:1] + "\x00" * k for k in range(1, 20)]]
    words = sorted(set(words))
    w = W.Words(pa.array([" ".join(words)]), W.BLANK_WORDS, False)
    assert len(set(w.hash.tolist())) == len(words) == len(w.hash)


def test_distinct_goes_by_bytes(monkeypatch):
    words = ["x", "yy", "x", "zz", "", "yy"] + [thue_morse(5), thue_morse(5, "ba"), thue_morse(5)]
    words = [x for x in words if x]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(x) for x in words])
    start = end - [len(x) for x in words]
    for _ in range(2):
        first, kind = W.distinct(data, start, end)
        assert [words[first[k]] for k in kind] == words and len(first) == len(set(words))
        monkeypatch.setattr(W, "span_hash", lambda d, a, b: np.zeros(len(a), np.uint64))  # all hashes meet
