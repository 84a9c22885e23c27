import random

import pytest

from llm_helpers import blank_words, documents, prose
from tableflow.llm import repeats as R


def brute(texts, window):
    words = [blank_words(t) for t in texts]
    count = {}
    for w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            count[g] = count.get(g, 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(spark, texts, window, **settings):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in R.remove_repeats(documents(spark, texts), window, bits=1 << 15, **settings).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def corpus(rng, n=60):
    passages = [prose(rng, rng.randint(10, 60), 300) for _ in range(8)]
    texts = [None, "", "  \n", "w1", " ".join(["same"] * 80)]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else prose(rng, rng.randint(0, 50), 300))
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return texts + [texts[7], texts[7], passages[0] + " " + passages[0]]


@pytest.mark.parametrize("window,gram", [(12, 4), (35, 8), (5, 5)])
def test_brute_force(spark, window, gram):
    check(spark, corpus(random.Random(window)), window, gram=gram)


def test_hot_buckets(spark):
    check(spark, corpus(random.Random(8)), 12, gram=4, hot_from=1)
    check(spark, corpus(random.Random(8)), 12, gram=4, hot_from=4)


def test_periodic_texts(spark):
    texts = ["a b " * 60, "x " * 100, "x " * 40 + "y " * 40, "c d e " * 20 + "f", "a b " * 5]
    check(spark, texts, 12, gram=4)
    check(spark, texts, 12, gram=4, hot_from=2)
    check(spark, texts * 3, 12, gram=4, hot_from=2)


def test_few_distinct_words(spark):
    rng = random.Random(2)
    check(spark, [prose(rng, 60, 1) for _ in range(20)], 12, gram=4)


def test_long_text(spark):
    rng = random.Random(3)
    p = prose(rng, 80, 10**6)
    check(spark, [prose(rng, 120_000, 10**6) + " " + p, p + " " + prose(rng, 10, 10**6)], 35)


def test_repeated_rows_and_empty_tables(spark):
    t = prose(random.Random(1), 40, 10**6)
    d = documents(spark, [t, t, t + " tail", "x"], ids=[1, 1, None, 2])
    rows = sorted(((str(r.doc_id), r.n_removed, r.kept) for r in R.remove_repeats(d, bits=1 << 15).collect()))
    assert rows == [("1", 40, ""), ("1", 40, ""), ("2", 0, "x"), ("None", 40, "tail")]
    alone = documents(spark, [t], ids=[1])
    assert [r.n_removed for r in R.remove_repeats(alone, bits=1 << 15).collect()] == [0]
    assert R.remove_repeats(d.limit(0), bits=1 << 15).count() == 0


def test_sorting_counts_windows():
    assert R.repeated_windows([b"a b c d", b"b c d e", b"x y z"], 3) == [[1], [0], []]
    assert R.repeated_windows([b"a b c d", b"a b c d"], 3) == [[0, 1], [0, 1]]
    assert R.repeated_windows([b"a b a b a"], 3) == [[0, 2]] and R.repeated_windows([b"a b c d"], 3) == [[]]
    assert R._ranges([0, 1, 9, 3], 3) == [(0, 6), (9, 12)]
