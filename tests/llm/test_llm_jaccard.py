import random

import numpy as np

from llm_helpers import alnum_words, documents, prose
from tableflow.llm import jaccard as J


def shingles(text, k=5):
    w = alnum_words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(texts, threshold=0.8):
    s = [shingles(t) for t in texts]
    n = len(s)
    links, root = [0] * n, list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= threshold * len(s[i] | s[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return links, [top(i) for i in range(n)]


def near(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(w)


def corpus(rng, groups=6, size=12):
    texts = [None, "", "!!", "one", "one", "one two three", "One two, three.", "a b c d e", "a b c d e f"]
    passage = prose(rng, 60, 5000)
    for _ in range(groups):
        base = prose(rng, rng.randint(30, 200), 5000)
        texts += [base, base.upper()] + [near(rng, base, rng.randint(1, 6)) for _ in range(size)]
        texts.append(prose(rng, 40, 5000) + " " + passage + " " + prose(rng, 40, 5000))
    return texts


def check(spark, texts, **settings):
    rows = {r.doc_id: r for r in J.near_duplicates(documents(spark, texts), bits=1 << 15, **settings).collect()}
    links, roots = brute(texts)
    assert [rows[i].n_links for i in range(len(texts))] == links
    assert [rows[i].class_id for i in range(len(texts))] == roots
    return rows


def test_brute_force(spark):
    check(spark, corpus(random.Random(3)))


def test_large_leaves_are_compared_in_blocks(spark):
    rng = random.Random(4)
    base = prose(rng, 120, 5000)
    texts = [near(rng, base, rng.randint(1, 5)) for _ in range(60)] + [base] * 5 + corpus(rng, 2, 5)
    check(spark, texts, block=7)


def test_long_texts(spark):
    rng = random.Random(9)
    base = prose(rng, 30_000, 10**6)
    check(spark, [base, near(rng, base, 300), near(rng, base, 3000), base + " " + prose(rng, 2000, 10**6)])


def test_runs_reach_the_recall():
    alive = 1.0
    for _ in range(3):
        alive = 1 - np.exp(-alive)
    assert (1 - alive) ** J.runs_for(0.9999, 3) <= 1e-4 < (1 - alive) ** (J.runs_for(0.9999, 3) - 1)


def test_pairs_of_a_leaf():
    rng = np.random.default_rng(1)
    base = rng.choice(1 << 20, 50, replace=False)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(35, 50), replace=False), rng.integers(1 << 21, 1 << 22, 3)])).astype(np.uint64)
            for _ in range(30)]
    want = {(i, j) for j in range(30) for i in range(j)
            if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(*(x.tolist() for x in J.linked_pairs(sets, 0.8)))) == want and want
    block = np.arange(30) % 2
    assert set(zip(*(x.tolist() for x in J.linked_pairs(sets, 0.8, block)))) == {p for p in want if block[p[0]] != block[p[1]]}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = list(range(40))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 200), (5, 5)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {r.node[0]: r.root[0] for r in J.components(df).collect()}
    assert got == {**dict.fromkeys(range(1, 40), 0), **dict.fromkeys(range(101, 130), 100), 201: 200}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    t = " ".join(f"x{i}" for i in range(30))
    d = documents(spark, [t, t, t, t + " y", "", "", None], ids=[4, 4, None, 3, 8, 8, 9])
    rows = sorted((str(r.doc_id), r.class_id, r.n_links, r.class_size) for r in J.near_duplicates(d, bits=1 << 15).collect())
    assert rows == [("3", 3, 3, 4), ("4", 3, 3, 4), ("4", 3, 3, 4), ("8", 8, 0, 2), ("8", 8, 0, 2), ("9", 9, 0, 1), ("None", 3, 3, 4)]
    kept = J.keep_one(d, bits=1 << 15)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id != 9) == [(3, t + " y"), (8, "")]
    assert J.near_duplicates(d.limit(0), bits=1 << 15).count() == 0 and J.keep_one(d.limit(0), bits=1 << 15).count() == 0
