import dataclasses
import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_helpers import LOWER, blank_words, documents, prose
from tableflow.llm import language_model as L


def tokens(text):
    return [*blank_words((text or "").translate(LOWER)), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def brute(docs):
    c = Counter(w for i, t in docs if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t in docs]


def check(spark, docs):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in
                 L.score_texts(documents(spark, [t for _, t in docs], [i for i, _ in docs])).collect())
    want = sorted((str(i), *b) for (i, _), b in zip(docs, brute(docs)))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-9)


def test_base_scores(spark, monkeypatch):
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.randint(0, 80), 300).title() + "\n É") for i in range(150)] + [(150, None), (151, ""), (3, "W1 w1"), (None, "w1 zzz")]
    check(spark, docs)
    monkeypatch.setattr(L, "LOCAL_WORDS", 40)  # most words meet their counts in the join
    check(spark, docs)


def test_nothing_to_train_on_and_empty_tables(spark):
    i = next(i for i in range(100) if held(i))
    check(spark, [(i, "a b")])
    assert L.score_texts(documents(spark, ["x"]).limit(0)).count() == 0


def test_long_text(spark):
    check(spark, [(1, prose(random.Random(1), 200_000, 50_000)), (2, "w1")])


def _language(rng, n, words):
    """Words that mostly follow their number: context tells much."""
    at, out = rng.randrange(words), []
    for _ in range(n):
        at = (at + 1) % words if rng.random() < 0.8 else rng.randrange(words)
        out.append(f"v{at}")
    return " ".join(out)


def test_model_beats_unigrams_on_held_out_texts(spark):
    rng = random.Random(5)
    docs = documents(spark, [_language(rng, 300, 60) for _ in range(300)])
    r = L.score_texts(docs).filter("held_out").selectExpr("sum(score) / sum(n_tokens) AS m", "sum(base_score) / sum(n_tokens) AS b").first()
    assert r.m > r.b + 0.25


def test_probabilities_sum_to_one(spark):
    """Over all known words, and one unknown word for each class of endings."""
    rng = random.Random(6)
    d = documents(spark, [_language(rng, 200, 700) for _ in range(60)])
    training = d.selectExpr("CAST(doc_id AS STRING) AS share", "text")
    lexicon, counts = L.lexicon_of(training)
    weights = L.train(training, lexicon)
    known = sorted({w for r in d.collect() for w in r.text.split()})
    column = pa.array([f"v5 v6 {w}" for w in known] + ["v5 v6"])
    x = L.Batch(column, lexicon)
    p = L.log10_probabilities(x, weights, lexicon) + np.where(x.learned, 0, np.log10(np.maximum(x.count, 0) + L.SMOOTH))
    third = x.row[:-1] + 2  # the third token of each text: a known word, or the end
    total = (10 ** p[third]).sum()
    # an unknown word of each class has SMOOTH of the class's mass
    classes = 10 ** (L._log_softmax(weights.classes, [s[third[:1]] for s in x.slots])[0] / np.log(10))
    unknown = classes[L.LEARNED:] * L.SMOOTH / (lexicon.class_tokens + L.SMOOTH * (lexicon.class_distinct + 1))
    # learned classes may have places that no word took: their mass is not spent on words
    assert abs(total + unknown.sum() - 1) < 1e-3


def test_words_beyond_the_frequent_ones_are_predicted(spark):
    """12,000 words of alike counts, on held-out texts: context tells which word, not only which class of endings."""
    rng = random.Random(7)
    docs = documents(spark, [_language(rng, 1500, 12_000) for _ in range(400)])
    r = L.score_texts(docs).filter("held_out").selectExpr("sum(score) / sum(n_tokens) AS m", "sum(base_score) / sum(n_tokens) AS b", "sum(n_tokens) AS n").first()
    assert r.n > 10 * 4096
    # classes alone, with frequencies inside those of endings, gain about 0.6
    assert r.m > r.b + 0.8


def test_the_model_grows_with_the_distinct_words(spark):
    sizes = []
    for n in (1_000, 40_000, 160_000):
        d = documents(spark, [" ".join(f"v{i}" for i in range(n))], clash=False)
        lexicon, _ = L.lexicon_of(d.selectExpr("CAST(doc_id AS STRING) AS share", "text"))
        assert lexicon.distinct == n + 1 and len(lexicon.trees.hash) == n + 1 - L.LEARNED * L.MEMBERS
        sizes.append(len(L.starting_weights(lexicon).branches))
    assert sizes[0] < sizes[1] < sizes[2] and sizes[2] >= L.WORD_BRANCHES * 160_000
    for n in (10**7, 10**8):
        more = dataclasses.replace(lexicon, distinct=n)
        assert more.rows * L.ROW_WORDS >= n and 1 << more.branch_bits >= L.WORD_BRANCHES * n


def _on_disk(spark):
    """Bytes of shuffles and of broadcasts that the session holds on disk."""
    sc = spark.sparkContext
    files = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffled = [files.apply(i) for i in range(files.size())]
    return (sum(f.length() for f in shuffled if f.getName().startswith("shuffle_")),
            sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(sc._temp_dir) for f in names))


def test_a_model_leaves_nothing_on_disk(spark):
    """The learners' models of a round go when they are averaged, and the model when the scores are written."""
    rng = random.Random(8)
    docs = documents(spark, [_language(rng, 500, 3_000) for _ in range(40)])
    shuffled, sent = _on_disk(spark)
    L.score_texts(docs)
    model = len(L.starting_weights(L.lexicon_of(docs.selectExpr("CAST(doc_id AS STRING) AS share", "text"))[0]).branches) * 4
    for _ in range(100):  # shuffle files are removed in the background
        now = _on_disk(spark)
        if now[0] < shuffled + model:
            break
        time.sleep(0.1)
    assert now[0] < shuffled + model  # before: as many models as learners, for each round
    assert now[1] < sent + model


def test_steps_are_those_of_the_plain_formulas():
    """Rows, members and branches that occur again within a step, against loops."""
    rng = np.random.default_rng(9)
    for n, rows in ((1, 3), (700, 40), (2000, 5000)):
        table, squares = rng.normal(size=(rows, 16)).astype(np.float32), np.full((rows, 16), 1e-3, np.float32)
        seen, target = np.zeros(rows, np.float32), rng.integers(0, 16, n)
        slots = [np.full(n, rows - 1), *rng.integers(0, rows, (4, n))]
        e = np.exp(sum(table[s] for s in slots).astype(np.float64))
        e /= e.sum(axis=1)[:, None]
        e[np.arange(n), target] -= 1
        g, met = np.zeros((rows, 16)), np.zeros(rows)
        for s in slots:
            np.add.at(g, s, e)
            np.add.at(met, s, 1)
        g /= np.sqrt(np.maximum(met, 1))[:, None]
        want = table - 0.1 * g / np.sqrt(1e-3 + g * g)
        L._update(table, squares, seen, slots, target, np.float32(0.1))
        assert np.allclose(table, want, atol=1e-4) and np.allclose(squares, 1e-3 + g * g, rtol=1e-3, atol=1e-5) and (seen == met).all()

        weights, prior, right = rng.normal(size=rows).astype(np.float32), rng.normal(size=n).astype(np.float32), rng.random(n) < 0.5
        packed, sums, slots = weights + 1j * np.ones(rows, np.float32), np.zeros(rows, np.float32), rng.integers(0, rows, (4, n))
        error = 1 / (1 + np.exp(-(prior + weights[slots].sum(axis=0)).astype(np.float64))) - right
        g = np.bincount(slots.ravel(), np.tile(error, 4), rows)
        packed = packed.astype(np.complex64)
        L._update_branches(packed, sums, prior, slots, right, np.float32(0.5))
        assert np.allclose(packed.real, weights - 0.5 * g / np.sqrt(1 + g * g), atol=1e-4) and not sums.any()
        assert np.allclose(packed.imag, 1 + g * g, rtol=1e-3, atol=1e-4)
