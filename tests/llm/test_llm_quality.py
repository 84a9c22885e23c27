import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_helpers import blank_words, documents, prose
from tableflow.llm import quality as Q


def brute(text):
    w = blank_words(text)
    lines = [x for x in (text or "").split("\n") if blank_words(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep)


def test_measures_equal_brute_force():
    rng = random.Random(2)
    parts = ["a", "b", "é", "#", "*", "\n", " ", "\t", "\r", "|", "\n\n", "a b c", "中"]
    t = [None, "", "\n", "a\na", "a\na\n", "\na"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    m = Q.measures(pa.array(t, pa.string()))
    assert list(zip(*(m[k].tolist() for k in Q.MEASURES))) == [brute(x) for x in t]


def labelled(spark, n=600):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(60, 200))]
        quality, toxic = 1, 0
        if i % 5 == 1:
            words, quality = [w + rng.choice(["###", "***"]) for w in words], 0
        elif i % 5 == 2:
            toxic = 1
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["vilename", "rudename", "badname"])
        texts.append(" ".join(words))
        labels.append((i, quality, toxic))
    return texts, labels


def test_model_on_texts_it_has_not_seen(spark):
    texts, labels = labelled(spark)
    docs = documents(spark, texts)
    model = Q.train(docs, spark.createDataFrame(labels[:400], "doc_id bigint, quality int, toxic int"))
    rows = {r.doc_id: r for r in Q.judge(docs, model).collect()}
    wrong = [i for i, q, t in labels[400:] if rows[i].kept != (q == 1 and t == 0)]
    assert len(wrong) <= 4  # of 200
    good = [rows[i].quality for i, q, _ in labels[400:] if q]
    assert np.mean(good) > 0.95  # calibrated towards the labels


def test_sample_bound_and_label_rules(spark):
    texts, labels = labelled(spark, 120)
    docs = documents(spark, texts + texts[:3], ids=[*range(120), 0, 1, 2])
    rows = [*labels, (0, None, 0), (None, 1, 1), (7, 0, 1), (7, 1, 0), (10**9, 1, 1)]
    full = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    a, b = Q.train(docs, full, sample=60), Q.train(docs.repartition(5), full.repartition(3), sample=60)
    for k in Q.HEADS:
        assert a.heads[k].slots.tolist() == b.heads[k].slots.tolist() and a.heads[k].bias == b.heads[k].bias


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = documents(spark, [None, "", "x " * 60, prose(random.Random(1), 80, 10**6), "long " * 3 + prose(random.Random(2), 100_000, 10**6)], ids=[1, 2, 3, 3, None])
    docs = docs.withColumnRenamed("kept", "kept").withColumnRenamed("n", "n_words")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = Q.train(docs, none)
    assert not model.heads
    rows = sorted((r.n_words, r.base_failed, r.kept) for r in Q.judge(docs, model).collect())
    assert rows == [(0, True, False), (0, True, False), (60, True, False), (80, False, True), (100_003, False, True)]
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 2
    assert Q.judge(docs.limit(0), model).count() == 0 and Q.keep_good(docs.limit(0), model).count() == 0
    one = spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert Q.judge(docs, Q.train(docs, one)).filter("kept").count() == 2  # one class only


def test_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * x - 1)))).astype(float)
    a, b = Q.calibrate(x, y)
    assert abs(a - 0.5) < 0.08 and abs(b + 1) < 0.15
    assert Q.calibrate(x, np.ones(4000)) == (1.0, 0.0)
