"""Operators against brute-force Python on random small fixtures (nulls, hot keys, copies)."""

import random
from collections import Counter

from tableflow.operators import ingest as ING
from tableflow.operators import quarantine as Q


def _rows(seed, n, keys=4):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([None] + list(range(keys)))
    # a third of the rows share one key
    return [((1, None) if i % 3 == 0 else (pick(), pick())) + (rnd.choice("abc"), i) for i in range(n)]


def test_insert_ignore_matches_bruteforce(spark):
    for seed in range(3):
        inc_rows = _rows(seed, 300)
        tgt_rows = [(k1, k2, "t") for k1, k2, _, _ in _rows(seed + 100, 20)]
        tgt_rows = list({(a, b): (a, b, v) for a, b, v in tgt_rows}.values())   # a target is unique on its key
        want, seen = [], {(a, b) for a, b, _ in tgt_rows}
        for k1, k2, v, o in sorted(inc_rows, key=lambda r: r[3]):
            if (k1, k2) not in seen:
                seen.add((k1, k2))
                want.append((k1, k2, v, o))
        inc = spark.createDataFrame(inc_rows, "k1 int, k2 int, v string, o int").repartition(5)
        tgt = spark.createDataFrame(tgt_rows, "k1 int, k2 int, v string")
        got = [tuple(r) for r in ING.insert_ignore(tgt, inc, ["k1", "k2"], ["o"]).collect()]
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(got, key=key) == sorted(want, key=key)


def test_split_duplicates_matches_bruteforce(spark):
    for seed in range(3):
        rows = [(k1, k2, v) for k1, k2, v, _ in _rows(seed, 400, keys=3)]
        counts = Counter(rows)
        df = spark.createDataFrame(rows, "k1 int, k2 int, v string").repartition(6)
        firsts, copies = Q.split_duplicates(df, chunk=2)
        assert Counter(tuple(r) for r in firsts.collect()) == Counter(set(rows))
        assert Counter(tuple(r) for r in copies.collect()) == Counter({r: c - 1 for r, c in counts.items() if c > 1})
