import random

from llm_helpers import alnum_words, documents, prose
from tableflow.llm.decontaminate import contaminated, decontaminate, drop_contaminated


def brute(texts, items, window=10):
    windows = set()
    for item, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        if n:
            windows |= {(n, tuple(w[i:i + n]), item) for i in range(len(w) - n + 1)}
    sizes = {n for n, _, _ in windows}
    by = {}
    for n, g, item in windows:
        by.setdefault((n, g), set()).add(item)
    out = []
    for t in texts:
        w, hit, found = alnum_words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                for item in by.get((n, tuple(w[i:i + n])), ()):
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def check(spark, texts, items):
    d = documents(spark, texts)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = {r.doc_id: r for r in decontaminate(d, b, bits=1 << 15).collect()}
    got = [(rows[i].n_words, rows[i].n_hit, list(rows[i]["items"])) for i in range(len(texts))]
    assert got == brute(texts, items)
    for i, r in rows.items():
        assert sum(s.end - s.start for s in r.spans) >= r.n_hit


def test_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice([1, 3, 9, 10, 11, 25, 60]), 400)) for i in range(12)]
    items += [(20, items[5][1]), (5, items[5][1]), (21, None), (22, ""), (23, "!!")]
    texts = [None, "", "..."]
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 40), 400)]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 5))
            parts += [" ".join(w[a:a + rng.randint(5, 30)]).upper().replace(" ", ", "), prose(rng, rng.randint(0, 12), 400)]
        texts.append(" ".join(parts))
    check(spark, texts, items)


def test_ties_within_windows(spark):
    """Repeated k-grams: every window has several minima."""
    items = [(1, "a " * 30), (2, "a b " * 10), (3, "b a")]
    check(spark, ["a " * 9, "a " * 10, "c " + "a b " * 6, "b a b a", "a " * 200], items)


def test_long_text(spark):
    rng = random.Random(1)
    item = prose(rng, 30, 10_000)
    check(spark, [prose(rng, 150_000, 10_000) + " " + item + " " + prose(rng, 100, 10_000)], [(1, item)])


def test_repeated_rows_null_ids_and_empty_tables(spark):
    item = " ".join(f"x{i}" for i in range(12))
    b = spark.createDataFrame([(1, item), (None, item)], "item_id bigint, text string")
    d = documents(spark, [item, item, item, "other"], ids=[7, 7, None, 8])
    rows = sorted((str(r.doc_id), r.n_hit, list(r["items"])) for r in decontaminate(d, b, bits=1 << 15).collect())
    assert rows == [("7", 12, ["1"]), ("7", 12, ["1"]), ("8", 0, []), ("None", 12, ["1"])]
    assert decontaminate(d.limit(0), b, bits=1 << 15).count() == 0
    assert [r.n_hit for r in decontaminate(d, b.limit(0), bits=1 << 15).collect()] == [0] * 4
    kept = drop_contaminated(d, b, bits=1 << 15)
    assert kept.columns == d.columns
    assert [r.doc_id for r in kept.collect()] == [8]
    assert contaminated(d, b).filter("contaminated").count() == 3
