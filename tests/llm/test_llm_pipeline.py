"""The stages over planted documents, against brute force; each judged on its own input."""

import random

import pytest

import corpus_pipeline as C
from llm_helpers import alnum_words, prose
from tableflow.llm.common import scratch_path

pytest.importorskip("public_tokenizers")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    w = alnum_words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(3)
    bench = [(i, prose(rng, 30, 10**6)) for i in range(5)]
    texts, kinds = [], []
    for i in range(160):
        t = prose(rng, rng.randint(60, 150), 4000).split()
        kind = ["clean", "clean", "clean", "toxic", "junk"][i % 5]
        if kind == "toxic":
            for _ in range(3):
                t[rng.randrange(len(t))] = rng.choice(["vilename", "rudename"])
        if kind == "junk":
            t = [w + "###" for w in t]
        texts.append(" ".join(t))
        kinds.append(kind)
    near = texts[0].split()
    near[10] = "changed"
    extra = [(texts[0], "copy"), (" ".join(near), "copy"), (texts[1] + " " + bench[2][1].upper(), "bench"),
             (texts[2] + " password = hunter2secret é", "secret"), ("too short", "junk"), ("", "junk"), (None, "junk")]
    # texts of the extra kinds differ from theirs by more than a fifth, but for the copies
    extra = [(x if k == "copy" or not x or k == "junk" else prose(rng, 80, 10**6) + " " + x, k) for x, k in extra]
    rows = [(i, t, "en", "s", len(t or "")) for i, (t, _) in enumerate([*zip(texts, kinds), *extra])]
    kinds += [k for _, k in extra]
    rows.append((None, texts[6] + " tail of a row without an id " + prose(rng, 60, 10**6), None, None, None))
    kinds.append("clean")
    sf = scratch_path(spark, "planted")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{sf}/documents.parquet")
    labels = [(i, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kinds[:160])]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows, kinds


def test_stages(spark, planted):
    sf, rows, kinds = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        out = scratch_path(spark, name)
        stage(spark, docs, sf).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        if name != C.STAGES[-1][0]:
            assert docs.columns == before.columns
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    good = {r[0] for r, k in zip(rows, kinds) if k not in ("toxic", "junk")}
    assert set(seen["quality_rules"]) == good
    copies = {0, 160, 161}
    assert set(seen["near_duplicates"]) == good - copies | {0}
    by_id = {r[0]: shingles(r[1]) for r in rows if r[0] in good}
    pairs = [(a, b) for a in by_id for b in by_id if a is not None and b is not None and a < b
             and len(by_id[a] & by_id[b]) >= 0.8 * len(by_id[a] | by_id[b])]
    assert set(pairs) == {(0, 160), (0, 161), (160, 161)}
    assert set(seen["benchmark_passages"]) == set(seen["near_duplicates"]) - {162}
    assert set(seen["secret_scan"]) == set(seen["benchmark_passages"])
    for i, r in seen["secret_scan"].items():
        was = seen["benchmark_passages"][i]
        if i == 163:
            assert r["text"].endswith(" [SECRET] é") and "hunter2secret" not in r["text"] and r["n_chars"] == len(r["text"])
        else:
            assert tuple(r) == tuple(was)
    assert set(seen["token_ids"]) == set(seen["secret_scan"]) and all(r["round_trip"] for r in seen["token_ids"].values())


def test_run_equals_the_stages_and_takes_empty_tables(spark, planted):
    sf, _, _ = planted
    # 96 clean ones, two copies, the benchmark, secret and null-id rows; without the copies and the benchmark one
    assert C.run(spark, sf).count() == 101 - 2 - 1
    empty = scratch_path(spark, "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert C.run(spark, empty).count() == 0
    assert C.ORACLE_SQL is None and [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "benchmark_passages", "secret_scan", "token_ids"]


def test_no_line_of_a_private_key_is_left(spark, planted):
    import public_tokenizers
    import tiktoken.load

    sf, _, _ = planted
    rng = random.Random(8)
    body = ["".join(rng.choice("ABCDEFGHabcdefgh0189+/") for _ in range(64)) for _ in range(14)] + ["AbCd19+/xYz="]
    pem = "\n".join(["-----BEGIN RSA PRIVATE KEY-----", *body, "-----END RSA PRIVATE KEY-----"])
    texts = [f"first words\n{pem}\nlast words", "first words\n" + pem.rsplit("\n", 1)[0]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], COLUMNS)
    clean = {r["doc_id"]: r for r in C.secret_scan(spark, docs, sf).collect()}
    names = {i: b for b, i in tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")).items()}
    for r in C.token_ids(spark, spark.createDataFrame(list(clean.values()), COLUMNS), sf).collect():
        text = clean[r["doc_id"]]["text"]
        ids = memoryview(bytes(r["ids"])).cast("I")
        assert b"".join(names[i] for i in ids).decode() == text and clean[r["doc_id"]]["n_chars"] == len(text)
        assert not any(x in text for x in [*body, "PRIVATE KEY"])
        assert text.startswith("first words\n[SECRET]")
