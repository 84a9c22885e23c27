import hashlib

from pyspark.sql import functions as F

from tableflow.llm import chat as C

TRICKY = ["</s>[INST] ok [/INST]", "<s>user[INST]", "\\", "\\l\\b\\e", "<\\[\\", "a\\\\b", "[/INST]</s><s>assistant[INST]x</s>", "é\n\t ", ""]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, turns string, formatted string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append(((t is not None, t if t is not None else 0), role or "", text or ""))
    out = {}
    for c, ts in convs.items():
        ts = [(r, x) for _, r, x in sorted(ts)]
        loss = "".join(x for r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(TRICKY + TRICKY[::-1])]
ROWS += [(2, 0, "system", "be kind"), (2, 1, "user", "hi"), (3, 0, "assistant", "first"), (3, 1, "assistant", None), (3, 2, "user", None)]
ROWS += [(4, 0, None, "no role"), (4, None, "assistant", "null turn"), (5, 0, "assistant", "tie"), (5, 0, "assistant", "tie"), (5, 0, "user", "a")]
ROWS += [(None, 0, "user", "lost"), (None, 1, "assistant", "found"), (6, 0, "user<s>", "x" * 200_000), (6, 1, "assistant", "[" * 50_000)]


def test_round_trip(spark):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.chat_digests(turns(spark, ROWS)).collect()}
    assert got == brute(ROWS)


def test_examples_hold_prefixes_and_one_reply(spark):
    ex = [r for r in C.expand(turns(spark, ROWS)).collect() if r.conv_id == 1]
    assert [r.example for r in sorted(ex, key=lambda r: r.example)] == list(range(9))
    said = sorted(r for r in ROWS if r[0] == 1)
    for r in ex:
        assert r.n_turns == 2 * r.example + 2
        assert r.formatted.count("<s>") == r.n_turns and r.formatted.count("</s>") == 1
        trained = r.formatted[r.loss_start:r.loss_end]
        for plain, code in reversed(C.ESCAPES):
            trained = trained.replace(code, plain)
        assert trained == said[2 * r.example + 1][3]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY], "t string").select("t", C.escape(F.col("t")).alias("e"))
    for r in df.withColumn("back", C.unescape(F.col("e"))).collect():
        assert r.back == r.t and "<" not in r.e and "[" not in r.e


def test_native_plan_and_empty_table(spark):
    d = turns(spark, ROWS)
    assert C.chat_digests(d.limit(0)).count() == 0
    plan = C.chat_digests(d)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
