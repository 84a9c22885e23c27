import hashlib
import itertools
import random
import zlib

import pytest

from tableflow.llm import repair as R

BLANKS = " \t\n\x0b\x0c\r"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """All derivations from left to right, without intervals: place -> least (cost, audit, repaired)."""
    def closed(known):
        for _ in range(6):
            for (p, (cost, audit, said)) in list(known.items()):
                for other in "ua":
                    q = MOVES.get((p, other))
                    new = (cost + 2, audit + "I", (*said, ("user" if other == "u" else "assistant", "")))
                    if q is not None and (q not in known or new[:2] < known[q][:2]):
                        known[q] = new
        return known

    known = closed({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, kinds):
        after = {}

        def put(q, new):
            if q is not None and (q not in after or new[:2] < after[q][:2]):
                after[q] = new

        for p, (cost, audit, said) in known.items():
            put(p, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            put(MOVES.get((p, role[:1])), (cost + extra, audit + "K", (*said, (role, text))))
            for other, name in (("u", "user"), ("a", "assistant")):
                put(MOVES.get((p, other)), (cost + 2 + extra, audit + "R", (*said, (name, text))))
        known = closed(after)
    return min(known[q] for q in (0, 3) if q in known)


def brute(rows, ids):
    convs = {c: [] for c in ids}
    for c, t, role, text in rows:
        convs[c].append((t, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, ts in convs.items():
        ts.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        kinds = faults(ts)
        cost, audit, said = cheapest(ts, kinds)
        turns = [t for t, _, _ in ts if t is not None]
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
                  sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(ts)), cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{x}" for r, x in said).encode()).hexdigest())
    return out


def damaged(rows):
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(ch for ch in text if ch not in ".!?")
        elif kind == 4:
            role = "user"
        yield from [(c, t, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def frame(spark, rows):
    """Rows with extra columns of names that are used inside."""
    schema = "conv_id bigint, turn bigint, role string, text string, conv string, kind string, piece string, fault string, said string, bare string"
    return spark.createDataFrame([(*r, *[None] * 6) for r in rows], schema)


def got(df):
    return {r["conv_id"]: tuple(r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def sample(seed, n):
    rng = random.Random(seed)
    texts = ["a.", "b", "c!", "", " \n", "d?", "e. ", "a. \t", None]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            rows.append((c if rng.random() < 0.97 else None, t + (rng.random() < 0.1) if rng.random() < 0.95 else None,
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unit", None]), rng.choice(texts)))
    return rows


def test_cells_equal_a_left_to_right_search():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(0, rng.choice(["user", "assistant", "system", "x", ""]), rng.choice(["p.", "q", "", "r!"])) for _ in range(rng.randint(0, 12))]
        kinds = faults(rows)
        chart = R.Chart()
        for (_, role, _), fault in zip(rows, kinds):
            chart.add(R.unit(role[:1], fault))
        assert R.cheapest(chart.whole()) == cheapest(rows, kinds)[:2]


def test_every_split_of_a_span_gives_the_same_cell():
    rng = random.Random(6)
    cells = [R.unit(rng.choice("uasx"), rng.choice(["", "truncated", "blank"])) for _ in range(9)]

    def whole(part):
        return part[0] if len(part) == 1 else R.join(whole(part[:1]), whole(part[1:]))

    first = whole(cells)
    assert all(R.join(whole(cells[:k]), whole(cells[k:])) == first for k in range(1, 9))


def test_damaged_conversations(spark):
    rows = sample(1, 150) + [(None, 0, "user", "x" * 300_000), (999, 3, "user", "kept."), (999, 3, "user", "kept.")]
    out = got(R.repair_damaged(frame(spark, rows)))
    assert out == brute(list(damaged(rows)), {r[0] for r in rows})


def test_conversation_over_many_tasks(spark):
    rows = [(1, t, ["user", "assistant", "assistant"][t % 3], f"t{t % 700}.") for t in range(3000)] + [(2, 0, "user", "a"), (2, 0, "user", "a")]
    df = frame(spark, rows).selectExpr("conv_id AS conv", "turn", "role", "text")
    out = got(R.repair(df, df.select("conv")).withColumnRenamed("conv", "conv_id"))
    assert out == brute(rows, {1, 2})


def test_turns_have_the_hash(spark):
    df = frame(spark, sample(2, 40)).selectExpr("conv_id AS conv", "turn", "role", "text")
    hashes = {k: v[-1] for k, v in got(R.repair(df, df.select("conv")).withColumnRenamed("conv", "conv_id")).items()}
    said = {k: [] for k in hashes}
    for r in sorted(R.repair(df, df.select("conv"), "turns").collect(), key=lambda r: r["place"]):
        said[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in said.items()} == hashes


def test_no_rows(spark):
    nothing = hashlib.sha256(b"").hexdigest()
    empty = frame(spark, [])
    assert got(R.repair_damaged(empty)) == {}
    asked = spark.createDataFrame([(7,), (None,)], "conv bigint")
    out = got(R.repair(empty.selectExpr("conv_id AS conv", "turn", "role", "text"), asked).withColumnRenamed("conv", "conv_id"))
    assert out == {7: (0, 0, 0, 0, 0, 0, "", nothing), None: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_other_ids(spark):
    df = spark.createDataFrame([("c", 1, "user", "a."), ("c", 2, "assistant", "b.")], "conv_id string, turn int, role string, text string")
    assert got(R.repair(df.withColumnRenamed("conv_id", "conv"), df.selectExpr("conv_id AS conv")).withColumnRenamed("conv", "conv_id"))["c"][5:7] == (0, "KK")
    with pytest.raises(TypeError):
        R.repair(df.selectExpr("CAST(1.5 AS double) AS conv", "turn", "role", "text"), df.selectExpr("conv_id AS conv"))
