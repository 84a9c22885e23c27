import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import regex

from llm_helpers import documents
from tableflow.llm import bpe, pretoken, token_counts

P = pytest.importorskip("public_tokenizers")
RANKS, SPEC = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
PARTS = ["a", "b", "s", "t", "re", "'", "'s", "'ll", "'ve", "'Ll", " ", "  ", "\n", "\t", " ", "\u0085", "é", "ß", "1", "٣", "½",
         "!", "$", "😀", " ", "\x1c", "Ⅷ", "中文", "'d", "'m", "\r\n", "the", " of", "<|endoftext|>"]


def texts(n=3000, seed=1):
    rng = random.Random(seed)
    out = [None, "", " ", "'", "'s", "a's", " 's", "\n's", "a" * 3000, "ab" * 2000 + " x", " " * 900, "!" * 1000, "é" * 500, "zq" * 400]
    out += ["".join(rng.choice("abcdefgh") for _ in range(700)), "".join(chr(rng.randint(32, 0x2FFF)) for _ in range(2000))]
    return out + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def tiktoken_encoding():
    import tiktoken

    v = bpe.vocabulary(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


def test_pieces_equal_the_pattern():
    # the regex module's own Unicode version is newer, so without a text of random characters
    t = [x for x in texts() if not x or max(x) < "\u2c00" and len(set(x)) < 100 or len(x) < 200]
    d, s, e, row = pretoken.pieces(pa.array(t, pa.string()))
    got = [[d[a:b].tobytes().decode() for a, b in zip(s[x:y], e[x:y])] for x, y in zip(row[:-1], row[1:])]
    pattern = regex.compile(P.PATTERN)
    assert got == [pattern.findall(x or "") for x in t]


def test_code_points():
    t = "".join(chr(c) for c in range(0, sys.maxunicode, 97) if not 0xD800 <= c < 0xE000)
    cp, at = pretoken.code_points(np.frombuffer(t.encode(), np.uint8))
    assert cp.tolist() == [ord(c) for c in t]
    assert len(at) == len(t)


def test_pair_table():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3000, 20_000), rng.integers(0, 3000, 20_000)
    _, first = np.unique(a * 3000 + b, return_index=True)
    a, b = a[first], b[first]
    table = bpe.PairTable(a, b, np.arange(len(a), dtype=np.int32))
    assert table(a, b).tolist() == list(range(len(a)))
    x, y = rng.integers(0, 3000, 5000), rng.integers(3000, 4000, 5000)
    assert (table(x, y) == bpe.NONE).all()


def test_ids_equal_the_library_and_decode(spark):
    t = texts(600)
    enc = tiktoken_encoding()
    d = documents(spark, t)
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(d, RANKS), RANKS).collect()}
    for i, x in enumerate(t):
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == enc.encode_ordinary(x or "")
        assert bytes(rows[i].decoded) == (x or "").encode()
    digests = {r.doc_id: r for r in bpe.bpe_digests(d, RANKS).collect()}
    for i, x in enumerate(t):
        ids = np.array(enc.encode_ordinary(x or ""), "<u4")
        assert digests[i].n_tokens == len(ids) and digests[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((x or "").encode()).hexdigest()


def test_every_code_point_is_classed_as_the_library_has_it():
    """A character belongs to the letters (digits) if it makes one piece with a letter (digit) before it."""
    import tiktoken

    cs = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    ranks = {bytes([b]): b for b in range(256)}
    for c in cs:
        for x in "a1":
            ranks.setdefault((x + chr(c)).encode(), len(ranks))
    enc = tiktoken.Encoding("probe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = pretoken.classes()
    for c in cs:
        want = pretoken.LETTER if len(enc.encode_ordinary("a" + chr(c))) == 1 else \
            pretoken.NUMBER if len(enc.encode_ordinary("1" + chr(c))) == 1 else 0
        assert want == (0 if table[c] == pretoken.SPACE else table[c]), hex(c)


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    t = texts(800, seed=2) + ["<|endoftext|>", "a<|endoftext|><|endoftext|> b"]
    lib = Tokenizer.from_file(SPEC)
    want = [len(x.ids) for x in lib.encode_batch([x or "" for x in t], add_special_tokens=False)]
    rows = {r.doc_id: r for r in token_counts.count_tokens(documents(spark, t), SPEC).collect()}
    assert [rows[i].n_tokens for i in range(len(t))] == want
    assert [rows[i].n_bytes for i in range(len(t))] == [len((x or "").encode()) for x in t]
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows.values())


def test_repeated_rows_and_empty_tables(spark):
    d = documents(spark, ["one two", "one two", None], ids=[1, 1, None])
    assert sorted(r.n_tokens for r in token_counts.count_tokens(d, SPEC).collect()) == [0, 2, 2]
    assert sorted(r.n_tokens for r in bpe.bpe_digests(d, RANKS).collect()) == [0, 2, 2]
    assert token_counts.count_tokens(d.limit(0), SPEC).count() == 0 and bpe.bpe_digests(d.limit(0), RANKS).count() == 0


def test_cache_starts_afresh(monkeypatch):
    m = token_counts.Merges(open(SPEC, "rb").read())
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 3)
    t = pa.array([f"word{i} other{i}" for i in range(20)])
    assert m.counts(t).tolist() == [int(m.counts(t.slice(i, 1))[0]) for i in range(20)]


def test_regular_pieces_have_their_own_ids(spark):
    """A word of 2,048 bytes and its complement, which a polynomial hash takes for one."""
    from tokenizers import Tokenizer

    from test_llm_words import thue_morse

    t = [thue_morse(11), thue_morse(11, "ba"), " ".join([thue_morse(11, "ai"), thue_morse(11, "ia")])]
    enc, lib = tiktoken_encoding(), Tokenizer.from_file(SPEC)
    d = documents(spark, t)
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(d, RANKS), RANKS).collect()}
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(d, SPEC).collect()}
    for i, x in enumerate(t):
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == enc.encode_ordinary(x) and bytes(rows[i].decoded) == x.encode()
        assert counts[i] == len(lib.encode(x, add_special_tokens=False).ids)


def test_names_with_dots(spark):
    d = spark.createDataFrame([(1, "one", "x")], "doc_id bigint, text string, `a.b` string")
    r = bpe.decode(bpe.encode(d, RANKS, keep=("doc_id", "a.b")), RANKS).first()
    assert r["a.b"] == "x" and bytes(r["decoded"]) == b"one"
