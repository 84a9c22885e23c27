"""Small tables and brute-force helpers of the tests."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")

#: a column for each name that an operator uses inside, to clash with it
CLASH = ("row_key", "key", "text_", "rep", "leaf", "n", "ids", "kept", "spans", "__hash", "__text", "h", "id")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def blank_words(text):
    return BLANK.findall(text or "")


def documents(spark, texts, ids=None, clash=True):
    """Documents of the texts, with extra columns whose names clash with inner ones."""
    ids = list(range(len(texts))) if ids is None else ids
    extra = CLASH if clash else ()
    schema = ", ".join(["doc_id bigint", "text string", *[f"`{c}` string" for c in extra]])
    return spark.createDataFrame([(i, t, *[None] * len(extra)) for i, t in zip(ids, texts)], schema)


def prose(rng: random.Random, n, vocabulary=40):
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))
