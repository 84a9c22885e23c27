"""Records of delimited files over many splits."""

import csv
import os
import random
import tempfile

import pytest

from tableflow.sources import delimited as DL
from tableflow.sources import file_records as FR


@pytest.fixture()
def small_splits(spark):
    """Splits of some thousand bytes, so records and quoted fields lie across them."""
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng):
    kind = rng.random()
    if kind < 0.35:
        return rng.choice(["", "x", "áé", "7", '5" pipe', 'a"b"c', "  pad "])
    body = "".join(rng.choice(["w", " ", "»", '""', "\n", "\r\n", "\n\n", "ñ", "word"]) for _ in range(rng.randint(0, 12)))
    return f'"{body}"' if kind < 0.9 else '"' + "line\n" * rng.randint(100, 1500) + '"'


def land(folder, name, rng, n, end="\n"):
    lines = ['Id»"Name" »Rest']
    for i in range(n):
        lines.append("»".join([str(i), *[field(rng) for _ in range(rng.choice([2, 2, 2, 2, 1, 3]))]]))
        if rng.random() < 0.1:
            lines.append("")
    with open(os.path.join(folder, name), "w", encoding="latin-1", newline="") as f:
        f.write(end.join(lines) + (end if rng.random() < 0.5 else ""))


def expected(folder):
    """(number, id, name, rest) by the standard library's reader, file after file."""
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="latin-1", newline="") as f:
            rows = [r for r in csv.reader(f, delimiter="»") if r][1:]
        out += [(len(out) + k, *[(v or None) for v in (r + [None] * 3)[:3]]) for k, r in enumerate(rows, start=1)]
    return out


@pytest.mark.parametrize("seed, end", [(1, "\n"), (3, "\r\n")])
def test_records_equal_a_reader_that_goes_through_the_files(spark, small_splits, seed, end):
    rng, folder = random.Random(seed), tempfile.mkdtemp(prefix="tf-rec-")
    for k in range(3):
        land(folder, f"f{k}.txt", rng, 60 + 40 * k, end)
    got = FR.read_records(spark, folder, number="n")
    rows = sorted((r["n"], r["id"], r["name"] or None, r["rest"] or None) for r in got.collect())
    assert rows == expected(folder)
    per_file = FR.splits(spark, folder).groupBy(FR.FILE).count().collect()
    assert len(per_file) == 3 and min(r["count"] for r in per_file) >= 5


def test_records_equal_the_multi_line_reader(spark, small_splits):
    rng, folder = random.Random(4), tempfile.mkdtemp(prefix="tf-rec-")
    land(folder, "one.txt", rng, 200)
    for bad in (None, "mal"):
        one = DL.read_delimited(spark, folder, multi_line=True, corrupt_column=bad)
        many = FR.read_records(spark, folder, corrupt_column=bad)
        assert many.columns == one.columns
        assert sorted(map(repr, many.collect())) == sorted(map(repr, one.collect()))


def test_states_of_lines():
    """The state after a line, from outside and inside a quoted field."""
    lines = [("", 0, 1), ("a»b", 0, 1), ('"a', 1, 0), ('a"', 0, 0), ('"a"', 0, 0), ('x»"', 1, 0), ('""', 0, 1), ('"""', 1, 0), ('""""', 0, 1),
             ('"a""', 1, 0), ('5" pipe»"', 1, 1), ('"»"', 0, 1), ('a"»"b', 1, 1), ('"a"b"»c', 0, 0), ('"a»"»"', 1, 0), ('»""»"x""', 1, 0)]

    def state(line, inside):
        """Character by character."""
        at, i = ("in" if inside else "start"), 0
        while i < len(line):
            c = line[i]
            if at == "in":
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    at = "text"
            elif c == "»":
                at = "start"
            else:
                at = "in" if at == "start" and c == '"' else "text"
            i += 1
        return int(at == "in")

    move = FR.line_moves("»".encode())
    for line, a, b in lines:
        assert (move(line.encode(), 0), move(line.encode(), 1)) == (state(line, False), state(line, True)) == (a, b), line


def test_resume_after_a_record(spark, small_splits):
    rng, folder = random.Random(5), tempfile.mkdtemp(prefix="tf-rec-")
    land(folder, "a.txt", rng, 80)
    land(folder, "b.txt", rng, 20)
    whole = {tuple(r) for r in FR.read_records(spark, folder, number="n").collect()}
    first = {tuple(r) for r in FR.read_records(spark, folder, number="n").where("n <= 83").collect()}
    rest = {tuple(r) for r in FR.read_records(spark, folder, number="n", after=83).collect()}
    assert len(whole) == 100 and first | rest == whole and not first & rest


def test_files_without_records(spark):
    folder = tempfile.mkdtemp(prefix="tf-rec-")
    for name, text in (("a.txt", "h1»h2\n"), ("b.txt", "h1»h2"), ("c.txt", "h1»h2\n1»2"), ("d.txt", 'h1»h2\n"open»\n')):
        with open(os.path.join(folder, name), "w", encoding="latin-1") as f:
            f.write(text)
    got = sorted(map(tuple, FR.read_records(spark, folder, number="n").select("n", "h1").collect()))
    assert got[0] == (1, "1") and got[1][0] == 2 and got[1][1].startswith("open»")
