"""Byte-level BPE's split of text into pieces, vectorised over a whole Arrow column.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
cuts at the borders of runs of one class (letter, number, white space, other) with three
exceptions: a U+0020 belongs to the run that follows it, the last character of a run
of white space before something else stands apart, and a lone apostrophe takes the
letters of a contraction.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa

from tableflow.llm.words import string_buffer

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: fixed values: the characters with the White_Space property
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: fixed values: letters and numbers that Unicode 16.0, which the tokenizer libraries
#: follow, added to the 15.1 of Python 3.13's tables
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                            np.uint8, sys.maxunicode + 1)
        for ranges, k in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
            for a, z in ranges:
                table[a:z + 1] = k
        table[WHITE] = SPACE
        _classes.append(table)
    return _classes[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each starts."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.int32)
    pad = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0xF8, 4, 0x07)):
        of = np.flatnonzero((cp >= low) & (cp < high) & (data[at] >= low))
        if len(of):
            value = cp[of] & mask
            for j in range(1, size):
                value = (value << 6) | (pad[at[of] + j] & 0x3F)
            cp[of] = value + (1 << 24)  # marked, so that the next rounds pass it by
    cp[cp >= 1 << 24] -= 1 << 24
    return cp, at


def pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, row): the byte spans of the pieces; row i has the pieces row[i]:row[i+1]."""
    data, offsets = string_buffer(column)
    cp, at = code_points(data)
    n = len(cp)
    if n == 0:
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(offsets), np.int64)
    c = classes()[cp]
    head = np.zeros(n + 1, bool)  # first character of a text; also one past the last
    head[np.searchsorted(at, offsets)] = True
    head[n] = True
    run = np.ones(n, bool)
    run[1:] = (c[1:] != c[:-1]) | head[1:n]
    start = run.copy()
    # runs after white space of the same text
    after = np.flatnonzero(run & (c != SPACE) & ~head[:n])
    after = after[c[after - 1] == SPACE]
    start[after - 1] = True
    start[after[cp[after - 1] == 0x20]] = False
    # a lone apostrophe that no space was joined to, and letters behind it
    lone = np.flatnonzero(run & (cp == 0x27) & start)
    lone = lone[lone + 1 < n]
    lone = lone[(c[lone + 1] == LETTER) & ~head[lone + 1]]
    if len(lone):
        pad = np.concatenate([cp, np.zeros(2, cp.dtype)])
        first, second = pad[lone + 1], pad[lone + 2]
        one = np.isin(first, [ord(x) for x in "stmd"])
        in_text = (lone + 2 < n) & ~head[np.minimum(lone + 2, n)]
        two = np.zeros(len(lone), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (first == ord(a)) & (second == ord(b)) & in_text
        took = lone[one | two]
        start[took + 1] = False
        rest = np.concatenate([lone[one] + 2, lone[two] + 3])
        rest = rest[rest < n]
        rest = rest[(c[rest] == LETTER) & ~head[rest]]
        start[rest] = True
    begin = at[np.flatnonzero(start)]
    end = np.append(begin[1:], len(data))
    return data, begin, end, np.searchsorted(begin, offsets)
