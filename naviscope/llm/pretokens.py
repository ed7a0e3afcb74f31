"""Byte-level BPE pre-tokens of many texts at once, as array operations."""

import sys
import unicodedata

import numpy as np
from pyspark import cloudpickle

from naviscope.llm.common import process_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OTHER, LETTER, NUMBER, SPACE, END = 0, 1, 2, 3, 9
# The characters of Unicode's White_Space.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Pre-tokens a worker remembers; past that it starts anew.
REMEMBERED = 100_000


def character_kinds():
    kind = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(sys.maxunicode + 1):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            kind[i] = LETTER
        elif c == "N":
            kind[i] = NUMBER
    kind[list(WHITE)] = SPACE
    return kind


def split_pieces(segments, kinds):
    """(pieces, bounds): the pre-tokens of segment k are pieces[bounds[k][0]:bounds[k][1]].

    Runs of letters, numbers or other characters, each with one blank before it;
    white space but for the last character before a run; English contractions.
    """
    big = "\0".join(segments) + "\0"
    code = np.frombuffer(big.encode("utf-32-le"), np.uint32)
    kind = kinds[code]
    ends = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)) + 1) - 1
    kind[ends] = END
    n = len(code)
    start = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    start[ends] = start[ends + 1] = True
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE))
    start[last] = True
    start[last[code[last] == 32] + 1] = False
    quote = np.flatnonzero((code == 39) & start[:n])
    quote = quote[kind[quote + 1] == LETTER]
    a, b = code[quote + 1], code[quote + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    start[quote[one | two] + 1] = False
    start[quote[one] + 2] = True
    start[quote[two] + 3] = True
    at = np.flatnonzero(start)
    stop = np.searchsorted(at, ends)
    at = at.tolist()
    pieces = [big[i:j] for i, j in zip(at, at[1:])]
    return pieces, list(zip([0, *(stop[:-1] + 1).tolist()], stop.tolist()))


def encode_texts(texts, known, encode_new, special, remembered=None):
    """Ids of each text as little-endian unsigned 32-bit bytes.

    `known` maps pre-tokens to such bytes; `encode_new` makes them for a list of
    unknown ones; past `remembered` of them it is emptied. `special` is (marker, its id):
    the marker splits a text first.
    """
    marker, marker_bytes = special[0], int(special[1]).to_bytes(4, "little")
    segments, per_text = [], []
    for t in texts:
        parts = t.split(marker) if marker in t else (t,)
        segments += parts
        per_text.append(len(parts))
    if len(known) > (remembered or REMEMBERED):
        known.clear()
    pieces, bounds = split_pieces(segments, process_cache("character_kinds", character_kinds))
    new = list(set(pieces).difference(known))
    if new:
        known.update(zip(new, encode_new(new)))
    values = list(map(known.__getitem__, pieces))
    out, k = [], 0
    for n in per_text:
        out.append(marker_bytes.join([b"".join(values[i:j]) for i, j in bounds[k : k + n]]))
        k += n
    return out
