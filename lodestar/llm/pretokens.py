"""Pre-tokens of many texts at once, as arrays.

``split`` cuts texts where the pattern of the public byte-level BPE files does
(``public_tokenizers.PATTERN``: contractions, an optional space with a run of
letters, of digits or of other signs, and runs of white space), and numbers the
distinct pre-tokens. The pattern looks at the class of each character and its
neighbours only, so the cuts are computed for a whole batch with array
operations instead of one match object per pre-token.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Unicode's White_Space characters.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0            "
    "    　"
)
LETTER, DIGIT, SIGN, SPACE = 0, 1, 2, 3
#: Characters that are cut at a time, so that the arrays stay small.
STEP = 1 << 19


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x110000)), np.uint8, 0x110000)
    table[[ord(c) for c in WHITE_SPACE]] = SPACE
    return table


def _starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags the characters that begin a pre-token. ``first``: positions at which texts begin."""
    n = len(chars)
    kind = char_classes()[chars]
    begin = np.zeros(n + 1, bool)
    begin[first] = True
    begin[n] = True
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= begin[:n]
    space = kind == SPACE
    # the last character of a white-space run stands before a non-space of the same text
    before = space & ~begin[1:]
    before[:-1] &= ~space[1:]
    before[-1:] = False
    joins = before & (chars == 32)  # a blank goes with what follows
    start = change.copy()
    start |= before  # the rest of the run is a pre-token of its own
    after = np.flatnonzero(joins) + 1
    start[after] = False
    # contractions: an apostrophe that begins a pre-token, then s, t, m, d, re, ve or ll
    quote = np.flatnonzero((chars == 39) & start)
    if len(quote):
        pad = np.concatenate([chars, np.zeros(2, chars.dtype)])
        inside = lambda k: (quote + k < n) & ~begin[np.minimum(quote + k, n)]
        one, two = pad[np.minimum(quote + 1, n)], pad[np.minimum(quote + 2, n)]
        short = inside(1) & np.isin(one, [ord(c) for c in "stmd"])
        pair = inside(1) & inside(2) & np.logical_or.reduce(
            [(one == ord(p[0])) & (two == ord(p[1])) for p in ("re", "ve", "ll")])
        for at, length in ((quote[short], 2), (quote[pair], 3)):
            start[at + 1] = False
            rest = at + length
            # what follows begins anew, except that a blank's or sign's own cut stays as it is
            rest = rest[rest < n]
            start[rest] |= kind[rest] == LETTER
            if length == 3:
                start[at + 2] = False
    return start


def _cut(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of the texts in order, and each text's first pre-token (plus the end)."""
    data = "".join(texts).encode("utf-8", "surrogatepass")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.concatenate([[0], np.cumsum(lengths)])
    if not data:
        return pa.array([], pa.large_binary()), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    if edges[-1] == len(raw):
        chars, at = raw, None
    else:
        chars = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.flatnonzero((raw & 0xC0) != 0x80)
    start = np.flatnonzero(_starts(chars, np.unique(edges[:-1][lengths > 0])))
    cuts = np.concatenate([start if at is None else at[start], [len(raw)]]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    return words, np.searchsorted(start, edges)


def split(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pre-tokens, the code of each pre-token in order, and each text's first code (plus the end)."""
    words, docs, total = [], [np.zeros(1, np.int64)], 0
    for part in batches(texts, STEP):
        w, d = _cut(texts[part])
        words.append(w)
        docs.append(total + d[1:])
        total += len(w)
    coded = pa.chunked_array(words, pa.large_binary()).dictionary_encode().unify_dictionaries()
    if not coded.num_chunks:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.concatenate(docs)
    codes = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
    return coded.chunk(coded.num_chunks - 1).dictionary, codes, np.concatenate(docs)


def batches(texts: Sequence[str], size: int) -> Iterator[slice]:
    """Runs of texts of about ``size`` characters; a longer text is a run of its own."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield slice(begin, i)
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def runs(column: pa.Array, size: int) -> Iterator[slice]:
    """Like ``batches``, for a column of texts that aren't Python's yet (``size`` in bytes)."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    begin, n = 0, len(ends)
    while begin < n:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, "right")))
        yield slice(begin, end)
        begin = end
