"""Vectorised word and shingle hashing over Arrow string columns (numpy).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z
lower-cased.  Its 64-bit hash is a polynomial over a table of random byte
values, taken as a difference of running sums, so a column is hashed with a
handful of array operations instead of a loop per word.  The text is walked
in pieces of about ``PIECE`` bytes cut at word boundaries: memory does not grow
with the length of a text.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Task functions travel by value: workers need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 20
U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_GOLD = U(0x9E3779B97F4A7C15)
R = 0xD1342543DE82EF95  # odd, so invertible modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def _byte_table() -> np.ndarray:
    t = mix((np.arange(256, dtype=U) + U(1)) * _GOLD) | U(1)
    t[ord("A"):ord("Z") + 1] = t[ord("a"):ord("z") + 1]
    return t


TABLE = _byte_table()
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SHINGLE_COEF = mix(np.arange(101, 133, dtype=U) * _GOLD) | U(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n + 1:
        for name, base in (("p", R), ("i", pow(R, -1, 1 << 64))):
            a = np.full(n + 1, U(base), dtype=U)
            a[0] = U(1)
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["p"], _POWERS["i"]


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    off = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return off - off[0], raw


def word_spans(off: np.ndarray, raw: np.ndarray):
    """Yields (starts, ends) of the words, piece by piece, as byte positions."""
    n, at = len(raw), 0
    while at < n:
        to = min(n, at + PIECE)
        while to < n and not SPACE[raw[to]]:  # extend to the end of the word
            step = raw[to:to + 4096]
            gap = np.flatnonzero(SPACE[step])
            to = to + int(gap[0]) if len(gap) else to + len(step)
        word = ~SPACE[raw[at:to]]
        edge = np.zeros(to - at + 1, bool)
        lo, hi = np.searchsorted(off, [at, to])
        edge[off[lo:hi + 1][off[lo:hi + 1] <= to] - at] = True
        before = np.concatenate(([False], word[:-1]))
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.concatenate((word[1:], [False]))
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        yield at, to, starts, ends
        at = to


def word_hashes(col) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every row)."""
    off, raw = buffers(col)
    hashes, firsts = [], []
    for at, to, starts, ends in word_spans(off, raw):
        p, inv = _powers(to - at)
        run = np.empty(to - at + 1, U)
        run[0] = 0
        np.cumsum(TABLE[raw[at:to]] * p[:to - at], out=run[1:])
        hashes.append(mix((run[ends] - run[starts]) * inv[starts]))
        firsts.append(starts + at)
    h = np.concatenate(hashes) if hashes else np.zeros(0, U)
    first = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return h, np.diff(np.searchsorted(first, off)) if len(off) > 1 else np.zeros(0, np.int64)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of every row; rows with 1 to
    k - 1 words have one shingle, the whole sequence; rows without words none."""
    bounds = np.concatenate(([0], np.cumsum(counts)))
    full = np.zeros(max(0, len(h) - k + 1), U)
    for j in range(k):
        full += h[j:j + len(full)] * SHINGLE_COEF[j]
    full = mix(full)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            s = np.sort(full[a:b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s)
        elif b > a:
            out.append(mix(np.array([np.sum(h[a:b] * SHINGLE_COEF[:b - a], dtype=U)], U)))
        else:
            out.append(np.zeros(0, U))
    return out


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 4 << 20, most_rows: int = 4096):
    """The batch in parts of about ``most_bytes`` of text (one row at least) and
    ``most_rows`` rows at most."""
    off, _ = buffers(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most_bytes, "right")) - 1)
        to = min(to, at + most_rows)
        yield batch.slice(at, to - at)
        at = to


def code_points(col) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all rows, offsets of the rows in them); null as empty."""
    off, raw = buffers(col)
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return cps, lead[off]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans (rising, not overlapping), case kept."""
    table = mix((np.arange(256, dtype=U) + U(1)) * _GOLD) | U(1)
    out, at = np.empty(len(starts), U), 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + PIECE, "right")))
        hi = int(ends[to - 1])
        p, inv = _powers(hi - lo)
        run = np.empty(hi - lo + 1, U)
        run[0] = 0
        np.cumsum(table[raw[lo:hi]] * p[:hi - lo], out=run[1:])
        a, b = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((run[b] - run[a]) * inv[a] + (b - a).astype(U) * _GOLD)
        at = to
    return out


def gather(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[first[i]:first[i] + count[i]] for all i, one after the other."""
    end = np.cumsum(count)
    total = int(end[-1]) if len(end) else 0
    return flat[np.repeat(first - (end - count), count) + np.arange(total)]
