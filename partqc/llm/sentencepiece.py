"""N-best segmentation over a piece lattice, and decoding.

A text is a blank, then the text, with blanks written as the piece vocabulary's
word mark; every piece is an edge of the lattice and has a log probability.  No
piece continues after a blank that follows other characters, nor spans a line
feed (checked when the vocabulary is read), so the lattice is a chain of units and
a unit that occurs a thousand times is solved once.

* *Best path.*  All new units of a batch are solved together: the forward Viterbi
  scores of all units advance one position per array operation, and so do the
  backward ones, which give each unit's second-best score as the best path through
  an edge off the best path.
* *N-best.*  The text's next-best segmentations change the units whose second-best
  costs least.  Only these are searched: A* runs backward from the unit's end with
  the forward Viterbi scores as exact heuristics, so hypotheses are completed in
  order of score.  The text's N best are the least sums of the units' losses.

Piece scores: the vocabulary file holds merge ranks, not probabilities, so by
default a piece has the Zipf probability of its rank; ``model_scores=True`` takes
the file's scores (for files of the unigram kind).  A character that is no piece
is spelt by its bytes at a fixed penalty each.  The file is read on the driver; pieces
and scores (a vocabulary, some 100 kB) are broadcast.  It is never trained or
copied.

Decoding concatenates the pieces' bytes and drops the leading blank: every text
decodes to itself.

Nulls and oddities: a null or empty text has no pieces, one (empty) segmentation
of score 0, and decodes to the empty string; the word mark itself occurring in a
text is spelt by its bytes; texts of any length are segmented whole; rows that
repeat an id are segmented each; the input's other columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.llm.words import U, buffers, gather, mix, slices, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, OTHER = "▁", "\ud800"  # a lone surrogate: no text holds it
WIDEST = 24  # longer units are solved one by one
BYTE_LOSS = 10.0
CACHED_UNITS = 600_000


@dataclass
class Vocabulary:
    pieces: list  # by id; None for bytes and control pieces
    scores: np.ndarray
    bytes_: list  # the ids of the 256 byte pieces
    spelt: list  # by id, the bytes it decodes to


def read_vocabulary(path: str = MODEL, model_scores: bool = False) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    pieces, spelt, bytes_ = [None] * n, [b""] * n, [0] * 256
    for i in range(n):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            bytes_[int(name[3:5], 16)] = i
            spelt[i] = bytes([int(name[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[i] = name
            spelt[i] = name.replace(MARK, " ").encode()
            if MARK in name.lstrip(MARK) or "\n" in name:
                raise ValueError(f"piece {name!r} joins two units; this vocabulary is not supported")
    if model_scores:
        scores = np.array([sp.get_score(i) for i in range(n)])
    else:
        rank = np.cumsum([p is not None for p in pieces]) + 1.0
        scores = -np.log(rank * (1 / rank[[p is not None for p in pieces]]).sum())
    return Vocabulary(pieces, scores, bytes_, spelt)


class Lattice:
    """Segmentation of units by one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.of = {p: (i, float(v.scores[i])) for i, p in enumerate(v.pieces) if p is not None}
        self.longest = max(map(len, self.of))
        self.byte_score = min(s for _, s in self.of.values()) - BYTE_LOSS
        names = list(self.of)
        keys = np.array([self._key(p) for p in names], U)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([self.of[p][0] for p in names], np.int32)[order]
        assert (np.diff(self.keys) != 0).all()

    _P = 0x9E3779B97F4A7C15 | 1

    def _key(self, piece: str) -> int:
        h = 0
        for ch in piece:
            h = (h * self._P + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return int(mix(np.array([h], U))[0])

    def edges(self, unit: str) -> list[list[tuple[int, tuple, float]]]:
        """By start: (end, ids, score) of the pieces there."""
        out = []
        for i in range(len(unit)):
            here = []
            for j in range(i + 1, min(len(unit), i + self.longest) + 1):
                got = self.of.get(unit[i:j])
                if got:
                    here.append((j, (got[0],), got[1]))
            if not here or here[0][0] != i + 1:
                spell = (MARK if unit[i] == OTHER else unit[i]).encode("utf-8", "surrogatepass")
                here.insert(0, (i + 1, tuple(self.v.bytes_[b] for b in spell), self.byte_score * len(spell)))
            out.append(here)
        return out

    def nbest(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The unit's n best segmentations, best first: forward Viterbi, backward A*."""
        edges = self.edges(unit)
        forward = [0.0] + [-np.inf] * len(unit)
        into: list[list] = [[] for _ in range(len(unit) + 1)]
        for i, here in enumerate(edges):
            for j, ids, s in here:
                forward[j] = max(forward[j], forward[i] + s)
                into[j].append((i, ids, s))
        order = itertools.count()
        agenda = [(-forward[-1], next(order), len(unit), 0.0, None)]
        out = []
        while agenda and len(out) < n:
            total, _, at, done, tail = heapq.heappop(agenda)
            if at == 0:
                ids = []
                while tail:
                    ids.extend(tail[0])
                    tail = tail[1]
                out.append((-total, ids))
                continue
            for i, ids, s in into[at]:
                heapq.heappush(agenda, (-(done + s + forward[i]), next(order), i, done + s, (ids, tail)))
        return out

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids, ids of all, best score, loss of the second best) of units
        of at most WIDEST characters; a unit that needs bytes has the score -inf."""
        n, k = len(units), self.longest
        size = np.array([len(u) for u in units])
        width = int(size.max())
        ch = np.frombuffer("".join(u.ljust(width, "\0") for u in units).encode("utf-32-le", "surrogatepass"),
                           np.uint32).reshape(n, width)
        pid = np.full((k + 1, n, width), -1, np.int32)
        cost = np.full((k + 1, n, width), -np.inf)
        h = np.zeros((n, width), U)
        for length in range(1, min(k, width) + 1):
            m = width - length + 1
            h = h[:, :m] * U(self._P) + ch[:, length - 1:].astype(U) + U(1)
            row, col = np.nonzero(np.arange(m)[None, :] + length <= size[:, None])
            key = mix(h[row, col])
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            got = self.ids[at[hit]]
            pid[length, row[hit], col[hit]] = got
            cost[length, row[hit], col[hit]] = self.v.scores[got]
        forward = np.full((width + 1, n), -np.inf)
        forward[0] = 0
        step = np.zeros((width + 1, n), np.int64)
        for i in range(width):
            for length in range(1, min(k, width - i) + 1):
                s = forward[i] + cost[length, :, i]
                better = s > forward[i + length]
                forward[i + length][better] = s[better]
                step[i + length][better] = length
        backward = np.full((width + 1, n), -np.inf)
        backward[size, np.arange(n)] = 0
        for i in range(width - 1, -1, -1):
            for length in range(1, min(k, width - i) + 1):
                np.maximum(backward[i], cost[length, :, i] + backward[i + length], out=backward[i])
        best = forward[size, np.arange(n)]
        used = np.zeros((n, width), np.int64)
        rows = np.flatnonzero(np.isfinite(best))
        at = size[rows]
        while len(rows):
            length = step[at, rows]
            at = at - length
            used[rows, at] = length
            rows, at = rows[at > 0], at[at > 0]
        second = np.full(n, -np.inf)
        for length in range(1, min(k, width) + 1):
            for i in range(width - length + 1):
                through = forward[i] + cost[length, :, i] + backward[i + length]
                through[used[:, i] == length] = -np.inf
                np.maximum(second, through, out=second)
        row, col = np.nonzero(used)
        ids = pid[used[row, col], row, col]
        with np.errstate(invalid="ignore"):
            loss = np.where(np.isfinite(second), np.maximum(best - second, 0.0), np.inf)
        return np.bincount(row, minlength=n), ids, best, loss


class Segmenter:
    """Segments Arrow text columns; keeps the units it has solved."""

    def __init__(self, v: Vocabulary, n: int):
        self.lattice, self.n = Lattice(v), n
        self.spelt = np.frombuffer(b"".join(v.spelt), np.uint8)
        self.spelt_n = np.array([len(b) for b in v.spelt], np.int64)
        self.spelt_at = np.cumsum(self.spelt_n) - self.spelt_n
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.count, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.best, self.loss = np.zeros(0), np.zeros(0)
        self.lists: dict[int, list] = {}

    @staticmethod
    def units(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with a blank before each text, starts of the units, offsets of
        the rows in the bytes)."""
        off, raw = buffers(col)
        some = np.diff(off) > 0
        raw = np.insert(raw, off[:-1][some], 32)
        off = off + np.concatenate(([0], np.cumsum(some)))
        blank, feed = raw == 32, raw == 10
        start = feed.copy()
        start[1:] |= feed[:-1] | (blank[1:] & ~blank[:-1])
        start[off[:-1][some]] = True
        return raw, np.flatnonzero(start), off

    def _learn(self, new: list[tuple[int, str]]) -> None:
        """Solves units (hash, text) not met before."""
        short = [(h, u) for h, u in new if len(u) <= WIDEST]
        long = [(h, u) for h, u in new if len(u) > WIDEST]
        counts, flats, bests, losses, hashes = [], [], [], [], []
        short.sort(key=lambda x: len(x[1]))
        for at in range(0, len(short), 4096):
            part = short[at:at + 4096]
            count, ids, best, loss = self.lattice.solve([u for _, u in part])
            ok = np.isfinite(best)
            flats.append(ids)
            counts.append(count[ok])
            bests.append(best[ok])
            losses.append(loss[ok])
            hashes.extend(h for (h, _), y in zip(part, ok.tolist()) if y)
            long.extend(x for x, y in zip(part, ok.tolist()) if not y)
        for h, u in long:
            got = self.lattice.nbest(u, 2)
            flats.append(np.array(got[0][1], np.int32))
            counts.append(np.array([len(got[0][1])]))
            bests.append(np.array([got[0][0]]))
            losses.append(np.array([got[0][0] - got[1][0] if len(got) > 1 else np.inf]))
            hashes.append(h)
        base = len(self.count)
        self.known.update((h, base + i) for i, h in enumerate(hashes))
        self.count = np.concatenate([self.count, *counts])
        self.flat = np.concatenate([self.flat, *flats]).astype(np.int32)
        self.first = np.cumsum(self.count) - self.count
        self.best, self.loss = np.concatenate([self.best, *bests]), np.concatenate([self.loss, *losses])

    def segment(self, col) -> dict:
        """Per row: ids (flat, with offsets), score, alternatives, whether the ids
        decode to the text."""
        raw, starts, off = self.units(col)
        ends = np.concatenate((starts[1:], [len(raw)])).astype(np.int64)
        uniq, where, which = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > CACHED_UNITS:
            self._clear()

        def text(i: int) -> str:
            return raw[starts[i]:ends[i]].tobytes().decode().replace(MARK, OTHER).replace(" ", MARK)

        new = [(h, text(i)) for h, i in zip(uniq.tolist(), where.tolist()) if h not in self.known]
        if new:
            self._learn(new)
        tok = np.array([self.known[h] for h in uniq.tolist()], np.int64)[which] if len(uniq) else np.zeros(0, np.int64)
        n_ids = self.count[tok]
        ids = gather(self.flat, self.first[tok], n_ids)
        rows = np.searchsorted(starts, off)  # units of the rows
        till = np.concatenate(([0], np.cumsum(n_ids)))
        score = np.concatenate(([0.0], np.cumsum(self.best[tok])))
        loss = self.loss[tok]
        alternatives = []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            alternatives.append(self._others(a, b, loss, tok, till, text))
        spelt = gather(self.spelt, self.spelt_at[ids], self.spelt_n[ids])
        same = len(spelt) == len(raw) and bool((spelt == raw).all())
        good = np.ones(len(off) - 1, bool)
        if not same:
            at = np.concatenate(([0], np.cumsum(self.spelt_n[ids])))[till[rows]]
            good = np.array([bytes(spelt[at[i]:at[i + 1]]) == bytes(raw[off[i]:off[i + 1]]) for i in range(len(good))], bool)
        return {"ids": ids, "off": till[rows], "score": score[rows[1:]] - score[rows[:-1]],
                "others": alternatives, "good": good}

    def _others(self, a: int, b: int, loss, tok, till, text) -> list[dict]:
        """The next-best segmentations of the row of units a to b, each as its loss
        and the places where it differs from the best."""
        n = self.n - 1
        if n < 1 or a == b:
            return []
        d = loss[a:b]
        near = np.argpartition(d, n - 1)[:n] if b - a > n else np.arange(b - a)
        near = [a + i for i in sorted(near.tolist(), key=lambda i: (d[i], i)) if np.isfinite(d[i])]
        choices = []
        for u in near:
            t = int(tok[u])
            if t not in self.lists:
                own = self.flat[self.first[t]:self.first[t] + self.count[t]].tolist()
                found = self.lattice.nbest(text(u), self.n + 1)
                self.lists[t] = [(max(0.0, float(self.best[t]) - s), ids) for s, ids in found if ids != own][:n]
            choices.append([(0.0, None), *self.lists[t]])
        picks = list(itertools.product(*choices))
        sums = sorted((sum(c[0] for c in pick), i) for i, pick in enumerate(picks) if i)[:n]
        return [{"loss": s, "edits": [
            {"at": int(till[u] - till[a]), "drop": int(till[u + 1] - till[u]), "ids": c[1]}
            for u, c in sorted(zip(near, picks[i]), key=lambda x: x[0]) if c[1] is not None]} for s, i in sums]


_EDITS = pa.list_(pa.struct([("loss", pa.float64()), ("edits", pa.list_(pa.struct(
    [("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))
_OUT = ("ids array<int>, score double, others array<struct<loss:double,edits:array<struct<at:int,drop:int,"
        "ids:array<int>>>>>, round_trip boolean")


def encode(docs: DataFrame, text_col: str = "text", n: int = 4, model_file: str = MODEL,
           model_scores: bool = False) -> DataFrame:
    """The input's columns but the text, and ids (the best segmentation), its
    score, others (the next ``n`` - 1: the loss against the best, and the edits: at the
    ``at``-th piece, ``drop`` pieces replaced by ``ids``), round_trip (the ids decode to
    the text)."""
    # Plain arrays and lists: workers need not have the package.
    share = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(model_file, model_scores)))
    new = ("ids", "score", "others", "round_trip")
    kept = [c for c in docs.columns if c != text_col and c not in new]
    row = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        made = None
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                made = made or Segmenter(Vocabulary(**share.value), n)
                got = made.segment(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(got["off"].astype(np.int32)), pa.array(got["ids"])),
                     pa.array(got["score"]), pa.array(got["others"], _EDITS), pa.array(got["good"])],
                    names=["row", "ids", "score", "others", "round_trip"])

    kind = row.schema["row"].dataType.simpleString()
    out = row.mapInArrow(run, f"row {kind}, {_OUT}")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *new)


def decode(rows: DataFrame, ids_col: str = "ids", out_col: str = "text", model_file: str = MODEL) -> DataFrame:
    """The input's columns and the text that the ids spell (null ids: null; bytes
    that are no UTF-8 become replacement characters)."""
    v = read_vocabulary(model_file)
    share = rows.sparkSession.sparkContext.broadcast(v.spelt)
    kept = [c for c in rows.columns if c != out_col]
    row = rows.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"),
                      F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))

    def run(batches):
        for batch in batches:
            text = []
            for ids in batch.column(1).to_pylist():
                spelt = None if ids is None else b"".join(share.value[i] for i in ids).decode("utf-8", "replace")
                text.append(spelt[1:] if spelt and spelt[0] == " " else spelt)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["row", "text"])

    kind = row.schema["row"].dataType.simpleString()
    out = row.mapInArrow(run, f"row {kind}, text string")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], F.col("text").alias(out_col))
