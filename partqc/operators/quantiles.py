"""Column profiles and exact quantiles in a bounded number of passes.

*Sketch pass.* Every task runs once over its Arrow batches and keeps, per column,
count, mean, squared deviations, range and a mergeable quantile sketch: levels of
values of weight 1, 2, 4, ...; a level of ``2 * size`` values is sorted and every
second value goes up one level, which loses at most the level's weight in any
rank. The losses are added up, so a sketch knows its error: the number of values
at or below ``v`` lies between the weight at or below ``v`` and that plus
``err``. Sketches of tasks are merged in two steps (``FAN`` tasks, then all).
No row is exploded; what is shuffled is a few thousand numbers per task and column.

*Brackets.* The error bounds bracket every wanted rank of every column at once by
two values of the sketch.

*Exact pass.* The values inside the brackets are counted by distinct value (map-
side), those below are only counted, and the wanted ranks are read off. While a
bracket may hold more than ``max_candidates`` values between its ends, another
sketch pass over the values inside narrows it; a pass divides the values by about
``size / log2(n / size)``, so two passes do up to some 10 million rows and three
some 10 billion, whatever the number of columns. A heavy value ends as an end of
its bracket and costs nothing.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Task functions travel by value: workers need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 2048
FAN = 64
_ROW = ("rid int, slot int, n long, below long, s double, s_low double, mean double, m2 double, lo double, hi double, err long, "
        "weights array<long>, sizes array<long>, vals binary")


class _Sketch:
    """Moments and quantile sketch of one range of one column."""

    def __init__(self):
        self.n = self.below = self.err = 0
        self.mean = self.m2 = 0.0
        self.s = np.longdouble(0)  # kept beside the running mean: its rounding does not grow with merges
        self.lo, self.hi = math.inf, -math.inf
        self.levels: dict[int, list[np.ndarray]] = {}

    def moments(self, n: int, mean: float, m2: float, lo: float, hi: float) -> None:
        if n:
            total, delta = self.n + n, mean - self.mean
            self.m2 += m2 + delta * delta * self.n * n / total
            self.mean += delta * n / total
            self.n, self.lo, self.hi = total, min(self.lo, lo), max(self.hi, hi)

    def add(self, x: np.ndarray, size: int) -> None:
        if len(x):
            with np.errstate(invalid="ignore"):
                mean = float(x.mean())
                self.moments(len(x), mean, float(((x - mean) ** 2).sum()), float(x.min()), float(x.max()))
                self.s += x.sum(dtype=np.longdouble)
            self.levels.setdefault(1, []).append(x)
            self.compress(size)

    def compress(self, size: int) -> None:
        w = 1
        while w <= max(self.levels, default=0):
            parts = self.levels.get(w, [])
            if sum(map(len, parts)) >= 2 * size:
                v = np.sort(np.concatenate(parts))
                even = len(v) - len(v) % 2
                self.levels[w] = [v[even:]] if even < len(v) else []
                self.levels.setdefault(2 * w, []).append(v[1:even:2])
                self.err += w
            w *= 2

    def merge(self, other: _Sketch) -> None:
        self.moments(other.n, other.mean, other.m2, other.lo, other.hi)
        self.below += other.below
        self.s += other.s
        self.err += other.err
        for w, parts in other.levels.items():
            self.levels.setdefault(w, []).extend(parts)

    def bracket(self, k: int) -> tuple[float, float, int]:
        """(a, b, most): the k-th value (from 0) lies in [a, b]; between the ends
        are at most ``most`` values."""
        v = np.concatenate([x for w in sorted(self.levels) for x in self.levels[w]])
        c = np.concatenate([np.full(sum(map(len, self.levels[w])), w) for w in sorted(self.levels)])
        order = np.argsort(v, kind="stable")
        v, c = v[order], c[order]
        last = np.concatenate((v[1:] != v[:-1], [True]))
        v, e = v[last], np.cumsum(c)[last]  # weight at or below every distinct value
        i = int(np.searchsorted(e + self.err, k, "right")) - 1
        j = int(np.searchsorted(e, k + 1))
        a, b = (v[i] if i >= 0 else self.lo), (v[j] if j < len(v) else self.hi)
        inner = (e[j - 1] if j > 0 else 0) - (e[i] if i >= 0 else 0)
        return float(a), float(b), 0 if a == b else int(inner) + self.err

    def row(self, rid: int, slot: int) -> dict:
        ws = [w for w in sorted(self.levels) if sum(map(len, self.levels[w]))]
        high = float(self.s)
        low = float(self.s - np.longdouble(high)) if math.isfinite(high) else 0.0
        return {"rid": rid, "slot": slot, "n": self.n, "below": self.below, "s": high, "s_low": low, "mean": self.mean, "m2": self.m2,
                "lo": self.lo, "hi": self.hi, "err": self.err, "weights": ws,
                "sizes": [sum(map(len, self.levels[w])) for w in ws],
                "vals": b"".join(x.tobytes() for w in ws for x in self.levels[w])}


def _of(row: dict) -> _Sketch:
    s = _Sketch()
    s.n, s.below, s.mean, s.m2, s.lo, s.hi, s.err = (row[c] for c in ("n", "below", "mean", "m2", "lo", "hi", "err"))
    s.s = np.longdouble(row["s"]) + np.longdouble(row["s_low"])
    flat, at = np.frombuffer(row["vals"], np.float64), 0
    for w, c in zip(row["weights"], row["sizes"]):
        s.levels[w] = [flat[at:at + c]]
        at += c
    return s


_TYPES = {"rid": pa.int32(), "slot": pa.int32(), "n": pa.int64(), "below": pa.int64(), "s": pa.float64(), "s_low": pa.float64(),
          "mean": pa.float64(), "m2": pa.float64(), "lo": pa.float64(), "hi": pa.float64(), "err": pa.int64(),
          "weights": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "vals": pa.binary()}


def _values(column) -> np.ndarray:
    x = column.to_numpy(zero_copy_only=False)
    return x[~np.isnan(x)]  # nulls come as NaN


def _inside(x: np.ndarray, a: float | None, b: float | None) -> tuple[np.ndarray, int]:
    """The values strictly between the ends, and the number up to the lower one."""
    return (x, 0) if a is None else (x[(x > a) & (x < b)], int((x <= a).sum()))


def _sketches(df: DataFrame, ranges: list[tuple], size: int) -> list[dict]:
    """One row per range (column, a, b, targets): n, below, moments, and a
    bracket per target, from one pass over ``df`` (doubles)."""
    def scan(batches):
        from pyspark import TaskContext
        slot = TaskContext.get().partitionId() // FAN
        mine = [_Sketch() for _ in ranges]
        for batch in batches:
            for s, (c, a, b, _) in zip(mine, ranges):
                x, below = _inside(_values(batch.column(c)), a, b)
                s.below += below
                s.add(x, size)
        rows = [s.row(i, slot) for i, s in enumerate(mine)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_TYPES.items())))

    def merge(table: pa.Table) -> _Sketch:
        total = _Sketch()
        for r in table.to_pylist():
            total.merge(_of(r))
            total.compress(size)
        return total

    def step(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([merge(table).row(table.column("rid")[0].as_py(), 0)], pa.schema(list(_TYPES.items())))

    def finish(table: pa.Table) -> pa.Table:
        rid, s = table.column("rid")[0].as_py(), merge(table)
        _, a, b, targets = ranges[rid]

        def bracket(k):
            k -= s.below
            return (a, a, 0) if k < 0 else (b, b, 0) if k >= s.n else s.bracket(k)

        # Targets are probabilities in the first pass, pairs of ranks later.
        ranks = [wanted(s.n, t) if isinstance(t, float) else t for t in targets if s.n or a is not None]
        found = [(k, m, *bracket(k), *bracket(m)) for k, m in ranks]
        return pa.table({"rid": pa.array([rid], pa.int32()), "n": [s.n], "below": [s.below], "mean": [float(s.s) / s.n if s.n else 0.0], "m2": [s.m2],
                         "lo": [s.lo], "hi": [s.hi],
                         "found": pa.array([[[float(v) for v in f] for f in found]], pa.list_(pa.list_(pa.float64())))})

    merged = df.mapInArrow(scan, _ROW).groupBy("rid", "slot").applyInArrow(step, _ROW)
    return [r.asDict() for r in merged.groupBy("rid").applyInArrow(
        finish, "rid int, n long, below long, mean double, m2 double, lo double, hi double, "
        "found array<array<double>>").collect()]  # a row per range


def wanted(n: int, p: float) -> tuple[int, int]:
    """The two ranks (from 0) around position ``p * (n - 1)``."""
    pos = p * (n - 1)
    return math.floor(pos), math.ceil(pos)


def column_profile(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (), size: int = SIZE,
                   max_candidates: int = 65_536) -> DataFrame:
    """``ci, n, mean, std, lo, hi, p, q`` per column and probability: count, mean,
    sample deviation, range, and the exact quantile with linear interpolation
    between closest ranks. Nulls and NaN are left out; a column without values
    keeps its rows (count 0)."""
    cols, probs = list(cols), [float(p) for p in probs]
    spark = df.sparkSession
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    first = {r["rid"]: r for r in _sketches(doubles, [(i, None, None, probs) for i in range(len(cols))], size)}
    state = {}  # (column, probability) -> (lower rank, upper rank, a, b, values between at most)
    for i, r in first.items():
        for p, (k, m, a, _, x, _, b, y) in zip(probs, r["found"]):
            state[i, p] = (int(k), int(m), a, b, 0 if a == b else int(x + y))
    # One range per column and probability; both ranks' brackets together.
    settled: set = set()  # a pass that no longer halves the bracket is the last
    while wide := [key for key, s in state.items() if s[4] > max_candidates and key not in settled]:
        found = _sketches(doubles, [(i, state[i, p][2], state[i, p][3], [state[i, p][:2]]) for i, p in wide], size)
        for r in found:
            key = wide[r["rid"]]
            k, m, a, _, x, _, b, y = r["found"][0]
            if 2 * (x + y) > state[key][4]:
                settled.add(key)
            state[key] = (int(k), int(m), a, b, 0 if a == b else int(x + y))
    basics = [(i, *((r["n"], r["mean"] if r["n"] else None, math.sqrt(r["m2"] / (r["n"] - 1)) if r["n"] > 1 else None,
                     r["lo"] if r["n"] else None, r["hi"] if r["n"] else None) if (r := first.get(i)) else (0, *[None] * 4)))
              for i in range(len(cols))]
    out = spark.createDataFrame(basics, "ci int, n long, mean double, std double, lo double, hi double").coalesce(1)
    if not probs:
        return out
    targets = [(i, p, *state.get((i, p), (0, 0, None, None, 0))[:4]) for i in range(len(cols)) for p in probs]
    open_ranges = [(i, a, b) for i, p, k, m, a, b in targets if a is not None and a < b]
    ranges = sorted(set(open_ranges))

    def collect(batches):
        below = [0] * len(ranges)
        kept: list[list] = [[] for _ in ranges]
        for batch in batches:
            for r, (c, a, b) in enumerate(ranges):
                x = _values(batch.column(c))
                below[r] += int((x < a).sum())
                x = x[(x >= a) & (x <= b)]
                kept[r].append(np.unique(x, return_counts=True))
                if sum(len(v) for v, _ in kept[r]) > 4 * max_candidates:
                    kept[r] = [_add(kept[r])]
        for r in range(len(ranges)):
            v, c = _add(kept[r])
            v, c = np.concatenate((v, [math.nan])), np.concatenate((c, [below[r]]))  # NaN holds the values below
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), r, np.int32)), pa.array(v, from_pandas=False),
                                              pa.array(c.astype(np.int64))], ["rid", "v", "cnt"])

    where = spark.createDataFrame(
        [(i, p, ranges.index((i, a, b)) if (i, a, b) in ranges else -1, k, m, p * (first[i]["n"] - 1) - k if i in first else 0.0,
          a if a == b else None) for i, p, k, m, a, b in targets],
        "ci int, p double, rid int, k long, m long, frac double, only double").coalesce(1)
    if ranges:
        counts = doubles.mapInArrow(collect, "rid int, v double, cnt long").groupBy("rid", "v").agg(F.sum("cnt").alias("cnt"))
        # At most max_candidates values and the two ends per window; NaN, the count below, goes first.
        order = Window.partitionBy("rid").orderBy((~F.isnan("v")).cast("int"), "v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.withColumn("till", F.sum("cnt").over(order)).where(~F.isnan("v"))
        hits = ranked.join(F.broadcast(where), "rid")  # columns * probabilities rows
        at = lambda k: F.max(F.when((F.col("till") > F.col(k)) & (F.col("till") - F.col("cnt") <= F.col(k)), F.col("v")))
        picked = hits.groupBy("ci", "p").agg(at("k").alias("x"), at("m").alias("y"))
        where = where.join(picked, ["ci", "p"], "left")
    else:
        where = where.withColumns({"x": F.lit(None).cast("double"), "y": F.lit(None).cast("double")})
    q = F.coalesce("only", F.col("x") + F.col("frac") * (F.col("y") - F.col("x")))
    return out.join(F.broadcast(where.select("ci", "p", q.alias("q"))), "ci")


def _add(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0), np.zeros(0, np.int64)
    v, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    u, inverse = np.unique(v, return_inverse=True)
    return u, np.bincount(inverse, c, len(u)).astype(np.int64)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], size: int = SIZE,
                    max_candidates: int = 65_536) -> DataFrame:
    """``column, prob, quantile``: exact quantiles of the columns that have values."""
    names = F.array(*[F.lit(c) for c in cols])
    return (column_profile(df, cols, probs, size, max_candidates).where("n > 0")
            .select(F.element_at(names, F.col("ci") + 1).alias("column"), F.col("p").alias("prob"), F.col("q").alias("quantile")))
