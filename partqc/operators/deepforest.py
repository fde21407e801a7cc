"""Random forests grown to full depth (M3, M4), with the trees as a table.

A tree grown until its leaves are pure has about as many nodes as rows, and
Spark ML keeps the nodes of all trees on the driver and makes one pass over the
rows per group of nodes. Here only the upper nodes, those with more than
``block`` rows, are found that way; the rest is grown where its rows are.

1. Features are cut into at most ``max_bins`` bins at thresholds of a sample of
   at least 10,000 rows, as Spark ML does. Rows alike in bins and label become
   one row with a count ``n``; its weight in each tree is drawn once, Poisson(n),
   the sum of the Poisson(1) draws of the rows it stands for.
2. While a node has more than ``block`` of these rows: one pass adds up the
   histograms of all such nodes, a grouped job picks their best splits, and the
   driver keeps one split per node (at most trees x rows / block nodes a level).
3. The rows of all smaller nodes are dealt by (tree, node), small nodes of a tree
   together up to ``block`` rows, and every group grows its nodes to the end and
   writes them as one row of the model.
4. Scoring routes the distinct binned rows through the upper nodes, joins them with
   the groups' rows, and adds up the leaves' probabilities per binned row in
   units of 2^-52, so that the order of the sum does not matter.

Weights come from a hash of the row, feature subsets from a hash of tree and node:
the forest depends neither on the partitioning nor on ``block``. Splits, the stop
rules, the merging of leaves that predict the same class and the probabilities
are Spark ML's; the random numbers are not.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Task functions travel by value: workers need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 65_536
#: Nodes whose histograms one pass adds up.
_NODES_PER_PASS = 4_096
_SAMPLE_ROWS = 10_000
_UNIT = float(1 << 52)
_SPLIT, _LEAF, _SUBTREE, _ACTIVE = 0, 1, 2, 3
_NODES = "g int, tree int, root_id binary, feature binary, bin binary, left binary, p binary"


# ---------------------------------------------------------------- thresholds and bins
def thresholds(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Split points of one feature: between all distinct values if these fit into
    ``max_bins``, else midpoints at about equal numbers of rows."""
    v, c = np.unique(values, return_counts=True)
    if len(v) <= max_bins:
        return (v[:-1] + v[1:]) / 2
    stride, out, seen, target = len(values) / max_bins, [], int(c[0]), len(values) / max_bins
    for i in range(1, len(v)):
        before, seen = seen, seen + int(c[i])
        if abs(before - target) < abs(seen - target):
            out.append((v[i - 1] + v[i]) / 2)
            target += stride
    return np.array(out)


def _to_bins(x: np.ndarray, cuts: list) -> np.ndarray:
    """Bin of every value: the number of thresholds below it."""
    out = np.empty(x.shape, np.uint8)
    for j, t in enumerate(cuts):
        out[:, j] = np.searchsorted(t, x[:, j])
    return out


def _blobs(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a 2-dimensional array."""
    width = rows.shape[1] * rows.itemsize
    at = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows),
                                 [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    arr = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).cast(pa.binary())
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    off = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
    return np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def _bin_rows(col) -> np.ndarray:
    data, off = _flat(col)
    return data.reshape(len(off) - 1, -1) if len(off) > 1 else np.zeros((0, 0), np.uint8)


def _weights(col, trees: int) -> np.ndarray:
    """Weights per row and tree: a byte each, or four where one exceeds a byte."""
    data, off = _flat(col)
    size = np.diff(off)
    if (size == trees).all():
        return data.reshape(-1, trees).astype(np.int64)
    return np.array([np.frombuffer(data[a:b].tobytes(), np.uint8 if b - a == trees else np.int32)
                     for a, b in zip(off[:-1], off[1:])], np.int64).reshape(-1, trees)


def _draw(trees: int):
    """Poisson(n) per row and tree, seeded by the row's hash."""
    def run(batches):
        for b in batches:
            out = []
            for seed, n in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                w = np.random.Generator(np.random.Philox(key=seed & (2 ** 64 - 1))).poisson(n, trees)
                out.append(w.astype(np.uint8 if w.max() < 256 else np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["b", "y", "w"])
    return run


# ---------------------------------------------------------------- splits
def _impurity(kind: str, c0, c1):
    n = np.maximum(c0 + c1, 1)
    p, q = c1 / n, c0 / n
    if kind == "gini":
        return 1 - p * p - q * q
    return -(p * np.log2(np.where(p > 0, p, 1)) + q * np.log2(np.where(q > 0, q, 1)))


def feature_subsets(ids: np.ndarray, tree: int | np.ndarray, dims: int, size: int, seed: int) -> np.ndarray:
    """``size`` feature numbers per node, ascending, by a hash of seed, tree, node and feature."""
    with np.errstate(over="ignore"):
        z = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
             + np.asarray(tree).astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))[:, None]
        z = z ^ (np.arange(1, dims + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(mul)
        z = z ^ (z >> np.uint64(31))
    return np.sort(np.argsort(z, axis=1, kind="stable")[:, :size], axis=1)


def best_splits(slot, s, bin_, c0, c1, t0, t1, kind: str, least: int):
    """Best split per slot from its non-empty cells, sorted by (slot, s, bin):
    (gain, s, bin, left c0, left c1), ties to the first cell."""
    head = np.r_[True, (slot[1:] != slot[:-1]) | (s[1:] != s[:-1])]
    start, part = np.flatnonzero(head), np.cumsum(head) - 1

    def upto(c):
        total = np.cumsum(c)
        return total - (total - c)[start][part]

    l0, l1 = upto(c0), upto(c1)
    a0, a1 = t0[slot], t1[slot]
    r0, r1 = a0 - l0, a1 - l1
    nl, nr = l0 + l1, r0 + r1
    n = nl + nr
    gain = _impurity(kind, t0, t1)[slot] - nl / n * _impurity(kind, l0, l1) - nr / n * _impurity(kind, r0, r1)
    gain = np.where((nl >= least) & (nr >= least), gain, -np.inf)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    best = np.maximum.reduceat(gain, first)
    at = np.minimum.reduceat(np.where(gain == best[slot], np.arange(len(gain)), len(gain)), first)
    return best, s[at], bin_[at], l0[at], l1[at]


_LEAST_GAIN = 1e-14  # below: rounding


def grow(bins, y, w, slot, ids, tree: int, p: dict):
    """Grow the nodes ``ids`` (heap numbers) of one tree to the end, all nodes of a level at
    once; ``slot`` tells a row's node. Returns feature (-1: leaf), bin, left (the right child
    follows the left one) and share of class 1 per node, the first ``len(ids)`` being ``ids``."""
    dims, size, max_bins = bins.shape[1], p["subset"], p["max_bins"]
    depth = np.array([int(i).bit_length() - 1 for i in ids])
    levels, base, rows = [], 0, np.arange(len(y))
    while len(ids):
        k = len(ids)
        t1 = np.bincount(slot, w[rows] * y[rows], k)
        t0 = np.bincount(slot, w[rows] * (1 - y[rows]), k)
        feature, cut, left = np.full(k, -1, np.int16), np.zeros(k, np.uint8), np.zeros(k, np.int32)
        levels.append((feature, cut, left, t0, t1, base))
        can = (t0 > 0) & (t1 > 0) & (depth < p["max_depth"])
        open_ = np.flatnonzero(can)
        if not len(open_):
            break
        number = np.cumsum(can) - 1
        keep = can[slot]
        rows, mine = rows[keep], number[slot[keep]]
        subset = feature_subsets(ids[open_], tree, dims, size, p["seed"])
        code = (((mine * size)[:, None] + np.arange(size)) * max_bins + bins[rows[:, None], subset[mine]]).ravel()
        order = np.argsort(code)
        code = code[order]
        head = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        cell, ww, yy = code[head], np.repeat(w[rows], size)[order], np.repeat(y[rows], size)[order]
        c1 = np.add.reduceat(ww * yy, head)
        c0 = np.add.reduceat(ww * (1 - yy), head)
        gain, s, b, _, _ = best_splits(cell // (size * max_bins), cell // max_bins % size, cell % max_bins,
                                       c0, c1, t0[open_], t1[open_], p["impurity"], p["least"])
        split = gain > _LEAST_GAIN
        feature[open_[split]] = subset[np.arange(len(open_)), s][split]
        cut[open_[split]] = b[split]
        child = np.cumsum(split) - 1
        left[open_[split]] = base + k + 2 * child[split]
        stay = split[mine]
        rows, mine = rows[stay], mine[stay]
        goes = bins[rows, subset[mine, s[mine]]] > b[mine]
        slot = 2 * child[mine] + goes
        parents = open_[split]
        ids = np.repeat(2 * ids[parents], 2) + np.tile([0, 1], len(parents))
        depth = np.repeat(depth[parents] + 1, 2)
        base += k
    feature, cut, left, t0, t1 = (np.concatenate([lv[i] for lv in levels]) for i in range(5))
    share = t1 / np.maximum(t0 + t1, 1)
    for lv in reversed(levels):  # leaves of one parent that predict the same class
        at = lv[5] + np.flatnonzero(lv[0] >= 0)
        l = left[at]
        same = (feature[l] < 0) & (feature[l + 1] < 0) & ((share[l] > 0.5) == (share[l + 1] > 0.5))
        feature[at[same]] = -1
    kept = np.zeros(len(feature), bool)
    kept[:len(levels[0][0])] = True
    for lv in levels:
        at = lv[5] + np.arange(len(lv[0]))
        at = at[kept[at] & (feature[at] >= 0)]
        kept[left[at]] = kept[left[at] + 1] = True
    to = np.cumsum(kept) - 1
    return feature[kept], cut[kept], np.where(feature >= 0, to[left], 0)[kept].astype(np.int32), share[kept]


# ---------------------------------------------------------------- upper nodes
class Upper:
    """The nodes above the groups, all trees in one list (node ``t`` is the root of
    tree ``t``; the right child follows the left one)."""

    def __init__(self, trees: int, active: bool):
        self.tree, self.id = np.arange(trees), np.ones(trees, np.int64)
        self.feature, self.bin = np.full(trees, -1, np.int32), np.zeros(trees, np.int32)
        self.left, self.p = np.zeros(trees, np.int64), np.zeros(trees)
        self.state = np.full(trees, _ACTIVE if active else _SUBTREE)
        self.rows, self.g = np.zeros(trees, np.int64), np.full(trees, -1)

    def add(self, **columns):
        for name, values in columns.items():
            setattr(self, name, np.concatenate([getattr(self, name), values]))

    def route(self, bins: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Last upper node of every (row, tree); ``at`` starts as the tree's number."""
        at = at.copy()
        go = np.flatnonzero(self.feature[at] >= 0)
        while len(go):
            a = at[go]
            at[go] = self.left[a] + (bins[row[go], self.feature[a]] > self.bin[a])
            go = go[self.feature[at[go]] >= 0]
        return at

    def bundle(self, block: int) -> int:
        """Number the groups: nodes of one tree, up to ``block`` rows together."""
        g, tree, held = -1, -1, 0
        for i in sorted(np.flatnonzero(self.state == _SUBTREE), key=lambda i: (self.tree[i], i)):
            if self.tree[i] != tree or held + self.rows[i] > block:
                g, tree, held = g + 1, self.tree[i], 0
            self.g[i] = g
            held += self.rows[i]
        return g + 1

    def prune(self):
        """Merge leaves of one parent that predict the same class."""
        for i in range(len(self.tree) - 1, -1, -1):
            if self.state[i] == _SPLIT:
                a, b = self.left[i], self.left[i] + 1
                if self.state[a] == self.state[b] == _LEAF and (self.p[a] > 0.5) == (self.p[b] > 0.5):
                    self.state[i], self.feature[i] = _LEAF, -1


def _histograms(upper: Upper, active: np.ndarray, trees: int, p: dict, subset: np.ndarray):
    """Per task and active node: weights of the classes and rows per (feature of the subset, bin)."""
    slot_of = np.full(len(upper.tree), -1)
    slot_of[active] = np.arange(len(active))
    size, max_bins = p["subset"], p["max_bins"]

    def run(batches):
        total = np.zeros(len(active) * size * max_bins * 3)
        for batch in batches:
            bins, y, w = _bin_rows(batch.column(0)), batch.column(1).to_numpy(), _weights(batch.column(2), trees)
            if not len(y):
                continue
            row, tree = np.nonzero(w)
            slot = slot_of[upper.route(bins, row, tree)]
            ok = slot >= 0
            row, slot, weight = row[ok], slot[ok], w[row[ok], tree[ok]]
            for s in range(size):
                cell = ((slot * size + s) * max_bins + bins[row, subset[slot, s]]) * 3
                top = int(cell.max(initial=-3)) + 3
                total[:top] += (np.bincount(cell + y[row], weight, top) + np.bincount(cell + 2, None, top))
        hist = total.reshape(len(active), -1)
        some = np.flatnonzero(hist.any(axis=1))
        for i in range(0, len(some), 256):
            yield pa.RecordBatch.from_arrays([pa.array(some[i:i + 256].astype(np.int32)), _blobs(hist[some[i:i + 256]])],
                                             ["slot", "h"])
    return run


def _choose(p: dict):
    """Best split of one node from the tasks' histograms."""
    def run(table: pa.Table) -> pa.Table:
        data, _ = _flat(table.column("h"))
        h = np.frombuffer(data.tobytes()).reshape(len(table), -1).sum(0).reshape(p["subset"], p["max_bins"], 3)
        t0, t1, rows = h[0].sum(0)
        s, b = np.nonzero(h[:, :, 2])
        gain, bs, bb, l0, l1 = best_splits(np.zeros(len(s), int), s, b, h[s, b, 0], h[s, b, 1], np.array([t0]),
                                           np.array([t1]), p["impurity"], p["least"])
        left_rows = h[bs[0], :bb[0] + 1, 2].sum()
        return pa.table({"slot": table.column("slot").slice(0, 1).cast(pa.int32()), "gain": pa.array(gain),
                         "s": pa.array(bs.astype(np.int32)), "bin": pa.array(bb.astype(np.int32)),
                         **{k: pa.array([float(v)]) for k, v in (("t0", t0), ("t1", t1), ("l0", l0[0]), ("l1", l1[0]),
                                                                 ("rows", rows), ("left_rows", left_rows))}})
    return run


def _grow_upper(rows: DataFrame, upper: Upper, trees: int, dims: int, block: int, p: dict):
    """Split nodes of more than ``block`` rows, a level at a time."""
    found = "slot int, gain double, s int, bin int, " + ", ".join(
        f"{c} double" for c in ("t0", "t1", "l0", "l1", "rows", "left_rows"))
    while (level := np.flatnonzero(upper.state == _ACTIVE)).size:
        for i in range(0, len(level), _NODES_PER_PASS):
            active = level[i:i + _NODES_PER_PASS]
            subset = feature_subsets(upper.id[active], upper.tree[active], dims, p["subset"], p["seed"])
            task = _histograms(upper, active, trees, p, subset)
            got = (rows.select("b", "y", "w").mapInArrow(task, "slot int, h binary")
                   .groupBy("slot").applyInArrow(_choose(p), found)).collect()
            upper.state[active], upper.p[active] = _LEAF, 0.5  # if it drew no row
            for r in sorted(got, key=lambda r: r["slot"]):
                at = active[r["slot"]]
                t0, t1, l0, l1 = r["t0"], r["t1"], r["l0"], r["l1"]
                upper.p[at], upper.rows[at] = t1 / (t0 + t1), int(r["rows"])
                depth = int(upper.id[at]).bit_length() - 1
                # A root may hold no more rows than a group takes.
                if r["rows"] <= block:
                    upper.state[at] = _SUBTREE
                    continue
                if not (t0 and t1) or r["gain"] <= _LEAST_GAIN or depth >= p["max_depth"]:
                    upper.state[at] = _LEAF
                    continue
                upper.state[at], upper.left[at] = _SPLIT, len(upper.tree)
                upper.feature[at], upper.bin[at] = subset[r["slot"], r["s"]], r["bin"]
                kids = ((l0, l1, r["left_rows"]), (t0 - l0, t1 - l1, r["rows"] - r["left_rows"]))
                state = [_LEAF if not (a and b) or depth + 1 >= p["max_depth"] else _SUBTREE if n <= block else _ACTIVE
                         for a, b, n in kids]
                upper.add(tree=[upper.tree[at]] * 2, id=np.array([2 * upper.id[at], 2 * upper.id[at] + 1]),
                          feature=np.full(2, -1, np.int32), bin=np.zeros(2, np.int32), left=np.zeros(2, np.int64),
                          p=np.array([b / (a + b) for a, b, _ in kids]), state=np.array(state),
                          rows=np.array([int(n) for *_, n in kids]), g=np.full(2, -1))


# ---------------------------------------------------------------- groups
def _deal(upper: Upper, trees: int):
    """Rows of the groups: one per row and tree that holds it."""
    def run(batches):
        for batch in batches:
            bins, w = _bin_rows(batch.column(0)), _weights(batch.column(2), trees)
            for t in range(trees):
                row = np.flatnonzero(w[:, t])
                at = upper.route(bins, row, np.full(len(row), t))
                ok = upper.g[at] >= 0
                row, at = row[ok], at[ok]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(upper.g[at].astype(np.int32)), pa.array(np.full(len(row), t, np.int32)), pa.array(upper.id[at]),
                     batch.column(1).take(pa.array(row)), pa.array(w[row, t]), _blobs(bins[row])],
                    ["g", "tree", "id", "y", "w", "b"])
    return run


def _grow_group(p: dict):
    def run(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        ids, slot = np.unique(table.column("id").to_numpy(), return_inverse=True)
        nodes = grow(_bin_rows(table.column("b")), table.column("y").to_numpy().astype(np.int64),
                     table.column("w").to_numpy(), slot, ids, tree, p)
        feature, cut, left, share = nodes
        return pa.table({"g": table.column("g").slice(0, 1), "tree": pa.array([tree], pa.int32()),
                         **{k: pa.array([v.tobytes()], pa.binary()) for k, v in
                            (("root_id", ids), ("feature", feature), ("bin", cut), ("left", left), ("p", share))}})
    return run


def _single_leaves(batches):
    """Nodes of the groups that are one leaf."""
    for b in batches:
        for i in range(len(b)):
            get = lambda c, dtype: np.frombuffer(b.column(c)[i].as_py(), dtype)
            ids = get(2, np.int64)
            at = np.flatnonzero(get(3, np.int16)[:len(ids)] < 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b.column(1)[i].as_py(), np.int32)),
                                              pa.array(ids[at]), pa.array(get(6, np.float64)[at])], ["tree", "id", "p"])


# ---------------------------------------------------------------- scoring
def _group_sizes(upper: Upper, trees: int):
    def run(batches):
        count = np.zeros(int(upper.g.max(initial=-1)) + 1, np.int64)
        for batch in batches:
            bins = _bin_rows(batch.column(0))
            row = np.repeat(np.arange(len(bins)), trees)
            g = upper.g[upper.route(bins, row, np.tile(np.arange(trees), len(bins)))]
            count += np.bincount(g[g >= 0], minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], ["g", "n"])
    return run


def _ask(upper: Upper, trees: int, parts: np.ndarray, spread: int):
    """Per binned row: its sum over the leaves among the upper nodes (g -1), if there are any,
    and a row for every group it comes to; groups of many rows in parts."""
    def run(batches):
        for batch in batches:
            bins = _bin_rows(batch.column(0))
            n, h = len(bins), batch.column(1).to_numpy()
            total = np.zeros(n, np.int64)
            for t in range(trees):
                at = upper.route(bins, np.arange(n), np.full(n, t))
                total += np.where(upper.g[at] < 0, np.round(upper.p[at] * _UNIT), 0).astype(np.int64)
                row = np.flatnonzero(upper.g[at] >= 0)
                g = upper.g[at[row]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.astype(np.int32)), pa.array((h[row] % parts[g]).astype(np.int32)), pa.array(upper.id[at[row]]),
                     pa.array(np.zeros(len(row), np.int64)), _blobs(bins[row])], ["g", "part", "id", "v", "b"])
            if (upper.state == _LEAF).any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, -1, np.int32)), pa.array((h % spread).astype(np.int32)),
                                                  pa.array(np.zeros(n, np.int64)), pa.array(total), _blobs(bins)],
                                                 ["g", "part", "id", "v", "b"])
    return run


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Cogroup body: the asking rows' shares of class 1 from their group's nodes; without
    nodes (g -1) the sums as they are."""
    if not len(left):
        return pa.table({"b": pa.array([], pa.binary()), "v": pa.array([], pa.int64())})
    if not len(right):
        return pa.table({"b": left.column("b"), "v": left.column("v")})
    get = lambda c, dtype: np.frombuffer(right.column(c)[0].as_py(), dtype)
    ids, feature, cut, child, share = (get("root_id", np.int64), get("feature", np.int16), get("bin", np.uint8),
                                       get("left", np.int32), get("p", np.float64))
    bins = _bin_rows(left.column("b"))
    at = np.searchsorted(ids, left.column("id").to_numpy())
    go = np.flatnonzero(feature[at] >= 0)
    while len(go):
        a = at[go]
        at[go] = child[a] + (bins[go, feature[a]] > cut[a])
        go = go[feature[at[go]] >= 0]
    return pa.table({"b": left.column("b"), "v": pa.array(np.round(share[at] * _UNIT).astype(np.int64))})


class DeepForestModel:
    """``nodes`` is the table of the groups' nodes, ``upper`` the nodes above them."""

    def __init__(self, nodes: DataFrame, upper: Upper, cuts: list, forest: DeepForest):
        self.nodes, self.upper, self.cuts, self.forest = nodes, upper, cuts, forest

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``rawPrediction, probability, prediction``, as Spark ML's forest does."""
        f, trees = self.forest, self.forest.getNumTrees()
        binned = df.withColumn("_b", _binner(self.cuts)(vector_to_array(f.features_col)))
        rows = materialize(binned.select(F.col("_b").alias("b")).distinct().repartition(f.spread(df), "b")
                           .withColumn("h", F.abs(F.xxhash64("b") % (1 << 30)).cast("int")))
        sizes = rows.select("b").mapInArrow(_group_sizes(self.upper, trees), "g int, n long")
        parts = np.ones(int(self.upper.g.max(initial=-1)) + 1, np.int64)
        for r in sizes.groupBy("g").agg(F.sum("n").alias("n")).collect():
            parts[r["g"]] = math.ceil(r["n"] / f.block)
        asked = rows.mapInArrow(_ask(self.upper, trees, parts, f.spread(df)), "g int, part int, id long, v long, b binary")
        number = F.element_at(F.array(*[F.lit(int(n)) for n in parts]), F.col("g") + 1) if len(parts) else F.lit(1)
        if (parts > 1).any():
            nodes = self.nodes.withColumn("part", F.explode(F.sequence(F.lit(0), (number - 1).cast("int"))))
        else:
            nodes = self.nodes.withColumn("part", F.lit(0))
        n = f.tasks(df, int(parts.sum()))
        found = (asked.repartition(n, "g", "part").groupBy("g", "part")
                 .cogroup(nodes.repartition(n, "g", "part").groupBy("g", "part"))
                 .applyInArrow(_answer, "b binary, v long"))
        sums = (found.groupBy("b")
                .agg((F.sum("v") / F.lit(trees * _UNIT)).alias("_p")).withColumnRenamed("b", "_b"))
        p = F.col("_p")
        return (binned.join(materialize(sums), "_b")
                .withColumn("rawPrediction", array_to_vector(F.array((1 - p) * trees, p * trees)))
                .withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("_b", "_p"))


def _binner(cuts: list):
    @F.arrow_udf("binary")
    def to_bins(x: pa.Array) -> pa.Array:
        return _blobs(_to_bins(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), cuts))
    return to_bins


class DeepForest:
    """Two-class forest of ``num_trees`` trees grown to ``max_depth`` on square-root feature
    subsets. ``block`` bounds the rows of a group; the trees do not depend on it."""

    def __init__(self, label: str, features_col: str, impurity: str, seed: int, num_trees: int, max_depth: int,
                 min_instances_per_node: int, max_bins: int = 32, block: int = BLOCK):
        if impurity not in ("gini", "entropy"):
            raise ValueError("impurity must be 'gini' or 'entropy'")
        self.label, self.features_col, self.impurity, self.seed = label, features_col, impurity, seed
        self.num_trees, self.max_depth, self.least = num_trees, max_depth, min_instances_per_node
        self.max_bins, self.block = max_bins, block

    def getNumTrees(self) -> int:
        return self.num_trees

    def getMaxDepth(self) -> int:
        return self.max_depth

    def getMinInstancesPerNode(self) -> int:
        return self.least

    def getImpurity(self) -> str:
        return self.impurity

    def tasks(self, df: DataFrame, groups: int) -> int:
        return max(1, min(groups, 64 * df.sparkSession.sparkContext.defaultParallelism))

    def spread(self, df: DataFrame) -> int:
        """Tasks for work in Python on few bytes a row, where Spark would use few."""
        return 4 * df.sparkSession.sparkContext.defaultParallelism

    def thresholds(self, rows: DataFrame, n: int) -> list:
        """Split points of every feature, from at least 10,000 rows."""
        fraction = max(self.max_bins ** 2, _SAMPLE_ROWS) / n
        sample = rows.select("x") if fraction >= 1 else rows.select("x").sample(False, fraction, self.seed)
        x = np.array([r["x"] for r in sample.collect()], float)
        return [thresholds(x[:, j], self.max_bins) for j in range(x.shape[1])]

    def rows_key(self) -> tuple:
        """Forests of one key have the same thresholds and draws on the same rows."""
        return self.label, self.features_col, self.seed, self.num_trees, self.max_bins

    def prepare(self, train: DataFrame) -> tuple[list, DataFrame]:
        """Thresholds, and the rows alike in bins and label with their weights in all trees.
        Impurity and stop rules play no part: forests of one ``rows_key`` can share these."""
        rows = train.select(vector_to_array(self.features_col).alias("x"), F.col(self.label).cast("int").alias("y"))
        got = rows.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(~F.coalesce(F.col("y").isin(0, 1), F.lit(False))).alias("bad")).first()
        if not got["n"] or got["bad"]:
            raise ValueError(f"forest: {got['n']} rows, {got['bad']} of them without a label 0 or 1")
        cuts = self.thresholds(rows, got["n"])
        alike = (rows.select(_binner(cuts)("x").alias("b"), "y").groupBy("b", "y").agg(F.count(F.lit(1)).alias("n"))
                 .repartition(self.spread(train), "b", "y"))
        return cuts, materialize(alike.select("b", "y", F.xxhash64("b", "y", F.lit(self.seed)).alias("seed"), "n")
                                 .mapInArrow(_draw(self.num_trees), "b binary, y int, w binary"))

    def fit(self, train: DataFrame, prepared: tuple[list, DataFrame] | None = None) -> DeepForestModel:
        """``prepared``: what ``prepare`` gave for these rows, if it is there already."""
        cuts, drawn = prepared or self.prepare(train)
        dims, trees = len(cuts), self.num_trees
        p = {"subset": math.ceil(math.sqrt(dims)), "max_bins": self.max_bins, "max_depth": self.max_depth,
             "least": max(1, self.least), "impurity": self.impurity, "seed": self.seed}
        n = drawn.count()
        upper = Upper(trees, n > self.block)
        _grow_upper(drawn, upper, trees, dims, self.block, p)
        groups = upper.bundle(self.block)
        dealt = drawn.mapInArrow(_deal(upper, trees), "g int, tree int, id long, y int, w long, b binary")
        nodes = materialize(dealt.repartition(self.tasks(train, groups), "g").groupBy("g")
                            .applyInArrow(_grow_group(p), _NODES))
        at = {(int(t), int(i)): j for j, (t, i) in enumerate(zip(upper.tree, upper.id))}
        for r in nodes.mapInArrow(_single_leaves, "tree int, id long, p double").collect():
            j = at[r["tree"], r["id"]]
            upper.state[j], upper.g[j], upper.p[j] = _LEAF, -1, r["p"]
        empty = np.flatnonzero(upper.state == _SUBTREE)
        if n <= self.block:  # trees that drew no row at all
            met = {r["tree"] for r in nodes.select("tree").distinct().collect()}
            for j in (j for j in empty if upper.tree[j] not in met):
                upper.state[j], upper.g[j], upper.p[j] = _LEAF, -1, 0.5
        upper.prune()
        return DeepForestModel(nodes, upper, cuts, self)
