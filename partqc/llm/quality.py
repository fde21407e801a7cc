"""Quality classifier by positive-unlabelled learning.

Texts marked good are trusted positives; a sample of the web at large, marked
or not, is the unlabelled part, in which ``prior`` of the texts are good.  The
model minimises the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss l, by full-batch Adam steps that turn back where the
second term goes below zero.  The marks of bad texts are not used.  The prior
is estimated from the same two samples: a first classifier of P against U,
fitted on one half and read on the other and the other way round, sorts the
texts, and the least ratio of U's share to P's share above any cut (with a
quarter of P above it at least, as a smaller share is noise) bounds the share of
good texts in U; the ratio is smallest where no bad text is left.

Inputs of a score are statistics of the text alone: mix of byte classes,
entropy, word lengths, repeated words and word sequences.  Each statistic is cut
into quantile bins, one weight per bin, so the model is additive and a text's
score does not depend on other texts.

Fitting uses at most ``most`` different rows of each part (a documented bound; the
ones with the smallest hash of their id, then of their text, so any partitioning
gives the same sample, and rows that repeat an id, however many, do not raise what
the driver gets); scoring runs over all rows in Arrow batches, with memory bounded by the batch.

Nulls and oddities: a null or empty text is scored by its (all zero)
statistics; a null label is no label; rows that repeat an id are scored each;
an id marked both good and bad counts as unmarked; a null id is never learned
from and counts as not held out; without a positive or without unlabelled texts
every score is the prior 0.5; other columns pass through, whatever their names;
empty tables give empty results.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partqc.functions.hashing import seeded_hash
from partqc.llm.words import buffers, shingles, slices, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST = 8000
BINS = 16
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c",
           b"aeiouAEIOU", b".,;:?'\"()-", b"!", b"|", b"#$%&*@^~", b"<>{}[]\\_=+/`"]
N_STATS = len(CLASSES) + 9


def statistics(col: pa.Array) -> np.ndarray:
    """One row of ``N_STATS`` numbers per text."""
    off, raw = buffers(col)
    n, size = len(off) - 1, np.diff(off)
    hist = np.bincount(np.repeat(np.arange(n), size) * 256 + raw, minlength=n * 256).reshape(n, 256)
    share = hist / np.maximum(size, 1)[:, None]
    out = np.zeros((n, N_STATS))
    for j, members in enumerate(CLASSES):
        out[:, j] = share[:, list(members)].sum(1)
    j = len(CLASSES)
    out[:, j] = share[:, 128:].sum(1)
    out[:, j + 1] = -(share * np.log(np.where(share > 0, share, 1))).sum(1)
    out[:, j + 2] = out[:, 0] / np.maximum(out[:, 0] + out[:, 1], 1e-9)
    h, counts = word_hashes(col)
    sets = shingles(h, counts, 5)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    blank = share[:, [32, *range(9, 14)]].sum(1)
    out[:, j + 3] = np.log1p(counts)
    out[:, j + 4] = size * (1 - blank) / np.maximum(counts, 1)
    same = np.concatenate((h[1:] == h[:-1], [False])) if len(h) else np.zeros(0, bool)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b - a < 2:
            out[i, j + 5:j + 9] = 0, b > a, b > a, b > a
            continue
        w = np.sort(h[a:b])
        edge = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1], [True])))
        out[i, j + 5] = same[a:b - 1].mean()
        out[i, j + 6] = (len(edge) - 1) / (b - a)
        out[i, j + 7] = np.diff(edge).max() / (b - a)
        out[i, j + 8] = len(sets[i]) / max(1, b - a - 4)
    return out


@dataclass
class Model:
    """Bin borders per statistic, one weight per bin, the estimated prior."""
    borders: list
    weights: np.ndarray
    bias: float
    prior: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Positions of the bins of every row in ``weights``."""
        return np.stack([np.searchsorted(b, x[:, j], "right") + j * (BINS + 1)
                         for j, b in enumerate(self.borders)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.bins(x)].sum(1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(bp: np.ndarray, bu: np.ndarray, size: int, prior: float, steps: int, rate: float, l2: float,
             non_negative: bool) -> tuple[np.ndarray, float]:
    """Weights and bias after Adam on the risk over binned P and U rows; without
    ``non_negative`` the plain logistic risk of P against U."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)

    def gradient(bins, slope):
        g = np.bincount(bins.ravel(), np.repeat(slope, bins.shape[1]), minlength=size + 1)
        g[size] = slope.sum()
        return g / len(bins)

    for t in range(1, steps + 1):
        zp, zu = w[bp].sum(1) + w[size], w[bu].sum(1) + w[size]
        toward, away = gradient(bp, _sigmoid(zp) - 1), gradient(bp, _sigmoid(zp))
        apart = gradient(bu, _sigmoid(zu))
        if non_negative:
            rest = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
            g = prior * toward + (apart - prior * away) if rest >= 0 else -(apart - prior * away)
        else:
            g = toward + apart
        g[:size] += l2 * w[:size]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:size], float(w[size])


def estimate_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Least ratio of U's to P's share above a cut of the scores."""
    cuts = np.quantile(sp, np.linspace(0.0, 0.75, 76))
    above = lambda s: 1 - np.searchsorted(np.sort(s), cuts, "left") / len(s)
    return float(np.clip(np.min(above(su) / np.maximum(above(sp), 1e-9)), 0.05, 0.99))


def fit(p: np.ndarray, u: np.ndarray, steps: int = 1000, rate: float = 0.15, l2: float = 1e-5) -> Model:
    """The model of positives ``p`` and unlabelled ``u`` (rows of statistics)."""
    both = np.concatenate((p, u))
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    borders = [np.unique(np.quantile(x, cuts)) if len(x) else np.zeros(0) for x in both.T]
    model = Model(borders, np.zeros(both.shape[1] * (BINS + 1)), 0.0, 0.5)
    if not len(p) or not len(u):
        return model
    bp, bu = model.bins(p), model.bins(u)
    priors = []
    for a, b in ((0, 1), (1, 0)):
        if min(len(p), len(u)) > 1:
            w, _ = _descend(bp[a::2], bu[a::2], len(model.weights), 0.5, 200, 0.05, 1e-3, False)
            priors.append(estimate_prior(w[bp[b::2]].sum(1), w[bu[b::2]].sum(1)))
    model.prior = float(np.mean(priors)) if priors else 0.5
    model.weights, model.bias = _descend(bp, bu, len(model.weights), model.prior, steps, rate, l2, True)
    return model


def in_fold(id_: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold`` of ``folds``; false for null."""
    return F.coalesce(F.crc32(id_.cast("string")) % folds == fold, F.lit(False))


def _rows_of(docs: DataFrame, wanted: DataFrame, most: int) -> list:
    """Statistics of the texts of ``wanted`` (id, part, h), a bounded set of ids:
    of each part the first ``most`` different rows by h, id and hash of the text."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                x = statistics(piece.column(1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))],
                    names=["row", "x"])

    found = docs.select(F.col("id"), "text").join(F.broadcast(wanted), "id").select(
        F.struct("part", "h", F.col("id").cast("string").alias("id"), F.xxhash64("text").alias("t")).alias("row"), "text")
    rows = found.mapInArrow(run, "row struct<part:int,h:string,id:string,t:bigint>, x array<double>")
    each = rows.groupBy("row").agg(F.first("x").alias("x"))
    return [r for part in (0, 1) for r in
            each.filter(F.col("row.part") == part).orderBy("row").limit(most).select("row.part", "x").collect()]


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int,
          most: int, seed: int = 4) -> Model:
    """The model from ``most`` documents marked 1 and ``most`` of any kind,
    neither from the held-out fold."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(
        F.col("id").isNotNull() & ~in_fold(F.col("id"), folds, held))
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~in_fold(F.col("id"), folds, held))
             .groupBy("id").agg(F.min("y").alias("y")).filter("y = 1").select("id"))

    def least(ids: DataFrame, part: int) -> DataFrame:
        return (ids.withColumn("h", seeded_hash(f"{seed}/{part}", "id")).orderBy("h", "id").limit(most)
                .select("id", F.lit(part).alias("part"), "h"))

    wanted = least(marks.join(d.select("id"), "id", "left_semi"), 1).union(least(d.select("id").distinct(), 0))
    rows = _rows_of(d, wanted, most)
    x = {part: np.array(sorted(r["x"] for r in rows if r["part"] == part)).reshape(-1, N_STATS) for part in (0, 1)}
    return fit(x[1], x[0])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", folds: int = 5, held: int = 0, most: int = MOST,
                  cut: float = 0.3) -> DataFrame:
    """The input's columns and held_out, score (0 to 1) and predicted (1 from
    ``cut`` on)."""
    model = learn(docs, labels, id_col, text_col, label_col, folds, held, most)
    share = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays: workers need not have the package
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        model = Model(**share.value)
        for batch in batches:
            for piece in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(model.score(statistics(piece.column(1))))], names=["row", "score"])

    kind = row.select("row").schema.simpleString()
    scored = row.mapInArrow(run, f"{kind[len('struct<'):-1]},score:double")
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in kept],
                         in_fold(F.col(f"row.`{id_col}`"), folds, held).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
