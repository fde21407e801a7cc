"""Evaluation operators (E1-E9) as Spark aggregates.

Nothing is collected to the driver: confusion counts, reports and metrics
are partial + final aggregates; ROC and AUC group by score first, keep that
table, and scan the distinct scores with the blocked running totals of ``scan``.
``by`` evaluates many scored sets at once: one job per table, grouped by it.
Divisions use ``try_divide`` (null instead of an error on an empty class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .scan import ROWS_PER_BLOCK, running_totals


def _is(c: str, v) -> Column:
    return F.col(c).cast("double") == F.lit(float(v))


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _safe_ratio(num: Column, den: Column, zero: float | None = 0.0) -> Column:
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if zero is None else F.coalesce(r, F.lit(zero))


def rmse(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Root mean squared error of prediction against label (one row)."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def confusion_cells(df: DataFrame, label: str, prediction: str = "prediction",
                    classes: Sequence[int] = (0, 1), by: Sequence[str] = ()) -> DataFrame:
    """One-row frame (one row per ``by``) with one count per (actual, predicted) cell, ``c_<a>_<p>``.
    Values outside ``classes`` and nulls fall into the cells of ``other``, so
    the cells always add up to the rows."""
    def at(c, v):
        inside = F.coalesce(F.col(c).cast("double").isin(*[float(k) for k in classes]), F.lit(False))
        return ~inside if v == "other" else F.coalesce(_is(c, v), F.lit(False))

    ends = [*classes, "other"]
    return df.groupBy(*by).agg(*[_count_if(at(label, a) & at(prediction, p)).alias(f"c_{a}_{p}") for a in ends for p in ends])


def confusion_matrix(df: DataFrame, label: str, prediction: str = "prediction",
                     classes: Sequence[int] = (0, 1), by: Sequence[str] = ()) -> DataFrame:
    """``actual, predicted, count`` for every cell of the class grid
    (empty cells are 0). Rows whose label or prediction is null or outside the
    grid are counted in cells with a null class, listed where they have rows.
    One aggregate, no join."""
    cells = confusion_cells(df, label, prediction, classes, by)
    value = lambda v: F.lit(None if v == "other" else v).cast("int")
    entries = [F.struct(value(a).alias("actual"), value(p).alias("predicted"), F.col(f"c_{a}_{p}").alias("count"))
               for a in [*classes, "other"] for p in [*classes, "other"]]
    long = cells.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
    return long.where((F.col("actual").isNotNull() & F.col("predicted").isNotNull()) | (F.col("count") > 0))


def binary_metrics(df: DataFrame, label: str, prediction: str = "prediction", positive: int = 1,
                   by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision and recall of the positive class (precision
    is 0 when nothing is predicted positive). A row with a null label or
    prediction is a wrong one."""
    y1, p1 = _is(label, positive), _is(prediction, positive)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                 _count_if(F.col(label).cast("double") == F.col(prediction).cast("double")).alias("correct"),
                                 _count_if(y1 & p1).alias("tp"), _count_if(p1).alias("pp"), _count_if(y1).alias("ap"))
    return counts.select(*by, _safe_ratio(F.col("correct"), F.col("n")).alias("accuracy"),
                         _safe_ratio(F.col("tp"), F.col("pp")).alias("precision"),
                         _safe_ratio(F.col("tp"), F.col("ap")).alias("recall"))


def score_counts(df: DataFrame, label: str, score: str, positive: int = 1,
                 decimals: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives (the only input the ROC
    and AUC scans need; a hot score value becomes one row). With
    ``decimals`` the scores are rounded first, which bounds the number of
    curve points (an approximation, like binned ROC curves)."""
    s = F.col(score).cast("double")
    if decimals is not None:
        s = F.round(s, int(decimals))
    return df.groupBy(*by, s.alias("score")).agg(
        _count_if(_is(label, positive)).alias("pos"),
        _count_if(~_is(label, positive)).alias("neg"))


def roc_curve(df: DataFrame, label: str, score: str, positive: int = 1, decimals: int | None = None,
              by: Sequence[str] = (), rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``threshold, fpr, tpr`` at every distinct score (descending), plus
    the start point ``(+inf, 0, 0)``. All points are kept; ``decimals``
    rounds the scores first to bound the number of points."""
    counts = materialize(score_counts(df, label, score, positive, decimals, by))
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = running_totals(counts, ["score"], ["pos", "neg"], by, descending=True, rows_per_block=rows_per_block)
    if by:
        cum, P, N = cum.join(totals, list(by)), F.col("P"), F.col("N")
    else:
        both = totals.select(F.struct("P", "N")).scalar()  # one subquery for both totals
        P, N = both.getField("P"), both.getField("N")
    pts = cum.select(*by, F.col("score").alias("threshold"),
                     _safe_ratio(F.col("neg_cum"), N, None).alias("fpr"),
                     _safe_ratio(F.col("pos_cum"), P, None).alias("tpr"))
    start = totals.select(*by, F.lit(float("inf")).alias("threshold"),
                          F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def roc_auc(df: DataFrame, label: str, score: str, positive: int = 1, by: Sequence[str] = (),
            rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Area under the ROC curve, ties counted half:
    ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)``."""
    counts = materialize(score_counts(df, label, score, positive, by=by))
    cum = running_totals(counts, ["score"], ["neg"], by, rows_per_block=rows_per_block)
    part = F.col("pos").cast("double") * ((F.col("neg_cum") - F.col("neg")) + F.col("neg") / 2.0)
    # In doubles: the product of two long counts overflows from about 3e9 each.
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return cum.groupBy(*by).agg(_safe_ratio(F.sum(part), pairs, None).alias("auc"))


def classification_report(df: DataFrame, label: str, prediction: str = "prediction",
                          classes: Sequence[int] = (0, 1)) -> DataFrame:
    """``class, precision, recall, f1, support`` per class, then the rows
    ``accuracy`` (in the f1 column), ``macro avg`` and ``weighted avg``.
    Computed from the one-row confusion counts; rows outside the class grid
    count as errors of the class they touch and in the accuracy's support."""
    cells = confusion_cells(df, label, prediction, classes)
    c = lambda a, p: F.col(f"c_{a}_{p}")
    ends = [*classes, "other"]
    total = sum((c(a, p) for a in ends for p in ends), F.lit(0))
    rows, prec, rec, f1, sup = [], {}, {}, {}, {}
    for k in classes:
        tp = c(k, k)
        sup[k] = sum((c(k, p) for p in ends), F.lit(0))
        pred_k = sum((c(a, k) for a in ends), F.lit(0))
        prec[k] = _safe_ratio(tp, pred_k)
        rec[k] = _safe_ratio(tp, sup[k])
        f1[k] = _safe_ratio(2 * prec[k] * rec[k], prec[k] + rec[k])
        rows.append(F.struct(F.lit(str(k)).alias("class"), prec[k].alias("precision"), rec[k].alias("recall"),
                             f1[k].alias("f1"), sup[k].cast("long").alias("support")))
    correct = sum((c(k, k) for k in classes), F.lit(0))
    n = float(len(classes))
    known = sum((sup[k] for k in classes), F.lit(0))  # rows with a label in the grid
    rows.append(F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), _safe_ratio(correct, total).alias("f1"),
                         total.cast("long").alias("support")))
    rows.append(F.struct(F.lit("macro avg").alias("class"),
                         (sum((prec[k] for k in classes), F.lit(0.0)) / n).alias("precision"),
                         (sum((rec[k] for k in classes), F.lit(0.0)) / n).alias("recall"),
                         (sum((f1[k] for k in classes), F.lit(0.0)) / n).alias("f1"),
                         known.cast("long").alias("support")))
    wavg = lambda m: _safe_ratio(sum((m[k] * sup[k] for k in classes), F.lit(0.0)), known)
    rows.append(F.struct(F.lit("weighted avg").alias("class"), wavg(prec).alias("precision"),
                         wavg(rec).alias("recall"), wavg(f1).alias("f1"), known.cast("long").alias("support")))
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def threshold_sweep(df: DataFrame, label: str, score: str, cutoffs: Sequence[float],
                    positive: int = 1) -> DataFrame:
    """Confusion matrix at each inclusive cut-off (``score >= c`` is
    class 1): ``cutoff, actual, predicted, count`` for every distinct cut-off.

    Every row gets a bucket, the number of cut-offs at or below its score;
    positives and negatives are counted per bucket (combined map-side), and
    suffix sums over the ``len(cutoffs) + 1`` buckets give the cells at every
    cut-off. Rows are neither copied per cut-off nor tested in one wide
    aggregate, so any number of cut-offs costs one pass."""
    cuts = sorted({float(c) for c in cutoffs})
    s = F.col(score).cast("double")
    y1 = _is(label, positive)
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= s))
    per = df.groupBy(bucket.alias("bucket")).agg(_count_if(y1).alias("pos"), _count_if(~y1).alias("neg"))
    # All buckets 0..T (T = number of cut-offs); bucket b > 0 starts at cut-off b - 1.
    slots = F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"),
                                         (F.lit(cuts[b - 1]) if b else F.lit(None).cast("double")).alias("cutoff"))
                                for b in range(len(cuts) + 1)])).alias("t")
    every = per.sparkSession.range(1).select(slots).select("t.*")  # T + 1 rows
    full = every.join(per, "bucket", "left").select(
        "bucket", "cutoff", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    # One window over T + 1 rows: suffix sums from the highest bucket down.
    w = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy()
    at = full.select("bucket", "cutoff", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                     F.sum("pos").over(tot).alias("P"), F.sum("neg").over(tot).alias("N")).where("bucket > 0")
    cells = at.select("cutoff", F.explode(F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), (F.col("N") - F.col("fp")).alias("count")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), (F.col("P") - F.col("tp")).alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("count")))).alias("c"))
    return cells.select("cutoff", "c.actual", "c.predicted", F.col("c.count").cast("long").alias("count"))


def model_metrics(scored: DataFrame, label: str, prediction: str = "prediction",
                  score: str = "p1", by: Sequence[str] = ()) -> DataFrame:
    """E10 row: accuracy, precision, recall and AUC of every scored set."""
    m = binary_metrics(scored, label, prediction, by=by)
    auc = roc_auc(scored, label, score, by=by)
    return m.join(auc, list(by)) if by else m.withColumn("auc", auc.scalar())
