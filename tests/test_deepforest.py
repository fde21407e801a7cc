"""Forests of full depth (M3, M4): a plain recursive tree, the same forest whatever the
block and the partitioning, and what the driver keeps."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from partqc.operators import deepforest, evaluate, models
from partqc.operators.deepforest import feature_subsets, grow

P = {"subset": 2, "max_bins": 32, "max_depth": 30, "least": 1, "impurity": "gini", "seed": 3}


def plain(bins, y, w, node, tree, p):
    """(feature, bin, left, right) or share of class 1."""
    def impurity(c):
        c = c / c.sum()
        return 1 - (c * c).sum() if p["impurity"] == "gini" else -sum(v * np.log2(v) for v in c if v)

    t = np.array([w[y == 0].sum(), w[y == 1].sum()], float)
    share, best = t[1] / t.sum(), (1e-14, None, None)
    if t.min() and node.bit_length() - 1 < p["max_depth"]:
        for f in feature_subsets(np.array([node]), tree, bins.shape[1], p["subset"], p["seed"])[0]:
            for b in np.unique(bins[:, f])[:-1]:
                m = bins[:, f] <= b
                left = np.array([w[m & (y == 0)].sum(), w[m & (y == 1)].sum()], float)
                right = t - left
                if min(left.sum(), right.sum()) < p["least"]:
                    continue
                gain = impurity(t) - left.sum() / t.sum() * impurity(left) - right.sum() / t.sum() * impurity(right)
                if gain > best[0] + 1e-15:
                    best = (gain, f, b)
    if best[1] is None:
        return share
    m = bins[:, best[1]] <= best[2]
    l, r = (plain(bins[k], y[k], w[k], 2 * node + i, tree, p) for i, k in enumerate((m, ~m)))
    if not isinstance(l, tuple) and not isinstance(r, tuple) and (l > 0.5) == (r > 0.5):
        return share
    return int(best[1]), int(best[2]), l, r


@pytest.mark.parametrize("impurity,least,max_depth", [("gini", 1, 30), ("entropy", 1, 30), ("gini", 4, 30), ("gini", 1, 3)])
def test_grown_tree_is_the_plain_tree(impurity, least, max_depth):
    rng = np.random.default_rng(5)
    p = P | {"impurity": impurity, "least": least, "max_depth": max_depth}
    bins = rng.integers(0, 9, (300, 4)).astype(np.uint8)
    y, w = (bins[:, 0] + rng.integers(0, 9, 300) > 8).astype(np.int64), rng.integers(1, 4, 300)
    feature, cut, left, share = grow(bins, y, w, np.zeros(300, int), np.array([1]), 7, p)

    def as_tuple(i):
        return ((int(feature[i]), int(cut[i]), as_tuple(left[i]), as_tuple(left[i] + 1)) if feature[i] >= 0
                else share[i])
    assert as_tuple(0) == plain(bins, y, w, 1, 7, p)


def frame(spark, n=3000, dims=6):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(n, dims))
    y = (X[:, 0] + X[:, 1] + rng.normal(size=n) > 0).astype(int)
    X[::7] = X[3]  # rows alike
    return spark.createDataFrame([(i, int(b), [float(v) for v in x]) for i, (x, b) in enumerate(zip(X, y))],
                                 "id long, y int, x array<double>").select("id", "y", array_to_vector("x").alias("features"))


def test_block_and_partitions_do_not_change_the_forest(spark):
    df = frame(spark)
    got = []
    for block, parts in ((deepforest.BLOCK, 3), (200, 11)):
        rf = models.forest_full_depth("y", "features", "gini", num_trees=5)
        rf.block = block
        model = rf.fit(df.repartition(parts))
        if block == 200:  # the driver keeps the nodes above the groups only
            assert (model.upper.state == 0).any()
            assert model.upper.rows[model.upper.state == 2].max() <= 200
            assert len(model.upper.tree) < 5 * 4 * 3000 / 200
            nodes = sum(len(r["bin"]) for r in model.nodes.collect())
            assert nodes > 4 * len(model.upper.tree)
        got.append({r["id"]: (r["probability"][1], r["prediction"]) for r in model.transform(df).collect()})
    assert len(got[0]) == 3000 and got[0] == got[1]
    assert all(q == float(p > 0.5) for p, q in got[0].values())


def test_as_good_as_spark_mls_forest(spark):
    df = frame(spark)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    auc = []
    for rf in (models.forest_full_depth("y", "features", "entropy", num_trees=30),
               models.forest("y", "features", "entropy", num_trees=30, max_depth=30, subset="sqrt")):
        scored = rf.fit(train).transform(test).withColumn("p1", F.expr("cast(null as double)"))
        from partqc.functions.columns import class_probability
        auc.append(evaluate.roc_auc(scored.withColumn("p1", class_probability("probability", 1)), "y", "p1").first()["auc"])
    assert abs(auc[0] - auc[1]) < 0.02 and auc[0] > 0.7


def test_labels_must_be_two_classes(spark):
    with pytest.raises(ValueError, match="label 0 or 1"):
        models.forest_full_depth("y").fit(frame(spark, 20).withColumn("y", F.lit(2)))


def test_forests_of_one_split_share_binned_rows(spark, monkeypatch):
    from partqc.plans import compare
    rng = np.random.default_rng(4)
    X = rng.normal(size=(400, 4))
    df = spark.createDataFrame([(i, int(x[0] + x[1] > 0), *map(float, x)) for i, x in enumerate(X)], "id long, y int, a double, b double, c double, d double")
    parts = [compare.to_vector(df.where(cond), ["a", "b", "c", "d"]) for cond in ("id % 4 > 0", "id % 4 = 0")]
    passes = []
    plain_thresholds = deepforest.DeepForest.thresholds
    monkeypatch.setattr(deepforest.DeepForest, "thresholds",
                        lambda self, rows, n: passes.append(n) or plain_thresholds(self, rows, n))
    data = compare.scaled(*parts, "y", "id")
    for kind, impurity in (("forest_entropy", "entropy"), ("forest_gini", "gini")):
        shared = compare.fit_and_score(data, kind).select("id", "p1").collect()
        alone = models.forest_full_depth("y", "features", impurity).fit(data.train).transform(data.test)
        want = alone.select("id", F.element_at(vector_to_array("probability"), 2).alias("p1")).collect()
        assert len(shared) == 100 and sorted(shared) == sorted(want)
    assert passes == [300] * 3  # one for both forests, one for each forest alone
