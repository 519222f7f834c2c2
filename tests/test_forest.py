"""The forest over packed blocks: its trees are what the rows drawn for them give, and it scores like Spark ML's."""

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskframe.operators import forest as fo
from riskframe.operators import models as md

FEATURES = ["a", "b", "c", "d"]


def table(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 2, n), np.full(n, 7.0)])
    y = (x[:, 0] + x[:, 1] - 2 + 2 * x[:, 2] * x[:, 0] + rng.normal(size=n)) > 0.5
    columns = {c: x[:, i] for i, c in enumerate(FEATURES)} | {"label": y.astype(float), "weight": np.where(y, 1.5, 0.75), "id": np.arange(n)}
    return spark.createDataFrame(pd.DataFrame(columns)).repartition(3, "id").sortWithinPartitions("id").cache()


def test_forest_scores_like_the_estimators(spark):
    df = table(spark, 4000)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    setting = {"n_estimators": 40, "max_depth": 6, "min_samples_leaf": 2}
    model = md.fit(train, FEATURES, "random_forest", setting)
    plain = Pipeline(stages=[md.assembler(FEATURES), md.estimator("random_forest", setting)]).fit(train)
    assert isinstance(model, fo.ForestModel) and len(model.trees) == 40
    both = md.predict(model, test, ["id"]).join(md.predict(plain, test, ["id"]).toDF("id", "q", "p"), "id")
    n, gap, other = both.agg(F.count(F.lit(1)), F.avg(F.abs(F.col("p") - F.col("probability"))), F.count_if(F.col("q") != F.col("prediction"))).first()
    assert n == test.count() and gap < 0.06 and other < 0.06 * n
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability")
    mine, theirs = (auc.evaluate(m.transform(test)) for m in (model, plain))
    assert abs(mine - theirs) < 0.02


def test_forest_is_the_same_in_groups_and_portions(spark, monkeypatch):
    """Trees grown a few at a time, their sums a tree at a time, are the trees grown together; states don't outlive the fit."""
    df = table(spark, 900)
    args = df, FEATURES, 7, 5, 3, "label", "weight"
    together = fo.fit(*args)
    monkeypatch.setattr(fo, "STATE", 2 * 900 * 2)
    monkeypatch.setattr(fo, "HELD", 1)
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    apart = fo.fit(*args)
    assert [vars(t) for t in apart.trees] == [vars(t) for t in together.trees]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
    assert len({tuple(t.cut) for t in together.trees}) > 1


def test_first_split_is_the_best_of_the_drawn_rows(spark):
    df = table(spark, 700)
    with np.errstate(all="raise"):
        model = fo.fit(df, FEATURES, 3, 1, 1, "label", "weight")
    rows = df.toPandas()
    bins = np.column_stack([np.searchsorted(c, rows[f], "left") for f, c in zip(FEATURES, model.cuts)])
    n_bins = np.array([len(c) + 1 for c in model.cuts])
    # the draws of a block follow its bytes: take the blocks apart as the fit did
    blocks = []
    for part in df.select("label", "weight", *FEATURES).rdd.glom().collect():
        x = np.array(part, float)
        b = np.column_stack([np.searchsorted(c, x[:, i + 2], "left") for i, c in enumerate(model.cuts)]).astype(np.uint8)
        y = x[:, 0].astype(np.int8)
        blocks.append((b, y, x[:, 1], fo.zlib.crc32((2 * b + y[:, None].astype(np.uint8)).tobytes(), fo.zlib.crc32(y.tobytes()))))
    assert sum(len(b[1]) for b in blocks) == len(bins) == 700
    for t, tree in enumerate(model.trees):
        n = np.concatenate([fo._drawn(t, b) for b in blocks])
        assert 0.85 < n.mean() < 1.15
        x, y, w = np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks]), n * np.concatenate([b[2] for b in blocks])

        def left_over(c, cut):
            sides = [(x[:, c] <= cut), (x[:, c] > cut)]
            return sum(w[s].sum() * (1 - sum((w[s & (y == k)].sum() / w[s].sum()) ** 2 for k in (0, 1))) for s in sides if w[s].sum())

        columns = fo._Open.of(t, 0, [0], n_bins, 2).columns[0]
        best = min(left_over(c, b) for c in columns for b in range(n_bins[c] - 1)) if n_bins[columns].max() > 1 else None
        if len(tree.left) > 1:
            assert abs(left_over(tree.column[0], tree.cut[0]) - best) < 1e-6
            one = w[y == 1]
            assert abs(tree.share[0] - one.sum() / w.sum()) < 1e-9
