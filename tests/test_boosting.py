"""Boosting over packed columns against Spark ML's estimator: the same trees, from the same cuts and drawn columns."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskframe.operators import boosting as bo
from riskframe.operators import models as md

FEATURES = ["a", "b", "c", "d", "e", "f"]


def table(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 2, n), np.where(rng.random(n) < 0.6, 0, rng.normal(size=n)), rng.exponential(size=n), np.full(n, 7.0)])
    y = (x[:, 0] + x[:, 1] - 2 + 2 * x[:, 2] * x[:, 3] + rng.normal(size=n)) > 0.5
    columns = {c: x[:, i] for i, c in enumerate(FEATURES)} | {"label": y.astype(float), "id": np.arange(n)}
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(columns)).repartition(3, "id").sortWithinPartitions("id").cache()


def plain(df, setting):
    return Pipeline(stages=[md.assembler(FEATURES), md.estimator("gradient_boosting", setting, weight=None)]).fit(df)


def agree(df, model, want):
    both = md.predict(model, df, ["id"]).join(md.predict(want, df, ["id"]).toDF("id", "q", "p"), "id")
    n, gap, other = both.agg(F.count(F.lit(1)), F.max(F.abs(F.col("p") - F.col("probability"))), F.count_if(F.col("q") != F.col("prediction"))).first()
    assert n == df.count() and gap < 1e-9 and other == 0
    for tree, theirs in zip(model.trees, want.stages[-1].trees, strict=True):
        assert 2 * len(tree.split) + 1 == theirs.numNodes


@pytest.mark.parametrize("n, setting", [
    (900, {"n_estimators": 7, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 0.7}),
    (900, {"n_estimators": 4, "max_depth": 5, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0}),
    (23_000, {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 0.5}),  # cuts from a sample
])
def test_trees_are_the_estimators(spark, monkeypatch, n, setting):
    monkeypatch.setattr(bo, "FRESH", 3)  # margins are made anew from all trees on the way
    df = table(spark, n)
    model = md.fit(df, FEATURES, "gradient_boosting", setting)
    assert isinstance(model, bo.BoostedModel) and len(model.trees) == setting["n_estimators"]
    agree(df, model, plain(df, setting))


def test_many_partitions_and_other_settings(spark, monkeypatch):
    monkeypatch.setattr(bo, "DIRECT", 1)  # partitions' sums are added on executors first
    df = table(spark, 600)
    setting = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3}
    agree(df, md.fit(df, FEATURES, "gradient_boosting", setting), plain(df, setting))
    drawn = setting | {"subsample": 0.8}  # drawn rows stay the estimator's
    assert md.fit(df, FEATURES, "gradient_boosting", drawn, weight=None).stages[-1].getSubsamplingRate() == 0.8


def test_one_class_missing_values_and_labels(spark):
    df = table(spark, 60)
    setting = {"n_estimators": 2, "max_depth": 2}
    one = df.withColumn("label", F.lit(1.0))
    agree(one, md.fit(one, FEATURES, "gradient_boosting", setting), plain(one, setting))
    for bad, said in ((df.withColumn("b", F.expr("nullif(b, 1)")), "impute"), (df.withColumn("label", F.lit(2.0)), "label"), (df.where("id < 0"), "no rows")):
        with pytest.raises(Exception, match=said):
            md.fit(bad, FEATURES, "gradient_boosting", setting)
