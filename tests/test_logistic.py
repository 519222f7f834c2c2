"""Shared-pass logistic search against a plain Newton on the collected table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import logistic as lg
from riskframe.operators import models as md
from riskframe.plans import jobs
from riskframe.spec import SURVEY_SPEC

FEATURES = ["a", "b", "c"]


def table(spark, n=600, seed=1, parts=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    p = 1 / (1 + np.exp(-(x @ [1.5, -2.0, 0.0] - 1)))
    y = (rng.random(n) < p).astype(float)
    rows = [(*map(float, r), float(l), int(f)) for r, l, f in zip(x, y, rng.integers(0, 4, n))]
    return spark.createDataFrame(rows, "a double, b double, c double, label double, fold int").repartition(parts)


def plain(x, y, c, balanced=True):
    x = np.column_stack([x, np.ones(len(x))])
    n = len(y)
    w = np.where(y > 0, n / (2 * y.sum()), n / (2 * (n - y.sum()))) if balanced else np.ones(n)
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b = b - np.linalg.solve(c * (x.T * (w * p * (1 - p))) @ x + ridge, c * x.T @ (w * (p - y)) + ridge @ b)
    return b


@pytest.mark.parametrize("balanced", [True, False])
def test_coefficients_and_recalls_equal_plain_newton(spark, balanced):
    df = table(spark)
    data = np.array(df.select(*FEATURES, "label", "fold").collect())
    settings = [{"C": c} for c in (0.01, 1, 100)]
    found = lg.search(df, FEATURES, settings, balanced=balanced)
    assert len(found.models) == 3 * 5
    recalls = {(r["draw"], r["fold"]): r for r in found.recalls.collect()}
    for (draw, fold), model in found.models.items():
        part = data[:, 4] != (fold if fold is not None else -9)
        want = plain(data[part, :3], data[part, 3], settings[draw]["C"], balanced)
        assert np.allclose([*model.weights.values(), model.intercept], want, atol=1e-6)
        if fold is not None:
            held = data[~part]
            said = held[:, :3] @ want[:3] + want[3] >= 0
            r = recalls[draw, fold]
            assert (r["n_positive"], r["n_found"]) == (held[:, 3].sum(), (said & (held[:, 3] > 0)).sum())
    assert max(lg.gradients(df, FEATURES, settings, found, balanced=balanced).values()) < 1e-8


def test_partitioning_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(lg, "GROUP", 4)
    few, many = (lg.newton(table(spark, parts=k), FEATURES, [lg.Job(0, 1.0, None), lg.Job(0, 1.0, 2)]) for k in (1, 9))
    assert np.allclose(few, many, atol=1e-9)


def test_separable_constant_and_scaled_columns(spark):
    rows = [(float(i), 1.0, i * 1e-3, float(i >= 20), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double, fold int")
    data = np.array(rows)
    got = lg.newton(df, FEATURES, [lg.Job(0, 100.0, None)])[0]
    x = data[:, :3]
    p = lambda b: 1 / (1 + np.exp(-(x @ b[:3] + b[3])))
    slope = 100 * np.column_stack([x, np.ones(40)]).T @ (p(got) - data[:, 3]) + np.array([*got[:3], 0])
    assert np.abs(slope).max() < 1e-4


def test_one_class_missing_values_and_unlabelled_rows(spark):
    df = table(spark, 60)
    with pytest.raises(ValueError, match="one class"):
        lg.newton(df.where("label = 1"), FEATURES, [lg.Job(0, 1.0, None)])
    with pytest.raises(Exception, match="impute"):
        lg.newton(df.withColumn("a", F.when(F.col("b") > 0, F.col("a"))), FEATURES, [lg.Job(0, 1.0, None)])
    more = df.unionByName(df.limit(5).withColumn("label", F.lit(None).cast("double")))
    assert np.allclose(lg.newton(more, FEATURES, [lg.Job(0, 1.0, None)]), lg.newton(df, FEATURES, [lg.Job(0, 1.0, None)]), atol=1e-9)


def test_tune_cross_validate_and_save(spark, tmp_path):
    df = table(spark).withColumn("weight", F.lit(1.0))
    model, results = md.tune(df, FEATURES, "logistic_regression", 20)
    assert results.count() == 5 and isinstance(model, md.LinearModel)
    scored = md.cross_validate(df, FEATURES, "logistic_regression", {"C": 1.0})
    assert scored.count() == 600 and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    model.save(str(tmp_path / "m"))
    assert md.LinearModel.load(spark, str(tmp_path / "m")) == model


def test_split_keeps_repeated_and_missing_ids(spark, survey):
    some = survey.limit(80).cache()
    n = some.count()
    ids = F.when(F.col("row_id") % 4 == 0, F.lit(None)).when(F.col("row_id") % 4 == 1, F.lit(7)).otherwise(F.col("row_id"))
    odd = some.withColumn("row_id", ids.cast(some.schema["row_id"].dataType))
    train, test = jobs.split_labelled(odd, SURVEY_SPEC)
    assert (train.count(), test.count()) == (n - -(-n // 5), -(-n // 5))
    assert sorted(map(str, train.unionByName(test).collect())) == sorted(map(str, odd.collect()))


def test_row_ids_of_many_equal_rows(spark):
    spec = SURVEY_SPEC.with_(id_col="row_id")
    df = spark.range(1000).selectExpr("id % 3 AS x")
    got = jobs.with_row_id(df, spec, block=16)
    assert got.count() == 1000 and got.select("row_id").distinct().count() == 1000
    assert sorted(r[0] for r in got.select("x").collect()) == sorted(r[0] for r in df.collect())


def test_folds_go_on_with_the_hessians_of_their_setting(spark, monkeypatch):
    """Models of folds add no Hessian of their own to a pass; a stale one is summed again."""
    df, jobs, summed = table(spark, 20000), [lg.Job(0, 1.0, f) for f in (0, 1, 2, 3, None)], []
    plain_sums = lg.sums
    monkeypatch.setattr(lg, "sums", lambda rows, jobs, weights, coef, curved=None: summed.append((len(jobs), len(curved))) or plain_sums(rows, jobs, weights, coef, curved))
    usual = lg.newton(df, FEATURES, jobs)
    assert all(n_curved == 0 for n_jobs, n_curved in summed if n_jobs > 1) and any(n_jobs == 4 for n_jobs, _ in summed)
    monkeypatch.setattr(lg, "SHRINKS", 0.0)
    assert np.allclose(lg.newton(df, FEATURES, jobs), usual, atol=1e-7)
