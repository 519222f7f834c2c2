from pyspark.sql import functions as F

from riskframe.plans import jobs
from riskframe.sources import registry as reg
from riskframe.spec import SURVEY_SPEC


def test_train_select_register_and_score(spark, survey, tmp_path):
    root = str(tmp_path / "models")
    bundle, results = jobs.train(survey, SURVEY_SPEC, families=("logistic_regression", "random_forest"),
                                 n_iter=2, registry_root=root, parallelism=2)
    assert results.count() == 4
    best = results.orderBy(F.col("recall").desc()).first()
    assert bundle.meta["cv_recall"] == best["recall"]
    assert bundle.meta["family"] in ("logistic_regression", "random_forest")
    assert reg.latest_version(spark, root) == 1
    scored, quarantined = jobs.score(survey, bundle)
    assert scored.count() == 300 and quarantined.count() == 0
    loaded = jobs.load_bundle(spark, root, SURVEY_SPEC)
    again, _ = jobs.score(survey, loaded)
    assert sorted(again.collect()) == sorted(scored.collect())
    assert scored.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def test_retrain_unions_appended_records(spark, survey):
    base = survey.where(F.col("row_id") <= 200)
    new = survey.where(F.col("row_id") > 200).drop("radon_exposure")
    bundle, results = jobs.retrain(base, new.withColumn("radon_exposure", F.lit(0)), SURVEY_SPEC,
                                   families=("logistic_regression",), n_iter=1, parallelism=1)
    assert results.count() == 1 and bundle.meta["n_rows"] == 240 and bundle.meta["n_unlabelled"] == 0
