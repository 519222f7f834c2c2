from pyspark.sql import functions as F

from riskframe.operators import explain as xp
from riskframe.operators import models as md
from riskframe.operators import validate as val
from riskframe.plans import jobs
from riskframe.spec import SURVEY_SPEC, scoring_rules


def test_quarantine_codes(spark, survey):
    raw = survey.withColumn("gender", F.when(F.col("row_id") == 1, F.lit("X"))
                            .when(F.col("gender") == 1, F.lit("M")).otherwise(F.lit("F")))
    raw = raw.withColumn("age", F.when(F.col("row_id") == 2, F.lit(200)).otherwise(F.col("age")))
    raw = raw.withColumn("copd", F.when(F.col("row_id") == 3, F.lit(5)).otherwise(F.col("copd")))
    ok, bad = val.quarantine_split(raw, scoring_rules(SURVEY_SPEC))
    codes = {r.row_id: r.errors[0] for r in bad.collect()}
    assert codes == {1: "invalid:gender", 2: "invalid:age", 3: "invalid:copd"}
    assert ok.count() == 297


def test_score_batch_linear_bundle(spark, survey):
    from riskframe.operators import preprocess as pp

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    model = md.LinearModel(0.0, {"pack_years": 1.0})
    bundle = jobs.Bundle(SURVEY_SPEC, params, [], ["pack_years"], model)
    scored, quarantined = jobs.score(survey, bundle)
    assert scored.count() == 300 and quarantined.count() == 0
    assert set(scored.columns) == {"row_id", "prediction", "probability", "risk_level", "label"}


def test_sampled_shapley_sums_to_difference(spark, survey):
    """With one background row, phi sums to f(x) - f(background) exactly."""
    from riskframe.operators import preprocess as pp

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    data = pp.transform(survey, SURVEY_SPEC, params).withColumn("label", F.col("lung_cancer_risk").cast("double"))
    feats = ["pack_years", "copd", "age", "bmi"]
    model = md.fit(data, feats, "logistic_regression", {"C": 1.0}, weight=None)
    bg = data.orderBy("row_id").limit(1)
    rows = data.where(F.col("row_id") <= 20)
    phi = xp.shap_sampled(rows, model, feats, "row_id", background=bg, n_background=1, permutations=3)
    sums = {r.row_id: r.s for r in phi.groupBy("row_id").agg(F.sum("phi").alias("s")).collect()}
    fx = {r.row_id: r.probability for r in md.predict(model, rows).collect()}
    fb = md.predict(model, bg).first().probability
    assert len(sums) == 20
    for k, s in sums.items():
        assert abs(s - (fx[k] - fb)) < 1e-9


def test_sampled_shapley_of_a_logistic_model_makes_no_coalition_rows(spark, survey, monkeypatch):
    """The running sums give what scoring every coalition gives, for rows over many batches; no coalition is scored."""
    from pyspark.ml import PipelineModel

    from riskframe.operators import preprocess as pp

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    data = pp.transform(survey, SURVEY_SPEC, params).withColumn("label", F.col("lung_cancer_risk").cast("double"))
    feats = ["pack_years", "copd", "age", "bmi"]
    model = md.fit(data, feats, "logistic_regression", {"C": 1.0}, weight=None)
    terms = xp._logistic_terms(model, feats)
    with monkeypatch.context() as m:
        m.setattr(xp, "_logistic_terms", lambda *_: None)
        want = {(r.row_id, r.feature): (r.value, r.phi) for r in xp.shap_sampled(data, model, feats, "row_id", permutations=3).collect()}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")  # no multiple of 3
    monkeypatch.setattr(PipelineModel, "transform", None)
    try:
        got = {(r.row_id, r.feature): (r.value, r.phi) for r in xp.shap_sampled(data, model, feats, "row_id", permutations=3).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert terms is not None and len(got) == 300 * 4 and got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in got)


def test_sampled_shapley_counts_every_background_row(spark, survey):
    """phi sums to f(x) less the mean of f over all 300 background rows, for a logistic model and for a forest."""
    from riskframe.operators import preprocess as pp

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    data = pp.transform(survey, SURVEY_SPEC, params).withColumn("label", F.col("lung_cancer_risk").cast("double")).cache()
    feats = ["pack_years", "copd", "age", "bmi"]
    rows = data.where(F.col("row_id") <= 5)
    for family, setting in (("logistic_regression", {"C": 1.0}), ("random_forest", {"n_estimators": 5, "max_depth": 3})):
        model = md.fit(data, feats, family, setting, weight=None)
        phi = xp.shap_sampled(rows, model, feats, "row_id", background=data, permutations=2)
        sums = {r.row_id: r.s for r in phi.groupBy("row_id").agg(F.sum("phi").alias("s")).collect()}
        mean = md.predict(model, data).agg(F.avg("probability")).first()[0]
        fx = {r.row_id: r.probability for r in md.predict(model, rows).collect()}
        assert len(sums) == 5 and all(abs(sums[k] - (fx[k] - mean)) < 1e-9 for k in sums)


def test_sampled_shapley_of_wide_margins(spark):
    """Margins far apart and repeated cells: the looked-up means are those of scoring every pair."""
    import numpy as np

    rng = np.random.default_rng(1)
    x, b, w = rng.normal(size=(40, 3)) * [1, 30, 4000], rng.normal(size=(500, 3)) * [1, 30, 4000], np.array([2.0, -1.0, 0.5])
    frame = lambda m: spark.createDataFrame([(i, *r) for i, r in enumerate(m.tolist())], "row_id long, a double, b double, c double").repartition(3, "row_id")
    orders = xp.feature_orders(["a", "b", "c"], 2)
    assert orders[1] == orders[0][::-1]
    found = xp._background_moments(frame(b).drop("row_id"), (w, 0.3), orders)
    got = {(r.row_id, r.feature): r.phi for r in xp._logistic_values(frame(x), (w, 0.3), ["a", "b", "c"], "row_id", found, orders).collect()}
    for i, row in enumerate(x):
        want = np.zeros(3)
        for s, share in xp.coalitions(orders).items():
            z = np.where([j in s for j in range(3)], row, b) @ w + 0.3
            want += share * (1 / (1 + np.exp(-np.clip(z, -700, 700)))).mean()
        assert np.allclose([got[i, c] for c in "abc"], want, atol=1e-10)


def test_linear_shap_identity(spark, survey):
    from riskframe.operators import preprocess as pp

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    data = pp.transform(survey, SURVEY_SPEC, params)
    model = md.LinearModel(-1.0, {"pack_years": 1.2, "copd": 0.5})
    phi = xp.shap_linear(data, model, "row_id")
    base = data.agg(F.avg(model.margin())).first()[0]
    got = phi.groupBy("row_id").agg(F.sum("phi").alias("s")).join(data.select("row_id", model.margin().alias("m")), "row_id")
    assert got.where(F.abs(F.col("s") - (F.col("m") - F.lit(base))) > 1e-9).count() == 0


def test_stream_score_equals_batch(spark, survey, tmp_path):
    from riskframe.operators import preprocess as pp
    from riskframe.streaming.jobs import stream_score

    raw = survey.withColumn("gender", F.when(F.col("gender") == 1, F.lit("M")).otherwise(F.lit("F")))
    src = str(tmp_path / "src")
    raw.write.parquet(src)
    batch_raw = spark.read.parquet(src)
    params = pp.Preprocessor(SURVEY_SPEC).fit(batch_raw)
    bundle = jobs.Bundle(SURVEY_SPEC, params, [], ["pack_years", "copd"], md.LinearModel(-1.0, {"pack_years": 1.0, "copd": 0.5}))
    out, quar, _ = stream_score(spark, src, batch_raw.schema, bundle, str(tmp_path / "out"), str(tmp_path / "q"))
    batch, _ = jobs.score(batch_raw, bundle)
    from riskframe.streaming.jobs import read_landed

    assert sorted(read_landed(spark, out).collect()) == sorted(batch.collect())
    assert spark.read.parquet(quar).count() == 0


def test_rules_upper_case_set_and_text_range(spark):
    from riskframe.spec import Rule

    df = spark.createDataFrame([(1, "building", "5"), (2, "FARM", "x"), (3, None, "200")], "id int, seg string, age string")
    rules = [Rule("seg", "in", allowed=("BUILDING", "MACHINERY"), upper=True, code="seg"),
             Rule("age", "range", lo=0, hi=120, code="age")]
    errs = {r.id: list(r.errors) for r in val.with_errors(df, rules).collect()}
    assert errs == {1: [], 2: ["seg", "age"], 3: ["age"]}


def test_flags_coded_otherwise_than_learned_are_quarantined(spark, survey):
    from riskframe.operators import preprocess as pp
    from riskframe.plans import jobs
    from riskframe.plans.queries import FIXED_LINEAR
    from riskframe.spec import SURVEY_SPEC

    coded = survey.withColumn("asthma", F.col("asthma") + 1)
    params = pp.Preprocessor(SURVEY_SPEC).fit(coded)
    assert params.columns["asthma"].remap and not params.columns["smoker"].remap
    bundle = jobs.Bundle(SURVEY_SPEC, params, [], list(FIXED_LINEAR.weights), FIXED_LINEAR)
    odd = coded.withColumn("asthma", F.when(F.col("row_id") == 1, 0).otherwise(F.col("asthma"))) \
        .withColumn("smoker", F.when(F.col("row_id") == 2, 2).otherwise(F.col("smoker")))
    scored, bad = jobs.score(odd, bundle)
    assert {r.row_id: r.errors for r in bad.collect()} == {1: ["invalid:asthma"], 2: ["invalid:smoker"]}
    assert scored.count() == survey.count() - 2
