import math

from pyspark.sql import functions as F

from riskframe.operators import features as feat
from riskframe.operators import metrics as mt
from riskframe.operators import sampling as smp
from riskframe.operators.models import score_columns


def test_drop_correlated_rules(spark):
    rows = [(float(i), 2.0 * i, float((i * 37) % 11), i + 0.01 * ((i * 13) % 3), 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, a2 double, b double, an double, c double")
    dropped = feat.correlated_to_drop(df, ["a", "a2", "b", "an", "c"])
    assert dropped == ["a2", "an"]  # constant c: NULL correlation, kept
    assert feat.correlated_to_drop(df, ["a", "a2", "b", "an", "c"], pairwise_complete=False) == ["a2", "an"]


def test_row_sums_skip_null(spark):
    df = spark.createDataFrame([(1, None, 1)], "chest_pain int, fatigue int, xray_abnormal int")
    assert feat.add_derived_features(df).first()["clinical_severity_score"] == 2.0


def _scores(spark):
    return spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "score double, label int")


def test_auc_and_average_precision(spark):
    df = _scores(spark)
    assert abs(mt.roc_auc(df).first()[0] - 0.75) < 1e-12
    assert abs(mt.average_precision(df).first()[0] - 0.8333333333333333) < 1e-12


def test_auc_ties_half_credit_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = [(float((i * 7) % 10) / 10, int((i * 3) % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    ours = mt.roc_auc(df).first()[0]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert abs(ours - ref) < 1e-9


def test_confusion_one_class_four_counts(spark):
    df = spark.createDataFrame([(0.9, 1), (0.7, 1)], "score double, label int")
    r = mt.binary_metrics(df).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (0, 0, 0, 2) and r.precision == 1.0


def test_no_predicted_positives_precision_zero(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "score double, label int")
    assert mt.binary_metrics(df).first().precision == 0.0


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.8,), (0.9,), (0.15,), (0.3,), (0.7,), (0.29999,)], "p double")
    out = [r[0] for r in df.select(score_columns(F.col("p"))["risk_level"]).collect()]
    assert out == ["High", "High", "Low", "Medium", "High", "Low"]


def test_threshold_sweep_matches_brute_force(spark):
    rows = [(round(((i * 7919) % 1000) / 1000.0, 3), int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "score double, label int")
    sweep = {round(r.threshold, 2): r for r in mt.threshold_sweep(df).collect()}
    for i in range(10, 91):
        t = i / 100.0
        tp = sum(1 for s, y in rows if y == 1 and s >= t)
        fp = sum(1 for s, y in rows if y == 0 and s >= t)
        P = sum(y for _, y in rows)
        assert abs(sweep[round(t, 2)].recall - tp / P) < 1e-12
        assert abs(sweep[round(t, 2)].precision - (tp / (tp + fp) if tp + fp else 0.0)) < 1e-12


def test_split_exact_disjoint_partition_independent(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    a = smp.stratified_split(df, "y", "k")
    b = smp.stratified_split(df.repartition(1), "y", "k")
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {(r.y, r.split): r["count"] for r in a.groupBy("y", "split").count().collect()}
    n_test = sum(v for (y, s), v in counts.items() if s == "test")
    assert n_test == math.ceil(0.2 * 1003)
    assert abs(counts[(1, "test")] - 0.2 * 144) <= 1


def test_folds_balanced(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    f = smp.stratified_folds(df, "y", "k")
    per = f.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in per if r.y == y]
        assert len(c) == 5 and max(c) - min(c) <= 1


def test_draw_settings_counts():
    from riskframe.spec import BOOSTED_GRID, FOREST_GRID, LOGISTIC_GRID

    assert len(smp.draw_settings(LOGISTIC_GRID, 20)) == 5
    assert len(smp.param_combinations(FOREST_GRID)) == 108
    assert len(smp.param_combinations(BOOSTED_GRID)) == 243
    assert len(smp.draw_settings(BOOSTED_GRID, 20)) == 20


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r.y: r.weight for r in smp.class_weights(df, "y").collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def test_split_keeps_null_label_rows(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(200)], "k long, y int")
    out = smp.stratified_split(df, "y", "k")
    assert out.count() == 200
    assert out.where(F.col("y").isNull() & (F.col("split") == "test")).count() == 4


def test_hash_rank_many_buckets_equals_window(spark):
    from pyspark.sql import Window

    from riskframe.functions.hashing import hash_key
    from riskframe.operators.rank import hash_rank

    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"))
    ours = hash_rank(df, ["y"], "k", 42, "t", rank_col="r", rows_per_bucket=2)  # 3 hex chars
    w = Window.partitionBy("y").orderBy(hash_key(42, "t", "k"), "k")
    ref = df.withColumn("r", F.row_number().over(w).cast("bigint"))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_classification_report_multiclass(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 2), (2, 2), (2, 2)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    rep = {r.label: r for r in mt.classification_report(df).collect()}
    # class 2: tp 3, support 4, predicted 3
    assert rep["2"].precision == 1.0 and rep["2"].recall == 0.75 and abs(rep["2"].f1 - 6 / 7) < 1e-12
    assert rep["accuracy"].f1 == 6 / 8 and rep["accuracy"].support == 8
    macro_p = (0.5 + 2 / 3 + 1.0) / 3
    assert abs(rep["macro avg"].precision - macro_p) < 1e-12
    weighted_r = (2 * 0.5 + 2 * 1.0 + 4 * 0.75) / 8
    assert abs(rep["weighted avg"].recall - weighted_r) < 1e-12


def test_every_bad_value_is_reported(spark):
    from riskframe.operators.validate import SHOWN, domain_messages, domain_violations

    df = spark.createDataFrame([(float(v),) for v in range(2, 300)], "x double")
    assert domain_violations(df, ["x"]).count() == 298
    assert domain_messages(df, ["x"])[0].endswith(f"and {298 - SHOWN} more")


def test_running_totals_many_buckets_equal_window(spark):
    from pyspark.sql import Window

    from riskframe.operators.rank import running_totals

    df = spark.range(0, 4000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 4001).cast("double").alias("s"),
                                     (F.col("id") % 5).alias("w"))
    ours = running_totals(df, "s", ["w"], descending=True, partition_cols=["g"])
    ref = df.withColumn("cum_w", F.sum("w").over(Window.partitionBy("g").orderBy(F.col("s").desc())
                                                 .rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(ours.select("g", "s", "w", "cum_w").collect()) == sorted(ref.collect())


def test_threshold_sweep_float_edges(spark):
    scores = [0.1, 0.29, 0.3, 0.57, 0.58, 0.9, 0.0999999, 0.91, 0.5, 0.7]
    rows = [(s, i % 2) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = {round(r.threshold, 2): r for r in mt.threshold_sweep(df).collect()}
    P = sum(y for _, y in rows)
    for i in range(10, 91):
        t = i / 100.0
        tp = sum(1 for s, y in rows if y == 1 and s >= t)
        assert abs(got[round(t, 2)].recall - tp / P) < 1e-12, t


def test_optimal_threshold_fallback_and_lowest_tie(spark):
    none_ok = spark.createDataFrame([(0.95, 1), (0.05, 1), (0.06, 1), (0.5, 0)], "score double, label int")
    r = mt.optimal_threshold(none_ok).first()  # recall never reaches 0.8 in 0.10..0.89
    assert r.threshold == 0.5
    tie = spark.createDataFrame([(0.95, 1), (0.96, 1), (0.05, 0)], "score double, label int")
    assert mt.optimal_threshold(tie).first().threshold == 0.1  # every threshold has f1 1.0: lowest wins


def test_null_scores_and_labels_are_left_out_everywhere(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    more = spark.createDataFrame([*rows, (0, None), (1, None), (None, 0.95)], "label int, score double")
    for f in (mt.confusion, mt.binary_metrics, mt.roc_auc, mt.average_precision, mt.roc_curve, mt.pr_curve, mt.threshold_sweep, mt.optimal_threshold):
        assert sorted(map(repr, f(df).collect())) == sorted(map(repr, f(more).collect())), f.__name__
    assert tuple(mt.unscored(more).first()) == (7, 1, 2)


def test_all_null_column_correlates_with_nothing(spark):
    from riskframe.operators import features as feat

    df = spark.createDataFrame([(float(i), float(2 * i), None) for i in range(9)], "a double, b double, c double")
    assert feat.correlated_to_drop(df, ["a", "c", "b"], pairwise_complete=False) == ["b"]


def test_confusion_by_prediction_column(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, None)], "label int, prediction int")
    assert tuple(mt.confusion(df, prediction="prediction").first()) == (1, 1, 1, 1)


def test_split_counts_equal_the_driver_allocation(spark):
    from riskframe.operators.sampling import allocate_test_counts, class_counts, class_test_counts

    df = spark.createDataFrame([(c,) for c, n in (("a", 7), ("b", 13), ("c", 1), (None, 4)) for _ in range(n)], "y string")
    want = allocate_test_counts(class_counts(df, "y"))
    assert {r.y: r["__lim"] for r in class_test_counts(df, "y").collect()} == want
