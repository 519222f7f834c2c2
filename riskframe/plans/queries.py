"""Registered queries: each binds a library operator to the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables. Doubles are rounded to 6 places (the oracle does the same).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import preprocess as pp
from ..functions.scalar import logistic
from ..operators import profile
from ..session import scratch_path, written
from ..spec import SURVEY_BINARY, SURVEY_NUMERIC, SURVEY_SPEC, SURVEY_TARGET
from . import inputs
from .inputs import LINEITEM_NUMERIC, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
DEC = 6
# Learned-model queries run last (heaviest; Spark ML iterations).
LAST = ("lr_fit_score", "rf_fit_score", "gbt_fit_score", "tune_recall", "tune_logistic", "forest_search", "boosting_scores", "shap_trees", "shap_sampled", "explain_job",
        "registry_history", "train_job")


def ordered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    head = {k: v for k, v in QUERIES.items() if k not in LAST}
    return {**head, **{k: QUERIES[k] for k in LAST if k in QUERIES}}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        fn.query_name = name
        return fn
    return deco


def rounded(df: DataFrame, decimals: int = DEC) -> DataFrame:
    """Round every DOUBLE column (and +0.0 against negative zero)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(F.col(f.name).cast("double"), decimals) + F.lit(0.0)
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------------------
# Column statistics and single-column transforms on lineitem numerics
# ---------------------------------------------------------------------------

@query("quartiles")
def q_quartiles(spark, sf):
    """A1: exact Q1 / median / Q3 (linear interpolation) per numeric column."""
    li = table(spark, sf, "lineitem")
    q = profile.exact_quantiles(li, {c: F.col(c) for c in LINEITEM_NUMERIC}, [0.25, 0.5, 0.75])
    rows = [(c, *q[c]) for c in LINEITEM_NUMERIC]
    return rounded(spark.createDataFrame(rows, "column string, q1 double, median double, q3 double"))


@query("outlier_counts")
def q_outlier_counts(spark, sf):
    """A2: IQR caps and the number of values outside them, per column."""
    return rounded(pp.outlier_counts(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


@query("cap_outliers_iqr")
def q_cap_outliers(spark, sf):
    """Every numeric column clipped to its IQR caps (NULL kept)."""
    return rounded(pp.cap_outliers_iqr(inputs.lineitem_numeric(spark, sf), LINEITEM_NUMERIC))


@query("scaler_params")
def q_scaler_params(spark, sf):
    """A5: mean and population std per column."""
    return rounded(profile.moments(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


@query("standard_scale")
def q_standard_scale(spark, sf):
    """P10: (x - mean) / std_pop; zero std divides by 1."""
    return rounded(pp.standard_scale(inputs.lineitem_numeric(spark, sf), LINEITEM_NUMERIC))


# ---------------------------------------------------------------------------
# Profiles, encoding and imputation on the raw survey
# ---------------------------------------------------------------------------

@query("null_profile")
def q_null_profile(spark, sf):
    """A6 + A10: NULL count per column and the row count."""
    return profile.null_profile(inputs.raw_survey(spark, sf))


@query("null_columns")
def q_null_columns(spark, sf):
    """V7: only the columns that hold a NULL."""
    return profile.null_columns(inputs.raw_survey(spark, sf))


@query("distinct_values")
def q_distinct_values(spark, sf):
    """Distinct non-NULL values of every flag column of the raw survey."""
    cols = [c for c in SURVEY_BINARY if c != "gender"]
    return profile.distinct_values(inputs.raw_survey(spark, sf), cols)


@query("class_distribution")
def q_class_distribution(spark, sf):
    """Rows per target value of the survey."""
    return profile.value_counts(inputs.raw_survey(spark, sf), SURVEY_TARGET).withColumnRenamed("value", SURVEY_TARGET)


@query("median_fill_values")
def q_median_fill(spark, sf):
    """A3: exact median per numeric column, NULL ignored."""
    raw = inputs.raw_survey(spark, sf)
    cols = list(SURVEY_NUMERIC)
    q = profile.exact_quantiles(raw, {c: F.col(c) for c in cols}, [0.5])
    return rounded(spark.createDataFrame([(c, q[c][0]) for c in cols], "column string, median double"))


@query("mode_fill_values")
def q_mode_fill(spark, sf):
    """A4: most frequent value per flag column, lowest on a tie."""
    cols = [c for c in SURVEY_BINARY if c != "gender"]
    return rounded(profile.mode_values(inputs.raw_survey(spark, sf), cols))


@query("remap_binary")
def q_remap_binary(spark, sf):
    """P5: flag columns holding only 1/2 are remapped to 0/1."""
    raw = inputs.raw_survey(spark, sf)
    cols = [c for c in SURVEY_BINARY if c != "gender"]
    out, _ = pp.remap_binary(raw, cols)
    return out.select("row_id", *cols)


@query("impute")
def q_impute(spark, sf):
    """Numeric NULL <- median, flag NULL <- mode."""
    raw = inputs.raw_survey(spark, sf)
    modal = [c for c in SURVEY_BINARY if c != "gender"]
    out, _ = pp.impute(raw, list(SURVEY_NUMERIC), modal)
    return rounded(out.select("row_id", *SURVEY_NUMERIC, *modal))


@query("encode_target")
def q_encode_target(spark, sf):
    """Text target upper-cased and mapped, unmapped text -> NULL."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", pp.encode_target_expr(o, inputs.ORDERS_SPEC).alias("label"))


@query("encode_category")
def q_encode_category(spark, sf):
    """Text category mapped case-insensitively (O -> 1, F -> 0)."""
    li = table(spark, sf, "lineitem")
    spec = SURVEY_SPEC.with_(gender="l_linestatus", gender_mapping={"O": 1, "F": 0})
    return li.select("l_orderkey", "l_linenumber", pp.encode_gender_expr(li, spec).alias("code"))


@query("preprocess")
def q_preprocess(spark, sf):
    """Encode, remap, impute, cap, scale the raw survey (fit + transform)."""
    raw = inputs.raw_survey(spark, sf)
    out, _ = pp.preprocess(raw, SURVEY_SPEC)
    return rounded(out)


@query("preprocess_reload")
def q_preprocess_reload(spark, sf):
    """K4 + K5: fit, persist the parameter table, reload it, transform."""
    raw = inputs.raw_survey(spark, sf)
    params = pp.Preprocessor(SURVEY_SPEC).fit(raw)
    path = scratch_path(spark, "params")
    params.save(spark, path)
    loaded = pp.PreprocessParams.load(spark, path)
    return rounded(pp.transform(raw, SURVEY_SPEC, loaded))


@query("processed_roundtrip")
def q_processed_roundtrip(spark, sf):
    """K2: processed features + target written as parquet and read back."""
    raw = inputs.raw_survey(spark, sf)
    out, _ = pp.preprocess(raw, SURVEY_SPEC)
    path = scratch_path(spark, "processed")
    out.write.mode("overwrite").parquet(path)
    return rounded(spark.read.parquet(path))


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------

from ..operators import features as feat  # noqa: E402
from ..operators import validate as val  # noqa: E402
from ..spec import Rule  # noqa: E402

# Row rules of the event and customer checks.
EVENT_TYPES = ("view", "click", "purchase", "signup")
EVENT_RULES = (
    Rule("user_id", "required", code="missing:user_id"),
    Rule("event_type", "in", allowed=EVENT_TYPES, code="invalid:event_type"),
    Rule("value", "range", lo=0, hi=300, code="invalid:value"),
)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")
CUSTOMER_RULES = (
    Rule("c_mktsegment", "in", allowed=SEGMENTS, upper=True, code="invalid:segment"),
    Rule("c_nationkey", "range", lo=0, hi=24, code="invalid:nation"),
    Rule("c_acctbal", "range", lo=0, hi=None, code="negative:acctbal"),
)
DOMAIN_COLS = ("l_linenumber", "l_quantity", "l_discount")


@query("domain_violations")
def q_domain_violations(spark, sf):
    """V3: distinct values outside {0, 1} per column with their counts, NULL ignored."""
    return rounded(val.domain_violations(table(spark, sf, "lineitem"), DOMAIN_COLS))


@query("row_validate")
def q_row_validate(spark, sf):
    """V4: every rule code each event breaks, in rule order."""
    ev = val.with_errors(table(spark, sf, "events"), EVENT_RULES)
    return ev.select("event_id", F.size("errors").alias("n_errors"),
                     F.array_join("errors", ";").alias("errors"))


@query("quarantine_split")
def q_quarantine_split(spark, sf):
    """V4: rows that break a rule, with the first error (the single-record message)."""
    _, bad = val.quarantine_split(table(spark, sf, "events"), EVENT_RULES)
    return bad.select("event_id", "event_type", "value", F.col("errors")[0].alias("first_error"),
                      F.array_join("errors", ";").alias("errors"))


@query("field_constraints")
def q_field_constraints(spark, sf):
    """V5: declared field constraints (upper-cased text in a set, bounds)."""
    c = val.with_errors(table(spark, sf, "customer"), CUSTOMER_RULES)
    return c.select("c_custkey", F.array_join("errors", ";").alias("errors"))


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

def processed_survey(spark, sf):
    raw = inputs.raw_survey(spark, sf)
    out, _ = pp.preprocess(raw, SURVEY_SPEC)
    return out


@query("feat_product")
def q_feat_product(spark, sf):
    """smoking_impact = smoker * pack_years on the processed survey."""
    df = feat.add_derived_features(processed_survey(spark, sf))
    return rounded(df.select("row_id", "smoking_impact"))


@query("feat_row_sums")
def q_feat_row_sums(spark, sf):
    """NULL-tolerant row sums on the processed survey."""
    df = feat.add_derived_features(processed_survey(spark, sf))
    return rounded(df.select("row_id", *[n for n, _ in feat.ROW_SUMS]))


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    """Pearson correlation of every pair of lineitem numerics (long form)."""
    return rounded(feat.corr_matrix(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


def document_measures(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", "n_chars",
        F.length("text").cast("bigint").alias("text_length"),
        F.size(F.split("text", " ")).cast("bigint").alias("n_words"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
    )


DOC_MEASURES = ("n_chars", "text_length", "n_words", "n_lines")


@query("drop_correlated")
def q_drop_correlated(spark, sf):
    """names of columns dropped for |corr| > 0.95 with an earlier column."""
    dropped = feat.correlated_to_drop(document_measures(spark, sf), DOC_MEASURES)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


@query("build_features")
def q_build_features(spark, sf):
    """derived features + correlation drop on the processed survey,
    returned long as (row_id, feature, value)."""
    df = processed_survey(spark, sf)
    out, _ = feat.build_features(df.drop(SURVEY_TARGET), exclude=("row_id",), null_free=True)
    cols = [c for c in out.columns if c != "row_id"]
    long = out.select("row_id", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ["row_id"], cols, "feature", "value")
    return rounded(long)


# ---------------------------------------------------------------------------
# Splits, folds, weights, samples
# ---------------------------------------------------------------------------

from ..operators import metrics as mt  # noqa: E402
from ..operators import sampling as smp  # noqa: E402
from ..spec import GLOBAL_BACKGROUND_ROWS  # noqa: E402


@query("stratified_split")
def q_stratified_split(spark, sf):
    """Exact stratified 80/20 split of orders by status, hash-ranked."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return smp.stratified_split(o, "o_orderstatus", "o_orderkey")


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    """R2: stratified 5 folds of orders by status."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return smp.stratified_folds(o, "o_orderstatus", "o_orderkey")


@query("class_weights")
def q_class_weights(spark, sf):
    """Balanced class weights n / (k * n_c)."""
    return smp.class_weights(table(spark, sf, "orders"), "o_orderstatus")


@query("background_sample")
def q_background_sample(spark, sf):
    """The 100-row background sample (hash order, top-k)."""
    o = table(spark, sf, "orders").select("o_orderkey")
    return smp.background_sample(o, "o_orderkey", GLOBAL_BACKGROUND_ROWS)


# ---------------------------------------------------------------------------
# Evaluation on scored lineitem (ties across classes) and the scored survey
# ---------------------------------------------------------------------------

@query("confusion")
def q_confusion(spark, sf):
    """Tn / fp / fn / tp at 0.5."""
    return mt.confusion(inputs.scored_lineitem(spark, sf))


@query("binary_metrics")
def q_binary_metrics(spark, sf):
    """Accuracy / recall / precision / f1 at 0.5."""
    return rounded(mt.binary_metrics(inputs.scored_lineitem(spark, sf)))


@query("roc_auc")
def q_roc_auc(spark, sf):
    """ROC-AUC with half credit for ties."""
    return rounded(mt.roc_auc(inputs.scored_lineitem(spark, sf)))


@query("average_precision")
def q_average_precision(spark, sf):
    """Step-wise average precision."""
    return rounded(mt.average_precision(inputs.scored_lineitem(spark, sf)))


@query("roc_curve")
def q_roc_curve(spark, sf):
    """ROC points per distinct score plus the origin."""
    return rounded(mt.roc_curve(inputs.scored_lineitem(spark, sf)))


@query("pr_curve")
def q_pr_curve(spark, sf):
    """Precision-recall points plus the (recall 0, precision 1) end."""
    return rounded(mt.pr_curve(inputs.scored_lineitem(spark, sf)))


@query("threshold_sweep")
def q_threshold_sweep(spark, sf):
    """Recall / precision / f1 at 81 thresholds 0.10..0.90."""
    return rounded(mt.threshold_sweep(inputs.scored_lineitem(spark, sf)))


@query("optimal_threshold")
def q_optimal_threshold(spark, sf):
    """Best-f1 threshold among those with recall >= 0.8 (0.10..0.89)."""
    return rounded(mt.optimal_threshold(inputs.scored_survey(spark, sf)))


@query("classification_report")
def q_classification_report(spark, sf):
    """E5: per-class report with accuracy, macro and weighted averages."""
    s = inputs.scored_lineitem(spark, sf).withColumn("prediction", mt.predict_at("score", 0.5))
    return rounded(mt.classification_report(s))


def _survey_folds(spark, sf):
    s = inputs.scored_survey(spark, sf)
    return smp.stratified_folds(s, "label", "row_id")


@query("cv_metrics")
def q_cv_metrics(spark, sf):
    """Per-fold recall / precision / f1 / balanced accuracy / ROC-AUC."""
    return rounded(mt.cv_metrics(_survey_folds(spark, sf)))


@query("cv_summary")
def q_cv_summary(spark, sf):
    """Mean and population std of the fold metrics."""
    return rounded(mt.cv_summary(mt.cv_metrics(_survey_folds(spark, sf))))


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

from ..operators import explain as xp  # noqa: E402
from ..operators import logistic as lg  # noqa: E402
from ..operators import trees as tr  # noqa: E402
from ..operators import models as md  # noqa: E402
from ..sources import files  # noqa: E402
from ..sources import registry as reg  # noqa: E402
from . import jobs  # noqa: E402


@query("scan_csv")
def q_scan_csv(spark, sf):
    """S1 + K1: customer written as CSV with a header, read back by header name."""
    c = table(spark, sf, "customer")
    path = files.save_csv(c, scratch_path(spark, "csv"))
    return files.load_csv(spark, path, c.schema)


@query("json_records_scan")
def q_json_records_scan(spark, sf):
    """JSON text parsed with a declared schema."""
    ev = table(spark, sf, "events").select("event_id", "props")
    return files.parse_json_column(ev, "props", "k BIGINT").select("event_id", "k")


@query("append_records")
def q_append_records(spark, sf):
    """K3 + U1 + S4: suppliers appended to customers; the missing segment is NULL."""
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    path = scratch_path(spark, "append")
    base.write.mode("overwrite").parquet(path)
    files.append_records(path, new)
    return files.read_appended(spark, path).select("key", "name", "nationkey", "acctbal", "segment")


@query("next_version")
def q_next_version(spark, sf):
    """A12 + K6: next version = max parsed number + 1 (unparsable names skipped)."""
    return reg.next_version(table(spark, sf, "customer"), "c_name", "Customer#")


@query("project_reorder")
def q_project_reorder(spark, sf):
    """A fixed column order."""
    return table(spark, sf, "customer").select("c_mktsegment", "c_acctbal", "c_name", "c_custkey", "c_nationkey")


@query("fill_missing_columns")
def q_fill_missing_columns(spark, sf):
    """Absent required columns added with 0."""
    c = table(spark, sf, "customer")
    return pp.fill_missing_columns(c, [*c.columns, "c_phone", "c_comment"])


@query("first_row")
def q_first_row(spark, sf):
    """L1: the first row by key."""
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(1)


# ---------------------------------------------------------------------------
# Scoring with a fixed linear bundle, and its exact Shapley values
# ---------------------------------------------------------------------------

# A serving bundle's linear model over processed survey features.
FIXED_LINEAR = md.LinearModel(intercept=-1.0, weights={
    "pack_years": 1.2, "family_history_cancer": 0.9, "occupational_exposure": 0.7, "air_pollution_index": 0.3,
    "xray_abnormal": 0.6, "copd": 0.5, "age": 0.4, "smoker": 0.8, "passive_smoking": 0.25, "radon_exposure": 0.35,
    "asthma": 0.15, "previous_tb": 0.45, "chronic_cough": 0.55, "chest_pain": 0.65, "fatigue": 0.1, "bmi": -0.2,
    "oxygen_saturation": -0.75, "crp_level": 0.05, "exercise_hours_per_week": -0.12, "diet_quality": -0.02,
})


def fixed_bundle(raw):
    params = pp.Preprocessor(SURVEY_SPEC).fit(raw)
    return jobs.Bundle(SURVEY_SPEC, params, [], list(FIXED_LINEAR.weights), FIXED_LINEAR)


@query("logistic_score")
def q_logistic_score(spark, sf):
    """Logistic function of an order's total price."""
    o = table(spark, sf, "orders")
    return rounded(o.select("o_orderkey", logistic(F.col("o_totalprice") / F.lit(100000.0), 2.0, 1.5).alias("probability")))


@query("risk_level")
def q_risk_level(spark, sf):
    """Risk band, 4-place probability and label text from a probability."""
    s = inputs.scored_survey(spark, sf)
    cols = md.score_columns(F.col("score"))
    return rounded(s.select("row_id", *[v.alias(k) for k, v in cols.items()]))


@query("score_batch")
def q_score_batch(spark, sf):
    """M7: validate -> encode -> remap -> impute -> cap -> scale -> features -> model -> risk."""
    raw = inputs.raw_survey(spark, sf)
    scored, _ = jobs.score(raw, fixed_bundle(raw))
    return rounded(scored)


def _processed_for_shap(spark, sf):
    raw = inputs.raw_survey(spark, sf)
    return jobs.prepare(raw, fixed_bundle(raw))


@query("shap_linear")
def q_shap_linear(spark, sf):
    """X1(a): exact linear Shapley values on the log-odds, long form."""
    return rounded(xp.shap_linear(_processed_for_shap(spark, sf), FIXED_LINEAR, "row_id"))


@query("shap_global_topk")
def q_shap_global_topk(spark, sf):
    """X2 + L3: mean |phi| per feature, top 15."""
    return rounded(xp.global_importance(xp.shap_linear(_processed_for_shap(spark, sf), FIXED_LINEAR, "row_id")))


@query("shap_distribution")
def q_shap_distribution(spark, sf):
    """(row, feature, value, phi) of the top features."""
    return rounded(xp.distribution(xp.shap_linear(_processed_for_shap(spark, sf), FIXED_LINEAR, "row_id")))


@query("shap_waterfall")
def q_shap_waterfall(spark, sf):
    """The first row's contributions by |phi| with the running total from the base value."""
    df = _processed_for_shap(spark, sf)
    phi = xp.shap_linear(df, FIXED_LINEAR, "row_id")
    first = df.agg(F.min("row_id")).first()[0]
    means = df.agg(*[F.avg(c).alias(c) for c in FIXED_LINEAR.weights]).first()
    base = FIXED_LINEAR.intercept + sum(w * means[c] for c, w in FIXED_LINEAR.weights.items())
    return rounded(xp.waterfall(phi, "row_id", first, base))


# ---------------------------------------------------------------------------
# Learned models (property checks; no SQL oracle)
# ---------------------------------------------------------------------------

def _model_data(spark, sf):
    """Training and test parts of the processed survey, with folds and balanced weights."""
    train_raw, test_raw = jobs.split_labelled(inputs.raw_survey(spark, sf), SURVEY_SPEC)
    bundle, built = jobs.fit_bundle(train_raw, SURVEY_SPEC)
    train = built.withColumn("label", F.col(SURVEY_TARGET).cast("double"))
    train = written(smp.with_class_weights(smp.stratified_folds(train, "label", "row_id"), "label"), "train")
    test = jobs.prepare(test_raw, bundle).withColumn("label", F.col(SURVEY_TARGET).cast("double"))
    return bundle, train, test


def _fit_score(spark, sf, family):
    bundle, train, test = _model_data(spark, sf)
    setting = smp.draw_settings(md.GRIDS[family], 1)[0] if family != "logistic_regression" else {"C": 1.0}
    model = md.fit(train, bundle.features, family, setting)
    out = md.predict(model, test, keep=("row_id", "label"))
    return rounded(out)


@query("lr_fit_score")
def q_lr_fit_score(spark, sf):
    """M1 + M6: balanced L2 logistic regression fitted on the training split, test rows scored."""
    return _fit_score(spark, sf, "logistic_regression")


@query("rf_fit_score")
def q_rf_fit_score(spark, sf):
    """M2: balanced random forest (first drawn setting), test rows scored."""
    return _fit_score(spark, sf, "random_forest")


@query("gbt_fit_score")
def q_gbt_fit_score(spark, sf):
    """M3: gradient-boosted trees (first drawn setting), test rows scored."""
    return _fit_score(spark, sf, "gradient_boosting")


@query("tune_recall")
def q_tune_recall(spark, sf):
    """M4 + M5: random search of the logistic grid over stratified folds by recall; best first."""
    bundle, train, _ = _model_data(spark, sf)
    _, results = md.tune(train, bundle.features, "logistic_regression", 20)
    best = md.select_best(results).withColumn("best", F.lit(True))
    return rounded(results.join(best.select("setting", "best"), "setting", "left").fillna(False, ["best"]))


@query("tune_logistic")
def q_tune_logistic(spark, sf):
    """M4: the whole logistic grid on all folds in shared passes. Per setting and fold: rows and positives
    held out, balanced weight of a positive in the training part, and whether recall is a share and the
    penalised gradient is zero at the coefficients (one more pass over the rows)."""
    bundle, train, _ = _model_data(spark, sf)
    settings = smp.param_combinations(md.GRIDS["logistic_regression"])
    found = lg.search(train, bundle.features, settings)
    steep = lg.gradients(train, bundle.features, settings, found)
    steep = spark.createDataFrame([(d, f, g < 1e-6) for (d, f), g in steep.items() if f is not None], "draw int, fold int, optimal boolean")  # a row per model
    folds = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n_held_out"), F.sum("label").cast("long").alias("n_held_positive"))
    every = Window.partitionBy()  # over a row per fold
    n, pos = F.sum("n_held_out").over(every) - F.col("n_held_out"), F.sum("n_held_positive").over(every) - F.col("n_held_positive")
    folds = folds.withColumn("positive_weight", n / (2 * pos))
    out = found.recalls.withColumn("recall_fits", (F.col("n_found") <= F.col("n_positive")) & F.col("recall").between(0, 1))
    out = out.join(steep, ["draw", "fold"]).join(folds, "fold")
    return rounded(out.select("draw", "c", "fold", "n_held_out", "n_positive", "positive_weight", "optimal", "recall_fits"))


@query("forest_search")
def q_forest_search(spark, sf):
    """M2 + M4: forests that differ in the smallest split, on all folds, grown in shared passes; recall per setting and fold."""
    bundle, train, _ = _model_data(spark, sf)
    settings = [{"n_estimators": 10, "max_depth": 5, "min_samples_split": k} for k in md.GRIDS["random_forest"]["min_samples_split"]]
    _, recalls = tr.search(train, bundle.features, "random_forest", settings, key="row_id")
    return rounded(recalls)


@query("boosting_scores")
def q_boosting_scores(spark, sf):
    """M3: second-order boosting with rows and columns drawn per tree, fitted on the training part, test rows scored."""
    model, test = _boosted(spark, sf)
    return rounded(model.score(test, ["row_id", "label"]))


@query("shap_trees")
def q_shap_trees(spark, sf):
    """X1 + X2: exact path-dependent Shapley values of the boosted trees on the test rows, importance of the first 15 features."""
    model, test = _boosted(spark, sf)
    return rounded(xp.global_importance(xp.shap_trees(test, model, "row_id")))


def _boosted(spark, sf):
    bundle, train, test = _model_data(spark, sf)
    setting = tr.Setting.of("gradient_boosting", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7})
    return tr.fit(train, bundle.features, [setting], key="row_id")[0], test


@query("shap_sampled")
def q_shap_sampled(spark, sf):
    """X1(b): permutation-sampling Shapley values of a fitted logistic model on the test rows."""
    bundle, train, test = _model_data(spark, sf)
    model = md.fit(train, bundle.features, "logistic_regression", {"C": 1.0})
    return rounded(xp.shap_sampled(test, model, bundle.features, "row_id", background=train, permutations=4))


@query("report_json")
def q_report_json(spark, sf):
    """K9 + C3: every evaluation table of a scored table as one JSON document each."""
    return jobs.report_json(jobs.evaluate(inputs.scored_survey(spark, sf)))


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

from ..streaming import jobs as sj  # noqa: E402


@query("stream_score")
def q_stream_score(spark, sf):
    """ST1: raw survey records arriving as files, scored by a file stream (availableNow)."""
    raw = inputs.raw_survey(spark, sf)
    src = scratch_path(spark, "stream-src")
    raw.write.mode("overwrite").parquet(src)
    batch_raw = spark.read.parquet(src)
    out, _, _ = sj.stream_score(spark, src, batch_raw.schema, fixed_bundle(batch_raw))
    return rounded(sj.read_landed(spark, out))


@query("stream_append")
def q_stream_append(spark, sf):
    """ST2: event records landing in two parts, appended by two runs of a stream; rule breakers quarantined."""
    ev = table(spark, sf, "events")
    src = scratch_path(spark, "events-src")  # records land as files in a folder
    first = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    ev.where(first).write.parquet(src)
    out, _, _ = sj.stream_append(spark, src, ev.schema, EVENT_RULES)
    ev.where(~first).write.mode("append").parquet(src)
    sj.stream_append(spark, src, ev.schema, EVENT_RULES, out_path=out)
    return sj.read_landed(spark, out)


# ---------------------------------------------------------------------------
# Oversampling
# ---------------------------------------------------------------------------

from ..operators import smote as sm  # noqa: E402


@query("smote_knn")
def q_smote_knn(spark, sf):
    """Exact 5 nearest neighbours of every embedding inside its class."""
    e = table(spark, sf, "embeddings")
    return rounded(sm.knn_within_class(e, "vec_id", "label", "embedding", k=5))


@query("smote_balance")
def q_smote_balance(spark, sf):
    """Class counts after oversampling every class up to the largest."""
    e = table(spark, sf, "embeddings")
    out = sm.oversample(e, "vec_id", "label", "embedding", k=5)
    return out.groupBy("label").agg(
        F.count_if(~F.col("synthetic")).alias("n_original"), F.count_if(F.col("synthetic")).alias("n_synthetic"),
        F.count(F.lit(1)).alias("n_total"))


@query("smote_rows")
def q_smote_rows(spark, sf):
    """The synthetic embeddings with their base row, neighbour and gap."""
    e = table(spark, sf, "embeddings")
    out = sm.oversample(e, "vec_id", "label", "embedding", k=5).where(F.col("synthetic"))
    return rounded(out.select("vec_id", "label", "base_id", "nn_id", "gap",
                              F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding")))


@query("registry_history")
def q_registry_history(spark, sf):
    """K6-K8 + K10 + L2: a logistic model trained on the survey saved twice under
    versions 1 and 2, metadata appended, versions listed in numeric order."""
    bundle, train, test = _model_data(spark, sf)
    model = md.fit(train, bundle.features, "logistic_regression", {"C": 1.0})
    scored = md.predict(model, test, keep=("row_id", "label")).withColumnRenamed("probability", "score")
    auc = mt.roc_auc(scored).first()[0]
    root = scratch_path(spark, "models")
    n = train.count()
    for _ in range(2):
        reg.save_model(spark, root, model, "logistic_regression", n, {"roc_auc": auc, "best_model": "lr"})
    return reg.list_versions(spark, root).select("version", "model_type", "n_rows", "metrics")


@query("registry_list")
def q_registry_list(spark, sf):
    """K6 + K10 + L2 + S7: the serving model committed with the rows that three tables have, listed in
    numeric order; whether the latest loads as it was saved."""
    root = scratch_path(spark, "models")
    for name in ("customer", "orders", "lineitem"):
        reg.save_model(spark, root, FIXED_LINEAR, name, spark.read.parquet(f"{sf}/{name}.parquet").count(), {"best_model": name})
    loads = md.LinearModel.load(spark, f"{reg.version_path(spark, root)[1]}/model") == FIXED_LINEAR
    return reg.list_versions(spark, root).select("version", "model_type", "n_rows", "metrics", F.lit(loads).alias("loads"))


@query("evaluate_job")
def q_evaluate_job(spark, sf):
    """The evaluation job's headline row (metrics at 0.5, AUC, AP, chosen threshold)."""
    tables = jobs.evaluate(inputs.scored_lineitem(spark, sf))
    extra = {
        "roc_auc": tables["roc_auc"].first()[0],
        "average_precision": tables["average_precision"].first()[0],
        "optimal_threshold": tables["optimal_threshold"].first()["threshold"],
    }
    m = tables["metrics"].select("accuracy", "recall", "precision", "f1")
    return rounded(m.withColumns({k: F.lit(v).cast("double") for k, v in extra.items()}))


@query("explain_job")
def q_explain_job(spark, sf):
    """C4: a fitted logistic bundle explained on the test rows (sampled Shapley);
    the global top-15 importance table."""
    bundle, train, test = _model_data(spark, sf)
    bundle.model = md.fit(train, bundle.features, "logistic_regression", {"C": 1.0})
    tables = jobs.explain(test, bundle, "row_id", permutations=4)
    return rounded(tables["global"])


@query("train_job")
def q_train_job(spark, sf):
    """C2 + C3 + C5: the retraining sequence with one logistic setting: rows of both parts, rows
    scored, the version read back, and whether every probability and metric lies in [0, 1]."""
    raw = inputs.raw_survey(spark, sf)
    root = scratch_path(spark, "models")
    bundle, _ = jobs.retrain(raw, None, SURVEY_SPEC, families=("logistic_regression",), n_iter=1, registry_root=root)
    _, held_out = jobs.split_labelled(raw, SURVEY_SPEC)
    scored = jobs.score_labelled(held_out, jobs.load_bundle(spark, root, SURVEY_SPEC))
    metrics = bundle.meta["metrics"].values()
    return scored.agg(
        F.lit(bundle.meta["n_rows"]).cast("long").alias("n_train"), F.count(F.lit(1)).alias("n_test"), F.sum("label").cast("long").alias("n_positive"),
        F.lit(reg.latest_version(spark, root)).cast("long").alias("version"), (F.count_if(~F.col("score").between(0, 1)) == 0).alias("probabilities_fit"),
        F.lit(all(m is not None and 0 <= m <= 1 for m in metrics)).alias("metrics_fit"))
