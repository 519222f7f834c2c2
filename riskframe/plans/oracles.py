"""DuckDB SQL text used as the independent oracle of each query.

Built from the same fixed values as the Spark code (column lists, ranges,
probabilities) so that both sides state one configuration.
"""

from __future__ import annotations

from ..spec import SURVEY_BINARY, SURVEY_COLUMNS, SURVEY_NUMERIC, SURVEY_TARGET
from . import inputs


def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def raw_survey_sql() -> str:
    return f"({inputs.survey_select(f'({inputs.ORDER_LINES})')})"


def scored_survey_sql() -> str:
    rows = inputs.survey_select(f"({inputs.ORDER_LINES})", f", {inputs.SCORE_FROM_ORDERS} AS score")
    return f"(SELECT row_id, CAST({SURVEY_TARGET} = 'YES' AS INTEGER) AS label, score FROM ({rows}))"


def encoded_survey_sql() -> str:
    """Raw survey with text gender / target mapped to numbers."""
    sel = []
    for c in SURVEY_COLUMNS:
        if c == "gender":
            e = ("CASE upper(gender) WHEN 'M' THEN 1 WHEN 'F' THEN 0 WHEN 'MALE' THEN 1 WHEN 'FEMALE' THEN 0 "
                 "WHEN '1' THEN 1 WHEN '0' THEN 0 END")
        elif c == SURVEY_TARGET:
            e = f"CASE upper({c}) WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 WHEN '1' THEN 1 WHEN '0' THEN 0 END"
        elif c in SURVEY_NUMERIC:
            e = f"CAST({c} AS DOUBLE)"
        else:
            e = f"CAST({c} AS INTEGER)"
        sel.append(f"{e} AS {c}")
    return f"(SELECT row_id, {', '.join(sel)} FROM {raw_survey_sql()})"


def mode_sql(table: str, col: str) -> str:
    return (f"(SELECT v FROM (SELECT CAST({col} AS DOUBLE) AS v, count(*) AS n FROM {table} "
            f"WHERE {col} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v ASC LIMIT 1)")


def clip_sql(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END)"


def preprocess_sql(decimals: int = 6) -> str:
    """Fit and transform of the raw survey in SQL: remap, impute, cap, scale."""
    enc = encoded_survey_sql()
    binary = list(SURVEY_BINARY)
    numeric = list(SURVEY_NUMERIC)
    remap = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (1, 2)) = 0 AS r_{c}" for c in binary
    )
    mode_ctes = ", ".join(
        f"pm_{c} AS (SELECT CAST({c} AS DOUBLE) AS m_{c} FROM e WHERE {c} IS NOT NULL GROUP BY 1 "
        f"ORDER BY count(*) DESC, 1 ASC LIMIT 1)" for c in binary
    )
    mode_from = ", ".join(f"pm_{c}" for c in binary)
    med = ", ".join(f"quantile_cont({c}, 0.5) AS f_{c}" for c in numeric)
    quart = ", ".join(
        f"quantile_cont(coalesce({c}, f_{c}), 0.25) AS q1_{c}, quantile_cont(coalesce({c}, f_{c}), 0.75) AS q3_{c}"
        for c in numeric
    )
    caps = ", ".join(
        f"q1_{c} - 1.5 * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + 1.5 * (q3_{c} - q1_{c}) AS hi_{c}" for c in numeric
    )
    mom = ", ".join(
        f"avg({clip_sql(f'coalesce({c}, f_{c})', f'lo_{c}', f'hi_{c}')}) AS mu_{c}, "
        f"stddev_pop({clip_sql(f'coalesce({c}, f_{c})', f'lo_{c}', f'hi_{c}')}) AS sd_{c}"
        for c in numeric
    )
    out = []
    for c in SURVEY_COLUMNS:
        if c == SURVEY_TARGET:
            continue
        if c in binary:
            v = f"(CASE WHEN r_{c} THEN {c} - 1 ELSE {c} END)"
            fill = f"(CASE WHEN r_{c} THEN m_{c} - 1 ELSE m_{c} END)"
            out.append(f"CAST(coalesce({v}, CAST({fill} AS INTEGER)) AS INTEGER) AS {c}")
        else:
            x = clip_sql(f"coalesce({c}, f_{c})", f"lo_{c}", f"hi_{c}")
            v = f"({x} - mu_{c}) / (CASE WHEN sd_{c} = 0 THEN 1.0 ELSE sd_{c} END)"
            out.append(f"round({v}, {decimals}) + 0.0 AS {c}" if decimals is not None else f"{v} AS {c}")
    out.append(f"{SURVEY_TARGET}")
    return f"""
    WITH e AS MATERIALIZED (SELECT * FROM {enc}),
    pr AS (SELECT {remap} FROM e),
    {mode_ctes},
    pf AS (SELECT {med} FROM e),
    pq AS (SELECT {quart} FROM e, pf),
    pc AS (SELECT {caps} FROM pq),
    ps AS (SELECT {mom} FROM e, pf, pc),
    par AS MATERIALIZED (SELECT * FROM pr, {mode_from}, pf, pc, ps)
    SELECT row_id, {', '.join(out)} FROM e, par"""


# ---------------------------------------------------------------------------
# Oracle text per query
# ---------------------------------------------------------------------------

ORACLES: dict[str, str] = {}
LI_NUM = inputs.LINEITEM_NUMERIC
FLAGS = [c for c in SURVEY_BINARY if c != "gender"]


def _round_all(cols, decimals=6):
    return ", ".join(f"round({c}, {decimals}) + 0.0 AS {c}" for c in cols)


ORACLES["quartiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.25), 6) + 0.0 AS q1, "
    f"round(quantile_cont({c}, 0.5), 6) + 0.0 AS median, round(quantile_cont({c}, 0.75), 6) + 0.0 AS q3 FROM lineitem"
    for c in LI_NUM
)

_caps_cte = "caps AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in LI_NUM
) + " FROM lineitem), lim AS (SELECT *, " + ", ".join(
    f"q1_{c} - 1.5 * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + 1.5 * (q3_{c} - q1_{c}) AS hi_{c}" for c in LI_NUM
) + " FROM caps)"

ORACLES["outlier_counts"] = f"WITH {_caps_cte} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(q1_{c}, 6) + 0.0 AS q1, round(q3_{c}, 6) + 0.0 AS q3, "
    f"round(lo_{c}, 6) + 0.0 AS cap_lo, round(hi_{c}, 6) + 0.0 AS cap_hi, "
    f"CAST((SELECT count(*) FROM lineitem WHERE {c} < lo_{c} OR {c} > hi_{c}) AS BIGINT) AS n_outliers FROM lim"
    for c in LI_NUM
)

ORACLES["cap_outliers_iqr"] = f"WITH {_caps_cte} SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({clip_sql(c, f'lo_{c}', f'hi_{c}')}, 6) + 0.0 AS {c}" for c in LI_NUM
) + " FROM lineitem, lim"

ORACLES["scaler_params"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg({c}), 6) + 0.0 AS mean, round(stddev_pop({c}), 6) + 0.0 AS std FROM lineitem"
    for c in LI_NUM
)

ORACLES["standard_scale"] = "WITH m AS (SELECT " + ", ".join(
    f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_NUM
) + ") SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - mu_{c}) / (CASE WHEN sd_{c} = 0 THEN 1.0 ELSE sd_{c} END), 6) + 0.0 AS {c}" for c in LI_NUM
) + " FROM lineitem, m"
ORACLES["standard_scale"] = ORACLES["standard_scale"].replace(") SELECT l_orderkey", " FROM lineitem) SELECT l_orderkey", 1)

_raw = raw_survey_sql()
ORACLES["null_profile"] = f"WITH r AS (SELECT * FROM {_raw}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, CAST(count(*) AS BIGINT) AS n_rows FROM r"
    for c in ("row_id", *SURVEY_COLUMNS)
)
ORACLES["null_columns"] = f"SELECT * FROM ({ORACLES['null_profile']}) WHERE n_null > 0"
ORACLES["distinct_values"] = f"WITH r AS (SELECT * FROM {_raw}) " + " UNION ".join(
    f"SELECT DISTINCT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM r WHERE {c} IS NOT NULL" for c in FLAGS
)
ORACLES["class_distribution"] = (
    f"SELECT {SURVEY_TARGET}, CAST(count(*) AS BIGINT) AS n FROM {_raw} GROUP BY 1"
)
ORACLES["median_fill_values"] = f"WITH r AS (SELECT * FROM {_raw}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.5), 6) + 0.0 AS median FROM r" for c in SURVEY_NUMERIC
)
ORACLES["mode_fill_values"] = f"WITH r AS (SELECT * FROM {_raw}), " + ", ".join(
    f"c_{c} AS (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS n FROM r WHERE {c} IS NOT NULL GROUP BY 1)" for c in FLAGS
) + " " + " UNION ALL ".join(
    f"(SELECT '{c}' AS column, round(v, 6) + 0.0 AS value, CAST(n AS BIGINT) AS n FROM c_{c} ORDER BY n DESC, v ASC LIMIT 1)"
    for c in FLAGS
)
ORACLES["remap_binary"] = f"WITH r AS (SELECT * FROM {_raw}), f AS (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (1, 2)) = 0 AS r_{c}" for c in FLAGS
) + " FROM r) SELECT row_id, " + ", ".join(
    f"CAST(CASE WHEN r_{c} THEN {c} - 1 ELSE {c} END AS INTEGER) AS {c}" for c in FLAGS
) + " FROM r, f"
ORACLES["impute"] = f"WITH r AS (SELECT * FROM {_raw}), f AS (SELECT " + ", ".join(
    [f"quantile_cont({c}, 0.5) AS f_{c}" for c in SURVEY_NUMERIC]
    + [f"{mode_sql('r', c)} AS m_{c}" for c in FLAGS]
) + " FROM r) SELECT row_id, " + ", ".join(
    [f"round(coalesce(CAST({c} AS DOUBLE), f_{c}), 6) + 0.0 AS {c}" for c in SURVEY_NUMERIC]
    + [f"CAST(coalesce({c}, CAST(m_{c} AS INTEGER)) AS INTEGER) AS {c}" for c in FLAGS]
) + " FROM r, f"
ORACLES["encode_target"] = (
    "SELECT o_orderkey, CASE upper(o_orderstatus) WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label FROM orders"
)
ORACLES["encode_category"] = (
    "SELECT l_orderkey, l_linenumber, CASE upper(l_linestatus) WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS code FROM lineitem"
)
ORACLES["preprocess"] = preprocess_sql()
ORACLES["preprocess_reload"] = ORACLES["preprocess"]
ORACLES["processed_roundtrip"] = ORACLES["preprocess"]

_rules_events = [
    ("user_id IS NULL", "missing:user_id"),
    ("event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup')", "invalid:event_type"),
    ("value IS NOT NULL AND (value < 0 OR value > 300)", "invalid:value"),
]


def _errors_sql(rules):
    arr = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for cond, code in rules)
    return f"list_filter([{arr}], lambda x: x IS NOT NULL)"


ORACLES["domain_violations"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS value, CAST(count(*) AS BIGINT) AS n FROM lineitem "
    f"WHERE {c} IS NOT NULL AND CAST({c} AS DOUBLE) NOT IN (0.0, 1.0) GROUP BY 2"
    for c in ("l_linenumber", "l_quantity", "l_discount")
)
ORACLES["row_validate"] = (
    f"SELECT event_id, CAST(len(e) AS INTEGER) AS n_errors, array_to_string(e, ';') AS errors "
    f"FROM (SELECT event_id, {_errors_sql(_rules_events)} AS e FROM events)"
)
ORACLES["quarantine_split"] = (
    f"SELECT event_id, event_type, value, e[1] AS first_error, array_to_string(e, ';') AS errors "
    f"FROM (SELECT *, {_errors_sql(_rules_events)} AS e FROM events) WHERE len(e) > 0"
)
ORACLES["field_constraints"] = (
    "SELECT c_custkey, array_to_string(" + _errors_sql([
        ("c_mktsegment IS NOT NULL AND upper(c_mktsegment) NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD')", "invalid:segment"),
        ("c_nationkey IS NOT NULL AND (c_nationkey < 0 OR c_nationkey > 24)", "invalid:nation"),
        ("c_acctbal IS NOT NULL AND c_acctbal < 0", "negative:acctbal"),
    ]) + ", ';') AS errors FROM customer"
)

_PROC = f"p AS MATERIALIZED ({preprocess_sql(decimals=None)})"


def _null_sum_sql(cols):
    return "(" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols) + ")"


_F_SUMS = {
    "clinical_severity_score": ("chest_pain", "fatigue", "xray_abnormal"),
    "SYMPTOM_COUNT": SURVEY_BINARY,
    "lifestyle_health_score": ("exercise_hours_per_week", "diet_quality", "healthcare_access"),
    "respiratory_condition_score": ("copd", "asthma", "previous_tb", "chronic_cough", "shortness_of_breath"),
}
ORACLES["feat_product"] = (
    f"WITH {_PROC} SELECT row_id, round(CAST(smoker AS DOUBLE) * pack_years, 6) + 0.0 AS smoking_impact FROM p"
)
ORACLES["feat_row_sums"] = f"WITH {_PROC} SELECT row_id, " + ", ".join(
    f"round({_null_sum_sql(v)}, 6) + 0.0 AS {k}" for k, v in _F_SUMS.items()
) + " FROM p"


def _corr_sql(a, b, src):
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({a}, {b}) / "
            f"nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6) + 0.0 AS corr FROM {src}")


ORACLES["corr_matrix"] = " UNION ALL ".join(
    _corr_sql(LI_NUM[i], LI_NUM[j], "lineitem") for i in range(len(LI_NUM)) for j in range(i + 1, len(LI_NUM))
)
_DOCS = ("n_chars", "text_length", "n_words", "n_lines")
_DOC_SRC = ("(SELECT n_chars, CAST(length(text) AS BIGINT) AS text_length, "
            "CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words, "
            "CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM documents)")


def _drop_sql(cols, src):
    pairs = " UNION ALL ".join(
        f"SELECT {j} AS pos, '{cols[j]}' AS cname, covar_pop({cols[i]}, {cols[j]}) / "
        f"nullif(stddev_pop({cols[i]}) * stddev_pop({cols[j]}), 0) AS corr FROM s"
        for i in range(len(cols)) for j in range(i + 1, len(cols))
    )
    return f"WITH s AS MATERIALIZED (SELECT * FROM {src}), pr AS ({pairs}) SELECT DISTINCT cname AS \"column\" FROM pr WHERE abs(corr) > 0.95"


ORACLES["drop_correlated"] = _drop_sql(_DOCS, _DOC_SRC)

_FEAT_COLS = [c for c in SURVEY_COLUMNS if c != SURVEY_TARGET] + ["smoking_impact", *_F_SUMS]


def _build_features_sql():
    derived = ", ".join(
        [f"CAST(smoker AS DOUBLE) * pack_years AS smoking_impact"]
        + [f"{_null_sum_sql(v)} AS {k}" for k, v in _F_SUMS.items()]
    )
    cols = _FEAT_COLS
    pairs = " UNION ALL ".join(
        f"SELECT '{cols[j]}' AS cname, covar_pop(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) / "
        f"nullif(stddev_pop(CAST({cols[i]} AS DOUBLE)) * stddev_pop(CAST({cols[j]} AS DOUBLE)), 0) AS corr FROM f"
        for i in range(len(cols)) for j in range(i + 1, len(cols))
    )
    unp = " UNION ALL ".join(f"SELECT row_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM f" for c in cols)
    return (f"WITH {_PROC}, f AS MATERIALIZED (SELECT *, {derived} FROM p), pr AS ({pairs}), "
            f"dr AS (SELECT DISTINCT cname FROM pr WHERE abs(corr) > 0.95), u AS ({unp}) "
            f"SELECT row_id, feature, round(value, 6) + 0.0 AS value FROM u WHERE feature NOT IN (SELECT cname FROM dr)")


ORACLES["build_features"] = _build_features_sql()

# --- splits, folds, weights, samples -------------------------------------------------

ORACLES["stratified_split"] = """
WITH c AS (SELECT o_orderstatus AS lab, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS total, CAST(ceil(CAST(0.2 AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS BIGINT) AS n_test FROM c),
a AS (SELECT lab, CAST(n_test * n AS DOUBLE) / CAST(total AS DOUBLE) AS cont FROM c, t),
b AS (SELECT lab, floor(cont) AS fl, cont - floor(cont) AS rem FROM a),
nd AS (SELECT (SELECT n_test FROM t) - sum(fl) AS need FROM b),
al AS (SELECT lab, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, lab) <= need THEN 1 ELSE 0 END AS lim FROM b, nd)
SELECT o_orderkey, o_orderstatus,
  CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:split:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= lim
       THEN 'test' ELSE 'train' END AS split
FROM orders JOIN al ON lab = o_orderstatus"""
ORACLES["stratified_folds"] = """
SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY md5('42:fold:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders"""
ORACLES["class_weights"] = """
WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderstatus, CAST(n AS BIGINT) AS n,
  round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) + 0.0 AS weight FROM c"""
ORACLES["background_sample"] = (
    "SELECT o_orderkey FROM orders ORDER BY md5('42:background:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100"
)

# --- evaluation ------------------------------------------------------------------------

_SCORED_LI = ("(SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label, "
              "l_quantity / CAST(100.0 AS DOUBLE) + l_discount * CAST(5.0 AS DOUBLE) AS score FROM lineitem)")
_SCORED_SURVEY = scored_survey_sql()


def _r(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def _ratio(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_CONF = ("count(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn, count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp, "
         "count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp")
ORACLES["confusion"] = f"SELECT {_CONF} FROM {_SCORED_LI}"
ORACLES["binary_metrics"] = (
    f"SELECT tn, fp, fn, tp, {_r(_ratio('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {_r(_ratio('tp', 'tp + fn'))} AS recall, "
    f"{_r(_ratio('tp', 'tp + fp'))} AS precision, {_r(_ratio('2 * tp', '2 * tp + fp + fn'))} AS f1 "
    f"FROM (SELECT {_CONF} FROM {_SCORED_LI})"
)
_GROUPS = f"(SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {_SCORED_LI} GROUP BY score)"
ORACLES["roc_auc"] = (
    f"SELECT {_r('sum(pos * (cum_neg - neg + neg * 0.5)) / (sum(pos) * sum(neg))')} AS roc_auc FROM "
    f"(SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM {_GROUPS})"
)
_DESC = (f"(SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos, "
         f"sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg, "
         f"sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM {_GROUPS})")
ORACLES["average_precision"] = (
    f"SELECT {_r('sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos)')} AS average_precision FROM {_DESC}"
)
ORACLES["roc_curve"] = (
    f"SELECT {_r('score')} AS threshold, {_r('CAST(cum_neg AS DOUBLE) / N')} AS fpr, {_r('CAST(cum_pos AS DOUBLE) / P')} AS tpr FROM {_DESC} "
    f"UNION ALL SELECT NULL, 0.0, 0.0"
)
ORACLES["pr_curve"] = (
    f"SELECT {_r('score')} AS threshold, {_r('CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)')} AS precision, "
    f"{_r('CAST(cum_pos AS DOUBLE) / P')} AS recall FROM {_DESC} WHERE cum_pos - pos < P "
    f"UNION ALL SELECT NULL, 1.0, 0.0"
)


def _sweep_sql(src: str, lo: int, hi: int) -> str:
    return (
        f"(SELECT CAST(i AS DOUBLE) / 100.0 AS threshold, "
        f"count(*) FILTER (WHERE label = 1 AND score >= CAST(i AS DOUBLE) / 100.0) AS tp, "
        f"count(*) FILTER (WHERE label <> 1 AND score >= CAST(i AS DOUBLE) / 100.0) AS fp, "
        f"count(*) FILTER (WHERE label = 1 AND NOT (score >= CAST(i AS DOUBLE) / 100.0)) AS fn "
        f"FROM range({lo}, {hi + 1}) r(i), {src} GROUP BY i)"
    )


def _sweep_metrics(src: str, lo: int, hi: int) -> str:
    return (f"(SELECT threshold, {_ratio('tp', 'tp + fn')} AS recall, {_ratio('tp', 'tp + fp')} AS precision, "
            f"{_ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM {_sweep_sql(src, lo, hi)})")


ORACLES["threshold_sweep"] = (
    f"SELECT {_r('threshold')} AS threshold, {_r('recall')} AS recall, {_r('precision')} AS precision, {_r('f1')} AS f1 "
    f"FROM {_sweep_metrics(_SCORED_LI, 10, 90)}"
)
ORACLES["optimal_threshold"] = (
    f"WITH sw AS MATERIALIZED {_sweep_metrics(_SCORED_SURVEY, 10, 89)}, "
    f"best AS (SELECT threshold FROM sw WHERE recall >= 0.8 AND f1 > 0 ORDER BY f1 DESC, threshold ASC LIMIT 1), "
    f"pick AS (SELECT coalesce((SELECT threshold FROM best), 0.5) AS t) "
    f"SELECT {_r('threshold')} AS threshold, {_r('recall')} AS recall, {_r('precision')} AS precision, {_r('f1')} AS f1 "
    f"FROM sw, pick WHERE threshold = t"
)
ORACLES["classification_report"] = f"""
WITH s AS (SELECT CAST(label AS VARCHAR) AS y, CAST(CAST(score >= 0.5 AS INTEGER) AS VARCHAR) AS p FROM {_SCORED_LI}),
cm AS (SELECT y, p, count(*) AS n FROM s GROUP BY 1, 2),
sup AS (SELECT y AS cls, sum(n) AS support FROM cm GROUP BY 1),
pre AS (SELECT p AS cls, sum(n) AS predicted FROM cm GROUP BY 1),
cor AS (SELECT y AS cls, n AS tp FROM cm WHERE y = p),
per AS (SELECT coalesce(sup.cls, pre.cls) AS label, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
        coalesce(tp, 0) AS tp FROM sup FULL JOIN pre ON sup.cls = pre.cls LEFT JOIN cor ON cor.cls = coalesce(sup.cls, pre.cls)),
m AS (SELECT label, {_ratio('tp', 'predicted')} AS precision, {_ratio('tp', 'support')} AS recall,
        {_ratio('2 * tp', 'support + predicted')} AS f1, support, tp FROM per)
SELECT label, {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1, CAST(support AS BIGINT) AS support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, {_r(_ratio('sum(tp)', 'sum(support)'))}, CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', {_r('avg(precision)')}, {_r('avg(recall)')}, {_r('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', {_r(_ratio('sum(precision * support)', 'sum(support)'))}, {_r(_ratio('sum(recall * support)', 'sum(support)'))},
  {_r(_ratio('sum(f1 * support)', 'sum(support)'))}, CAST(sum(support) AS BIGINT) FROM m"""

_FOLDS = (f"(SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:fold:' || CAST(row_id AS VARCHAR)), row_id) - 1) % 5 AS INTEGER) AS fold "
          f"FROM {_SCORED_SURVEY})")
_CV = f"""
WITH f AS MATERIALIZED {_FOLDS},
c AS (SELECT fold, count(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn, count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp,
      count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM f GROUP BY fold),
g AS (SELECT fold, score, sum(label) AS pos, sum(1 - label) AS neg FROM f GROUP BY fold, score),
cg AS (SELECT *, sum(neg) OVER (PARTITION BY fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g),
auc AS (SELECT fold, sum(pos * (cum_neg - neg + neg * 0.5)) / (sum(pos) * sum(neg)) AS roc_auc FROM cg GROUP BY fold),
per AS (SELECT c.fold, {_ratio('tp', 'tp + fn')} AS recall, {_ratio('tp', 'tp + fp')} AS precision,
        {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1, ({_ratio('tp', 'tp + fn')} + {_ratio('tn', 'tn + fp')}) / 2 AS balanced_accuracy,
        roc_auc FROM c JOIN auc ON c.fold = auc.fold)"""
ORACLES["cv_metrics"] = _CV + (
    f" SELECT fold, {_r('recall')} AS recall, {_r('precision')} AS precision, {_r('f1')} AS f1, "
    f"{_r('balanced_accuracy')} AS balanced_accuracy, {_r('roc_auc')} AS roc_auc FROM per"
)
ORACLES["cv_summary"] = _CV + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {_r(f'avg({m})')} AS mean, {_r(f'stddev_pop({m})')} AS std FROM per"
    for m in ("recall", "precision", "f1", "balanced_accuracy", "roc_auc")
)

# --- sources, sinks, projections -------------------------------------------------------

ORACLES["scan_csv"] = "SELECT * FROM customer"
ORACLES["json_records_scan"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
ORACLES["append_records"] = (
    "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"
)
ORACLES["next_version"] = (
    r"SELECT CAST(coalesce(max(TRY_CAST(regexp_extract(c_name, '^Customer#(\d+)$', 1) AS BIGINT)), 0) + 1 AS BIGINT) "
    "AS next_version FROM customer"
)
ORACLES["project_reorder"] = "SELECT c_mktsegment, c_acctbal, c_name, c_custkey, c_nationkey FROM customer"
ORACLES["fill_missing_columns"] = "SELECT *, 0 AS c_phone, 0 AS c_comment FROM customer"
ORACLES["first_row"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1"

# --- scoring and linear Shapley ---------------------------------------------------------

_W = {
    "pack_years": 1.2, "family_history_cancer": 0.9, "occupational_exposure": 0.7, "air_pollution_index": 0.3,
    "xray_abnormal": 0.6, "copd": 0.5, "age": 0.4, "smoker": 0.8, "passive_smoking": 0.25, "radon_exposure": 0.35,
    "asthma": 0.15, "previous_tb": 0.45, "chronic_cough": 0.55, "chest_pain": 0.65, "fatigue": 0.1, "bmi": -0.2,
    "oxygen_saturation": -0.75, "crp_level": 0.05, "exercise_hours_per_week": -0.12, "diet_quality": -0.02,
}
_B0 = -1.0
_MARGIN = f"({_f(_B0)}" + "".join(f" + {_f(w)} * CAST({c} AS DOUBLE)" for c, w in _W.items()) + ")"
_PROB = f"(1.0 / (1.0 + exp(-({_MARGIN} - 0.0) * 1.0)))"


def _score_cols(p: str) -> str:
    return (f"CAST({p} >= 0.5 AS INTEGER) AS prediction, round(round_even({p}, 4), 6) + 0.0 AS probability, "
            f"CASE WHEN {p} < 0.3 THEN 'Low' WHEN {p} < 0.7 THEN 'Medium' ELSE 'High' END AS risk_level, "
            f"CASE WHEN {p} >= 0.5 THEN 'Lung Cancer Detected' ELSE 'No Lung Cancer' END AS label")


ORACLES["logistic_score"] = (
    f"SELECT o_orderkey, {_r('1.0 / (1.0 + exp(-(o_totalprice / 100000.0 - 2.0) * 1.5))')} AS probability FROM orders"
)
ORACLES["risk_level"] = f"SELECT row_id, {_score_cols('score')} FROM {_SCORED_SURVEY}"
ORACLES["score_batch"] = f"WITH {_PROC} SELECT row_id, {_score_cols(_PROB)} FROM p"
ORACLES["stream_score"] = ORACLES["score_batch"]
_PHI = f"WITH {_PROC}, u AS (" + " UNION ALL ".join(
    f"SELECT row_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"{_f(w)} * (CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) AS phi FROM p" for c, w in _W.items()
) + ")"
ORACLES["shap_linear"] = f"{_PHI} SELECT row_id, feature, {_r('value')} AS value, {_r('phi')} AS phi FROM u"
ORACLES["shap_distribution"] = (
    f"{_PHI}, t AS (SELECT feature FROM u GROUP BY feature ORDER BY avg(abs(phi)) DESC, feature LIMIT 15) "
    f"SELECT row_id, feature, {_r('value')} AS value, {_r('phi')} AS phi FROM u WHERE feature IN (SELECT feature FROM t)"
)
ORACLES["shap_global_topk"] = (
    f"{_PHI} SELECT feature, {_r('avg(abs(phi))')} AS importance FROM u GROUP BY feature "
    f"ORDER BY avg(abs(phi)) DESC, feature LIMIT 15"
)
_BASE = f"({_f(_B0)}" + "".join(f" + {_f(w)} * (SELECT avg(CAST({c} AS DOUBLE)) FROM p)" for c, w in _W.items()) + ")"
ORACLES["shap_waterfall"] = (
    f"{_PHI} SELECT row_id, feature, {_r('value')} AS value, {_r('phi')} AS phi, "
    f"{_r(f'{_BASE} + sum(phi) OVER (ORDER BY abs(phi) DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS running_total, "
    f"CAST(row_number() OVER (ORDER BY abs(phi) DESC, feature) AS INTEGER) AS \"order\" "
    f"FROM u WHERE row_id = (SELECT min(row_id) FROM p)"
)
ORACLES["stream_append"] = (
    f"SELECT * FROM events WHERE len({_errors_sql(_rules_events)}) = 0"
)

# --- oversampling ------------------------------------------------------------------------

ORACLES["smote_knn"] = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.vec_id, a.label, b.vec_id AS nn_id, list_distance(a.v, b.v) AS distance
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, nn_id) AS nn_rank FROM p)
SELECT vec_id, label, nn_id, CAST(nn_rank AS INTEGER) AS nn_rank, round(distance, 6) + 0.0 AS distance FROM r WHERE nn_rank <= 5"""
ORACLES["smote_balance"] = """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, CAST(n AS BIGINT) AS n_original, CAST(max(n) OVER () - n AS BIGINT) AS n_synthetic,
       CAST(max(n) OVER () AS BIGINT) AS n_total FROM c"""

ORACLES["evaluate_job"] = f"""
WITH c AS (SELECT {_CONF} FROM {_SCORED_LI}),
auc AS ({ORACLES['roc_auc']}),
ap AS ({ORACLES['average_precision']}),
sw AS MATERIALIZED {_sweep_metrics(_SCORED_LI, 10, 89)},
best AS (SELECT threshold FROM sw WHERE recall >= 0.8 AND f1 > 0 ORDER BY f1 DESC, threshold ASC LIMIT 1)
SELECT {_r(_ratio('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {_r(_ratio('tp', 'tp + fn'))} AS recall,
       {_r(_ratio('tp', 'tp + fp'))} AS precision, {_r(_ratio('2 * tp', '2 * tp + fp + fn'))} AS f1,
       (SELECT roc_auc FROM auc) AS roc_auc, (SELECT average_precision FROM ap) AS average_precision,
       {_r("coalesce((SELECT threshold FROM best), 0.5)")} AS optimal_threshold
FROM c"""

# Parts of the stratified split: ceil(0.2 n) rows held out, shares of the two classes by largest remainder.
ORACLES["train_job"] = f"""
WITH c AS (SELECT CAST({SURVEY_TARGET} = 'YES' AS INTEGER) AS y, count(*) AS n FROM {_raw} GROUP BY 1),
t AS (SELECT sum(n) AS n, ceil(0.2 * sum(n)) AS m FROM c),
s AS (SELECT y, c.n, m, m * c.n / t.n AS share FROM c, t),
a AS (SELECT y, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, y) <= m - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k FROM s)
SELECT CAST((SELECT n - m FROM t) AS BIGINT) AS n_train, CAST((SELECT m FROM t) AS BIGINT) AS n_test, CAST((SELECT k FROM a WHERE y = 1) AS BIGINT) AS n_positive,
       CAST(1 AS BIGINT) AS version, true AS probabilities_fit, true AS metrics_fit"""

# Every setting of the logistic grid on every fold of the training part.
ORACLES["tune_logistic"] = f"""
WITH r AS (SELECT row_id, CAST({SURVEY_TARGET} = 'YES' AS INTEGER) AS y FROM {_raw} WHERE {SURVEY_TARGET} IS NOT NULL),
c AS (SELECT y, count(*) AS n FROM r GROUP BY 1), t AS (SELECT sum(n) AS n, ceil(0.2 * sum(n)) AS m FROM c),
s AS (SELECT y, c.n, m, m * c.n / t.n AS share FROM c, t),
a AS (SELECT y, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, y) <= m - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k FROM s),
tr AS (SELECT r.row_id, r.y FROM r JOIN a USING (y) QUALIFY row_number() OVER (PARTITION BY r.y ORDER BY md5('42:split:' || CAST(r.row_id AS VARCHAR)), r.row_id) > a.k),
f AS (SELECT y, (row_number() OVER (PARTITION BY y ORDER BY md5('42:fold:' || CAST(row_id AS VARCHAR)), row_id) - 1) % 5 AS fold FROM tr),
per AS (SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_held_out, CAST(sum(y) AS BIGINT) AS n_positive FROM f GROUP BY fold),
w AS (SELECT *, sum(n_held_out) OVER () - n_held_out AS n, sum(n_positive) OVER () - n_positive AS pos FROM per)
SELECT CAST(d.draw AS INTEGER) AS draw, d.c, fold, n_held_out, n_positive, {_r("n / (2.0 * pos)")} AS positive_weight, true AS optimal, true AS recall_fits
FROM w, (VALUES (0, 0.01::DOUBLE), (1, 0.1), (2, 1.0), (3, 10.0), (4, 100.0)) AS d(draw, c)"""

ORACLES["registry_list"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS version, '{t}' AS model_type, count(*) AS n_rows, '{{}}' AS metrics, true AS loads FROM {t}"
    for i, t in enumerate(("customer", "orders", "lineitem"), 1))
