"""Stand-in inputs built from the driver tables.

These only put rows into the schema a job expects (renames, units, codings of real columns); they
do none of the job's work. Every job that consumes them is generic over
:class:`~riskframe.spec.TableSpec`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..spec import SURVEY_COLUMNS, SURVEY_TARGET, TableSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of files, the form in which a job gets its input."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Lines of an order: whole numbers (units, cents, hundredths), so that sums are exact.
ORDER_LINES = """
SELECT l_orderkey, CAST(count(*) AS INT) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
       max(l_quantity) AS qty_max, min(l_quantity) AS qty_min,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price, max(l_extendedprice) AS price_max,
       CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc, max(CAST(round(l_discount * 100) AS BIGINT)) AS disc_max,
       CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax, max(CAST(round(l_tax * 100) AS BIGINT)) AS tax_max,
       max(l_suppkey) - min(l_suppkey) AS supp_span,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_r, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_a,
       count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS n_n, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS n_f
FROM lineitem GROUP BY l_orderkey"""


def _flag(cond: str, yes: int = 1, no: int = 0) -> str:
    return f"CASE WHEN n_lines IS NULL THEN NULL WHEN {cond} THEN {yes} ELSE {no} END"


#: A raw survey record from an order, its lines and its customer. Orders without lines have missing
#: cells; passive_smoking and asthma are coded 1/2; gender and target are text.
SURVEY_FROM_ORDERS = {
    "age": "18 + c_nationkey + day(CAST(o_orderdate AS DATE))",
    "gender": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'M' ELSE 'F' END",
    "education_years": "8 + month(CAST(o_orderdate AS DATE))",
    "income_level": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
    "smoker": _flag("n_r > 0"),
    "smoking_years": "CASE WHEN n_r > 0 THEN CAST(qty_max AS DOUBLE) WHEN n_r = 0 THEN CAST(0 AS DOUBLE) END",
    "cigarettes_per_day": "CASE WHEN n_r > 0 THEN CAST(qty_min AS DOUBLE) WHEN n_r = 0 THEN CAST(0 AS DOUBLE) END",
    "pack_years": "CAST(qty * n_r AS DOUBLE) / CAST(20 AS DOUBLE)",
    "passive_smoking": "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 2 ELSE 1 END",
    "air_pollution_index": "CAST(floor(CAST(price AS DOUBLE) / CAST(n_lines * 1000 AS DOUBLE)) AS DOUBLE) / CAST(100 AS DOUBLE)",
    "occupational_exposure": _flag("n_f > 0"),
    "radon_exposure": "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END",
    "family_history_cancer": _flag("disc_max >= 9"),
    "copd": _flag("tax_max >= 8"),
    "asthma": _flag("n_a > 0", 2, 1),
    "previous_tb": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
    "chronic_cough": _flag("price_max > 90000"),
    "chest_pain": _flag("qty_max >= 48"),
    "shortness_of_breath": _flag("disc_max <= 3"),
    "fatigue": _flag("n_n >= 2"),
    "bmi": "CAST(18 AS DOUBLE) + CAST(qty AS DOUBLE) / CAST(n_lines * 3 AS DOUBLE)",
    "oxygen_saturation": "CAST(100 AS DOUBLE) - CAST(disc AS DOUBLE) / CAST(n_lines AS DOUBLE)",
    "fev1_x10": "CAST(price_max AS DOUBLE) / CAST(3000 AS DOUBLE)",
    "crp_level": "CAST(tax AS DOUBLE) / CAST(n_lines AS DOUBLE)",
    "xray_abnormal": _flag("n_lines >= 7"),
    "exercise_hours_per_week": "CAST(supp_span AS DOUBLE) / CAST(10 AS DOUBLE)",
    "diet_quality": "n_lines",
    "alcohol_units_per_week": "CAST(disc AS DOUBLE)",
    "healthcare_access": "c_nationkey % 5 + 1",
    SURVEY_TARGET: "CASE WHEN n_r >= 2 THEN 'YES' ELSE 'NO' END",
}
_INT_COLUMNS = ("age", "education_years", "income_level", "diet_quality", "healthcare_access")


def survey_select(lines: str, extra: str = "") -> str:
    """SQL of the survey rows over orders, customer and the lines of orders."""
    cols = ", ".join(f"CAST({SURVEY_FROM_ORDERS[c]} AS INT) AS {c}" if c in _INT_COLUMNS else f"{SURVEY_FROM_ORDERS[c]} AS {c}" for c in SURVEY_COLUMNS)
    return (f"SELECT o_orderkey AS row_id, {cols}{extra} FROM orders LEFT JOIN {lines} ON o_orderkey = l_orderkey "
            "LEFT JOIN customer ON o_custkey = c_custkey")


#: A score on a grid with ties, between 0 and 1, and the label that goes with it.
SCORE_FROM_ORDERS = "CASE WHEN coalesce(qty, 0) >= 350 THEN CAST(1 AS DOUBLE) ELSE CAST(coalesce(qty, 0) AS DOUBLE) / CAST(350 AS DOUBLE) END"


def _over_orders(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    names = {"orders": table(spark, sf_dir, "orders"), "customer": table(spark, sf_dir, "customer"),
             "lines": spark.sql(ORDER_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))}
    for n in names:
        select = select.replace(f" {n} ", f" {{{n}}} ")
    return spark.sql(select, **names)


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey records, one per order (150 000 at sf0.1): text gender and target, two flags coded
    1/2, missing cells where an order has no lines."""
    return landed(_over_orders(spark, sf_dir, survey_select("lines")), "raw-survey")


def scored_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, label, score)`` of every order."""
    df = _over_orders(spark, sf_dir, survey_select("lines", f", {SCORE_FROM_ORDERS} AS score"))
    return df.select("row_id", (F.col(SURVEY_TARGET) == "YES").cast("int").alias("label"), "score")


def lineitem_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )


LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_orderkey, l_linenumber, label, score)``: a returned-line label and a
    score on a 0.01 grid, so ties across classes exist."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("label"),
        (F.col("l_quantity") / F.lit(100.0) + F.col("l_discount") * F.lit(5.0)).alias("score"),
    )


ORDERS_SPEC = TableSpec(id_col="o_orderkey", target="o_orderstatus", numeric=("o_totalprice",),
                        target_mapping={"F": 1, "O": 0})
