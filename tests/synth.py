"""Survey rows for the tests (realistic and uniform profiles).

Rows are keyed by an id column of an existing DataFrame, and every draw is
``uniform(seed, column, id)``, so the output depends only on the ids: the
same rows on any partitioning, any re-run and any executor loss. The
distributions follow the reference generator; NumPy's random streams are
not reproduced (nor needed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.hashing import uniform
from riskframe.functions.scalar import logistic
from riskframe.operators.preprocess import fill_missing_columns
from riskframe.spec import RANDOM_SEED, SURVEY_BINARY, SURVEY_COLUMNS, SURVEY_TARGET

# Bernoulli probabilities of the flags (realistic profile).
FLAG_P = {
    "smoker": 0.4, "passive_smoking": 0.3, "occupational_exposure": 0.2,
    "radon_exposure": 0.1, "family_history_cancer": 0.15, "asthma": 0.1,
    "previous_tb": 0.05, "chronic_cough": 0.2, "chest_pain": 0.15,
    "shortness_of_breath": 0.2, "fatigue": 0.3, "xray_abnormal": 0.1,
}
# Integer ranges [lo, hi) and real ranges [lo, hi).
INT_RANGES = {"age": (18, 90), "gender": (0, 2), "education_years": (8, 22), "income_level": (1, 6),
              "diet_quality": (1, 6), "healthcare_access": (1, 6)}
REAL_RANGES = {"air_pollution_index": (10, 100), "bmi": (18, 35), "oxygen_saturation": (92, 100),
               "fev1_x10": (20, 50), "crp_level": (0, 10), "exercise_hours_per_week": (0, 15),
               "alcohol_units_per_week": (0, 25)}
# Risk score weights and the logistic link.
RISK_WEIGHTS = {"pack_years_per_50": 0.5, "family_history_cancer": 0.2, "occupational_exposure": 0.15,
                "air_pollution_per_100": 0.1, "xray_abnormal": 0.1, "copd": 0.1}
RISK_CENTER, RISK_SLOPE = 0.4, 10.0
COPD_P_LOW, COPD_P_HIGH, COPD_PACK_YEARS = 0.1, 0.3, 10.0

# Uniform profile.
UNIFORM_INT_RANGES = {"age": (20, 85), "gender": (0, 2), "education_years": (8, 22), "income_level": (1, 6),
                      "smoking_years": (0, 40), "cigarettes_per_day": (0, 40), "diet_quality": (1, 6),
                      "healthcare_access": (1, 6)}
UNIFORM_REAL_RANGES = {"pack_years": (0, 60), "air_pollution_index": (10, 100), "bmi": (18, 40),
                       "oxygen_saturation": (90, 100), "fev1_x10": (20, 50), "crp_level": (0, 10),
                       "exercise_hours_per_week": (0, 15), "alcohol_units_per_week": (0, 30)}
UNIFORM_TARGET_P = 0.3


def _spread(keys: DataFrame, id_name: str) -> DataFrame:
    """Generation is CPU-bound (one md5 per cell): when the key source has
    fewer partitions than the cluster has cores, hash-spread the keys (only
    the key column moves). Output never depends on the partitioning."""
    n = keys.rdd.getNumPartitions()
    par = keys.sparkSession.sparkContext.defaultParallelism
    return keys.repartition(par, id_name) if n < par else keys


def _randint(seed: int, name: str, key: Column, lo, hi) -> Column:
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(uniform(seed, name, key) * (hi_c - lo_c))).cast("int")


def _real(seed: int, name: str, key: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + uniform(seed, name, key) * F.lit(float(hi - lo))


def _flag(seed: int, name: str, key: Column, p) -> Column:
    p_c = p if isinstance(p, Column) else F.lit(float(p))
    return (uniform(seed, name, key) < p_c).cast("int")


def generate_survey(keys: DataFrame, key_col: str, seed: int = RANDOM_SEED, id_name: str = "row_id",
                    keep_probability: bool = False) -> DataFrame:
    """One survey row per key, realistic dependencies.

    smoking_years / cigarettes_per_day are drawn only for smokers,
    ``pack_years = cigarettes / 20 * years``, COPD is more likely above 10
    pack-years and the target is Bernoulli(logistic(weighted score)).
    """
    k = F.col(key_col)
    base = _spread(keys.select(k.alias(id_name)), id_name)
    key = F.col(id_name)
    s1 = {c: _randint(seed, c, key, lo, hi) for c, (lo, hi) in INT_RANGES.items()}
    s1["smoker"] = _flag(seed, "smoker", key, FLAG_P["smoker"])
    for c, (lo, hi) in REAL_RANGES.items():
        s1[c] = _real(seed, c, key, lo, hi)
    for c, p in FLAG_P.items():
        if c != "smoker":
            s1[c] = _flag(seed, c, key, p)
    df = base.withColumns(s1)
    smoker = F.col("smoker") == 1
    max_years = F.greatest(F.lit(1), F.col("age") - F.lit(15))
    df = df.withColumns({
        "smoking_years": F.when(smoker, _randint(seed, "smoking_years", key, 1, max_years).cast("double")).otherwise(F.lit(0.0)),
        "cigarettes_per_day": F.when(smoker, _randint(seed, "cigarettes_per_day", key, 1, 40).cast("double")).otherwise(F.lit(0.0)),
    })
    df = df.withColumn("pack_years", F.col("cigarettes_per_day") / F.lit(20.0) * F.col("smoking_years"))
    copd_p = F.when(F.col("pack_years") < F.lit(COPD_PACK_YEARS), F.lit(COPD_P_LOW)).otherwise(F.lit(COPD_P_HIGH))
    df = df.withColumn("copd", _flag(seed, "copd", key, copd_p))
    w = RISK_WEIGHTS
    score = (
        F.lit(w["pack_years_per_50"]) * (F.col("pack_years") / F.lit(50.0))
        + F.lit(w["family_history_cancer"]) * F.col("family_history_cancer")
        + F.lit(w["occupational_exposure"]) * F.col("occupational_exposure")
        + F.lit(w["air_pollution_per_100"]) * (F.col("air_pollution_index") / F.lit(100.0))
        + F.lit(w["xray_abnormal"]) * F.col("xray_abnormal")
        + F.lit(w["copd"]) * F.col("copd")
    )
    df = df.withColumn("risk_probability", logistic(score, RISK_CENTER, RISK_SLOPE))
    df = df.withColumn(SURVEY_TARGET, _flag(seed, SURVEY_TARGET, key, F.col("risk_probability")))
    extra = ["risk_probability"] if keep_probability else []
    return df.select(id_name, *SURVEY_COLUMNS, *extra)


def generate_survey_uniform(keys: DataFrame, key_col: str, seed: int = RANDOM_SEED, id_name: str = "row_id") -> DataFrame:
    """Same columns, independent uniform draws (the mock-source profile)."""
    base = _spread(keys.select(F.col(key_col).alias(id_name)), id_name)
    key = F.col(id_name)
    cols = {}
    for c, (lo, hi) in UNIFORM_INT_RANGES.items():
        cols[c] = _randint(seed, c, key, lo, hi)
    for c, (lo, hi) in UNIFORM_REAL_RANGES.items():
        cols[c] = _real(seed, c, key, lo, hi)
    for c in SURVEY_BINARY:
        if c not in cols:
            cols[c] = _flag(seed, c, key, 0.5)
    cols[SURVEY_TARGET] = _flag(seed, SURVEY_TARGET, key, UNIFORM_TARGET_P)
    df = base.withColumns(cols)
    return fill_missing_columns(df, SURVEY_COLUMNS).select(id_name, *SURVEY_COLUMNS)
