"""Table roles, configuration constants and validation rules.

Every operator in the library takes a :class:`TableSpec` instead of
hard-coded column names, so the same code runs on the canonical survey
table and on any other flat table with an id, a target and typed columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Mapping, Sequence

# ---------------------------------------------------------------------------
# These must equal the reference for results to agree.
# Canonical survey columns, in order; the last one is the target.
# ---------------------------------------------------------------------------
SURVEY_COLUMNS = (
    "age", "gender", "education_years", "income_level", "smoker",
    "smoking_years", "cigarettes_per_day", "pack_years", "passive_smoking",
    "air_pollution_index", "occupational_exposure", "radon_exposure",
    "family_history_cancer", "copd", "asthma", "previous_tb",
    "chronic_cough", "chest_pain", "shortness_of_breath", "fatigue",
    "bmi", "oxygen_saturation", "fev1_x10", "crp_level", "xray_abnormal",
    "exercise_hours_per_week", "diet_quality", "alcohol_units_per_week",
    "healthcare_access", "lung_cancer_risk",
)
SURVEY_TARGET = "lung_cancer_risk"
SURVEY_BINARY = (
    "gender", "smoker", "passive_smoking", "occupational_exposure",
    "radon_exposure", "family_history_cancer", "copd", "asthma",
    "previous_tb", "chronic_cough", "chest_pain", "shortness_of_breath",
    "fatigue", "xray_abnormal",
)
SURVEY_NUMERIC = (
    "age", "education_years", "income_level", "smoking_years",
    "cigarettes_per_day", "pack_years", "air_pollution_index",
    "bmi", "oxygen_saturation", "fev1_x10", "crp_level",
    "exercise_hours_per_week", "diet_quality", "alcohol_units_per_week",
    "healthcare_access",
)
SURVEY_CATEGORICAL: tuple[str, ...] = ()

# Encodings (keys compared after upper-casing).
TARGET_MAPPING = {"YES": 1, "NO": 0, "1": 1, "0": 0}
GENDER_MAPPING = {"M": 1, "F": 0, "MALE": 1, "FEMALE": 0, "1": 1, "0": 0}

# Run configuration.
RANDOM_SEED = 42
TEST_SIZE = 0.2
CV_FOLDS = 5
IQR_FACTOR = 1.5
CORRELATION_THRESHOLD = 0.95
MIN_RECALL = 0.8
DEFAULT_THRESHOLD = 0.5
SEARCH_DRAWS = 20
GLOBAL_BACKGROUND_ROWS = 100
LOCAL_BACKGROUND_ROWS = 50
TOP_FEATURES = 15
# Risk bands on the unrounded probability: p < 0.3 Low, p < 0.7 Medium, else High.
RISK_BANDS = ((0.3, "Low"), (0.7, "Medium"))
RISK_TOP_BAND = "High"
POSITIVE_LABEL_TEXT = "Lung Cancer Detected"
NEGATIVE_LABEL_TEXT = "No Lung Cancer"

# Hyper-parameter grids of the three model families.
LOGISTIC_GRID = {"C": [0.01, 0.1, 1, 10, 100]}
FOREST_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [5, 10, 15, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
}
BOOSTED_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.1, 0.3],
    "subsample": [0.7, 0.8, 1.0],
    "colsample_bytree": [0.7, 0.8, 1.0],
}
MODEL_ORDER = ("logistic_regression", "random_forest", "gradient_boosting")


@dataclass(frozen=True)
class TableSpec:
    """Roles of the columns of one flat table."""

    id_col: str | None
    target: str | None
    binary: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    # Column that holds the sex/category text mapped with GENDER_MAPPING.
    gender: str | None = None
    target_mapping: Mapping[str, int] = field(default_factory=lambda: dict(TARGET_MAPPING))
    gender_mapping: Mapping[str, int] = field(default_factory=lambda: dict(GENDER_MAPPING))

    @property
    def features(self) -> tuple[str, ...]:
        seen: list[str] = []
        for c in (*self.binary, *self.numeric, *self.categorical):
            if c not in seen:
                seen.append(c)
        return tuple(seen)

    @property
    def required(self) -> tuple[str, ...]:
        cols = list(self.features)
        if self.target and self.target not in cols:
            cols.append(self.target)
        return tuple(cols)

    def with_(self, **kw: Any) -> "TableSpec":
        return replace(self, **kw)


SURVEY_SPEC = TableSpec(
    id_col="row_id",
    target=SURVEY_TARGET,
    binary=SURVEY_BINARY,
    numeric=SURVEY_NUMERIC,
    categorical=SURVEY_CATEGORICAL,
    gender="gender",
)

# Survey columns in canonical order, features only (the scoring record).
SURVEY_FEATURES_ORDERED = tuple(c for c in SURVEY_COLUMNS if c != SURVEY_TARGET)


@dataclass(frozen=True)
class Rule:
    """One row-level validation rule.

    kind: "required" (not NULL), "range" (lo <= v <= hi, numeric), "in"
    (value in ``allowed``, compared after upper-casing when ``upper``),
    "numeric" (value castable to a number).
    """

    column: str
    kind: str
    lo: float | None = None
    hi: float | None = None
    allowed: Sequence[Any] | None = None
    upper: bool = False
    code: str | None = None

    @property
    def error_code(self) -> str:
        return self.code or f"{self.kind}:{self.column}"


def scoring_rules(spec: TableSpec = SURVEY_SPEC, one_two: Mapping[str, bool] | None = None) -> tuple[Rule, ...]:
    """Row rules applied before scoring a survey record.

    Fixed values: gender in {M, F, 0, 1}; 0 <= age <= 120; binary in {0, 1, 2}.
    ``one_two`` tells the learned coding of flags: one learned as 1/2 takes 1 or
    2 only, one learned as 0/1 takes 0 or 1 only, so that a record coded
    otherwise is quarantined instead of scored as another value.
    Presence of every feature column is a schema check; NULL cells are
    imputed with the learned fill values, so they break no rule here.
    """
    rules: list[Rule] = []
    if spec.gender:
        rules.append(Rule(spec.gender, "in", allowed=("M", "F", "0", "1"), code=f"invalid:{spec.gender}"))
    if "age" in spec.numeric:
        rules.append(Rule("age", "range", lo=0, hi=120, code="invalid:age"))
    for c in spec.binary:
        if c == spec.gender:
            continue
        known = (one_two or {}).get(c)
        allowed = (0, 1, 2) if known is None else (1, 2) if known else (0, 1)
        rules.append(Rule(c, "in", allowed=allowed, code=f"invalid:{c}"))
    return tuple(rules)
