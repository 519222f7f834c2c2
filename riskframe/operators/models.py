"""Classifiers, random search with stratified folds, selection, scoring.

Spark ML estimators do the fitting on the executors; the driver only holds
the parameter settings and a table of fold results.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import label_text, logistic, risk_level
from ..spec import BOOSTED_GRID, FOREST_GRID, LOGISTIC_GRID, MODEL_ORDER, RANDOM_SEED
from . import boosting, forest
from .sampling import draw_settings

# Spark trees accept depth <= 30; "no limit" maps to the largest.
MAX_TREE_DEPTH = 30
# Per-task memory for split statistics of one group of tree nodes (Spark's default
# is 256 MB; with 8 task slots on a 1 GB driver that is more than the heap).
TREE_STATS_MB = 16

GRIDS = {"logistic_regression": LOGISTIC_GRID, "random_forest": FOREST_GRID, "gradient_boosting": BOOSTED_GRID}


def estimator(family: str, setting: Mapping[str, Any], n_weight: float | None = None,
              features: str = "features", label: str = "label", weight: str | None = "weight"):
    """Spark ML estimator for one setting of a family's grid.

    Logistic regression: the grid's inverse strength ``C`` multiplies the summed weighted loss;
    Spark averages it, so ``regParam = 1 / (C * sum(weights))`` (sum = n with
    balanced weights). Forest: ``min_samples_split`` has no Spark parameter
    and is ignored; each row's node in each tree is kept, so that a pass moves a
    row by one level and doesn't walk its trees from the root again. Boosting: per-node column sampling stands in for per-tree.
    """
    if family == "logistic_regression":
        c = float(setting.get("C", 1.0))
        reg = 1.0 / (c * float(n_weight or 1.0))
        est = LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                                 maxIter=int(setting.get("max_iter", 1000)), standardization=False)
    elif family == "random_forest":
        depth = setting.get("max_depth")
        est = RandomForestClassifier(featuresCol=features, labelCol=label, seed=RANDOM_SEED,
                                     numTrees=int(setting.get("n_estimators", 100)),
                                     maxDepth=MAX_TREE_DEPTH if depth is None else int(depth),
                                     minInstancesPerNode=int(setting.get("min_samples_leaf", 1)),
                                     maxMemoryInMB=TREE_STATS_MB, cacheNodeIds=True)
    elif family == "gradient_boosting":
        est = GBTClassifier(featuresCol=features, labelCol=label, seed=RANDOM_SEED,
                            maxIter=int(setting.get("n_estimators", 100)), maxDepth=int(setting.get("max_depth", 3)),
                            stepSize=float(setting.get("learning_rate", 0.1)),
                            subsamplingRate=float(setting.get("subsample", 1.0)),
                            featureSubsetStrategy=str(setting.get("colsample_bytree", "all")),
                            maxMemoryInMB=TREE_STATS_MB)
    else:
        raise ValueError(f"unknown model family {family}")
    if weight and family != "gradient_boosting":  # boosting is fitted without class weights
        est.setWeightCol(weight)
    return est


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def fit(df: DataFrame, features: Sequence[str], family: str, setting: Mapping[str, Any],
        label: str = "label", weight: str | None = "weight") -> PipelineModel | boosting.BoostedModel | forest.ForestModel:
    """Boosting on all rows up to depth 7 gives the estimator's model by :mod:`boosting`, forests up to depth 15 are
    grown by :mod:`forest`; else the estimator fits."""
    if family == "random_forest" and 1 <= (setting.get("max_depth") or MAX_TREE_DEPTH) <= forest.DEEPEST:
        return forest.fit(df, features, int(setting.get("n_estimators", 100)), int(setting["max_depth"]), int(setting.get("min_samples_leaf", 1)), label, weight)
    if family == "gradient_boosting" and float(setting.get("subsample", 1.0)) == 1.0 and 1 <= int(setting.get("max_depth", 3)) <= boosting.DEEPEST:
        share = setting.get("colsample_bytree", 1.0)
        if isinstance(share, float):
            return boosting.fit(df, features, int(setting.get("n_estimators", 100)), int(setting.get("max_depth", 3)), float(setting.get("learning_rate", 0.1)), share, label)
    n_weight = df.agg(F.sum(weight)).first()[0] if (weight and family == "logistic_regression") else None
    pipe = Pipeline(stages=[assembler(features), estimator(family, setting, n_weight, label=label, weight=weight)])
    return pipe.fit(df)


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """M6: ``(*keep, prediction, probability)`` with the positive-class probability."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      positive_probability().alias("probability"))


def tune(df: DataFrame, features: Sequence[str], family: str, n_iter: int, fold_col: str = "fold",
         label: str = "label", weight: str | None = "weight", parallelism: int = 4) -> tuple[PipelineModel | LinearModel, DataFrame]:
    """M4: random search over the family's grid, folds from ``fold_col``, scored by
    recall of the positive class. Returns the refitted best model and a
    ``(family, draw, setting, recall)`` table. All logistic settings and folds are fitted in shared
    passes (the model is a :class:`LinearModel`); class weights are those of each training part."""
    settings = draw_settings(GRIDS[family], n_iter)
    if family == "logistic_regression":
        from . import logistic

        found = logistic.search(df, features, settings, label, fold_col, balanced=weight is not None)
        means = {r["draw"]: r["recall"] for r in found.recalls.groupBy("draw").agg(F.avg("recall").alias("recall")).collect()}  # a row per setting
        results = df.sparkSession.createDataFrame([(family, i, repr(s), float(means[i])) for i, s in enumerate(settings)],
                                                  "family string, draw int, setting string, recall double")
        return found.models[select_best(results).first()["draw"], None], results
    base = estimator(family, settings[0], label=label, weight=weight)
    maps = []
    for s in settings:
        e = estimator(family, s, label=label, weight=weight)
        maps.append({base.getParam(p.name): e.getOrDefault(p) for p in e.params if e.isSet(p) or e.hasDefault(p)})
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="recallByLabel", metricLabel=1.0)
    n_folds = df.agg(F.max(fold_col)).first()[0] + 1
    # the stage's params are set per map; the pipeline passes them to its stage
    cv = CrossValidator(estimator=Pipeline(stages=[assembler(features), base]), estimatorParamMaps=maps,
                        evaluator=evaluator, foldCol=fold_col, numFolds=int(n_folds),
                        parallelism=parallelism, seed=RANDOM_SEED)
    cvm = cv.fit(df)
    spark = df.sparkSession
    rows = [(family, i, repr(s), float(m)) for i, (s, m) in enumerate(zip(settings, cvm.avgMetrics))]
    results = spark.createDataFrame(rows, "family string, draw int, setting string, recall double")
    return cvm.bestModel, results


def cross_validate(df: DataFrame, features: Sequence[str], family: str, setting: Mapping[str, Any], fold_col: str = "fold",
                   label: str = "label", weight: str | None = "weight", keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, fold, label, score)``: each fold scored by a model refitted on the other folds."""
    if family == "logistic_regression":
        from . import logistic

        models = logistic.search(df, features, [setting], label, fold_col, balanced=weight is not None).models
        p = logistic.out_of_fold(df, {f: m for (_, f), m in models.items() if f is not None}, fold_col)
        return df.where(F.col(fold_col).isNotNull()).select(*keep, fold_col, label, p.alias("score"))
    out = None
    for fold in range(int(df.agg(F.max(fold_col)).first()[0]) + 1):
        model = fit(df.where(F.col(fold_col) != fold), features, family, setting, label, weight)
        scored = model.transform(df.where(F.col(fold_col) == fold)).select(*keep, fold_col, label, positive_probability().alias("score"))
        out = scored if out is None else out.unionByName(scored)
    return out


def select_best(results: DataFrame) -> DataFrame:
    """M5: highest recall; on a tie the earlier family in the fixed order wins, inside a family the
    earlier draw (the one that the search keeps)."""
    order = F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("family"))
    return results.where(F.col("recall").isNotNull()).orderBy(F.col("recall").desc(), order.asc(), F.col("draw").asc()).limit(1)


# ---------------------------------------------------------------------------
# A linear model given by literal coefficients (a serving bundle that needs no ML runtime)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class LinearModel:
    intercept: float
    weights: Mapping[str, float] = field(default_factory=dict)

    def margin(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in self.weights.items():
            out = out + F.lit(float(w)) * F.col(c).cast("double")
        return out

    def probability(self) -> Column:
        return logistic(self.margin(), 0.0, 1.0)

    def save(self, path: str) -> None:
        """A row per weight, the intercept without a name."""
        rows = [(None, float(self.intercept)), *((c, float(w)) for c, w in self.weights.items())]
        SparkSession.getActiveSession().createDataFrame([(i, c, w) for i, (c, w) in enumerate(rows)], "place int, name string, weight double") \
            .coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearModel":
        rows = spark.read.schema("place int, name string, weight double").parquet(path).orderBy("place").collect()  # a row per feature
        return LinearModel(rows[0]["weight"], {r["name"]: r["weight"] for r in rows[1:]})


def score_columns(p: Column, threshold: float = 0.5) -> dict[str, Column]:
    """M7 output columns from an unrounded probability."""
    pred = (p >= F.lit(threshold)).cast("int")
    return {
        "prediction": pred,
        "probability": F.bround(p, 4),
        "risk_level": risk_level(p),
        "label": label_text(pred),
    }
