"""End-to-end jobs: score, train, evaluate, explain, retrain.

Each job is one driver function over lazy plans. Fitted state (parameter
table, dropped columns, model) travels in a :class:`Bundle`; scoring applies
it and never re-learns anything from the rows it scores.
"""

from __future__ import annotations

import ast
import json
import time
from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import explain as xp
from ..operators import features as feat
from ..operators import metrics as mt
from ..operators import models as md
from ..operators import preprocess as pp
from ..operators import sampling as smp
from ..operators import validate as val
from ..session import cut_lineage, written
from ..sources import registry as reg
from ..spec import DEFAULT_THRESHOLD, MODEL_ORDER, SEARCH_DRAWS, TableSpec, scoring_rules


@dataclass
class Bundle:
    spec: TableSpec
    params: pp.PreprocessParams
    dropped: list[str]
    features: list[str]
    model: Any  # PipelineModel or LinearModel
    threshold: float = DEFAULT_THRESHOLD
    meta: dict = field(default_factory=dict)


def prepare(raw: DataFrame, bundle: Bundle) -> DataFrame:
    """Encode, remap, impute, cap, scale, derive features, drop learned columns."""
    df = pp.transform(raw, bundle.spec, bundle.params)
    df = feat.add_derived_features(df)
    return df.drop(*bundle.dropped)


def score(raw: DataFrame, bundle: Bundle, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M7: (scored rows, quarantined rows). One lazy plan; works on a stream too."""
    spec = bundle.spec
    id_col = id_col or spec.id_col
    val.check_columns(raw, spec.features)
    coding = {c: p.remap for c, p in bundle.params.columns.items() if p.role == "binary" and p.fill is not None}
    accepted, quarantined = val.quarantine_split(raw, scoring_rules(spec, coding))
    prepared = prepare(accepted, bundle)
    if isinstance(bundle.model, md.LinearModel):
        p = bundle.model.probability()
        scored = prepared.select(id_col, *[v.alias(k) for k, v in md.score_columns(p, bundle.threshold).items()])
    else:
        out = bundle.model.transform(prepared).withColumn("__p", md.positive_probability())
        scored = out.select(id_col, *[v.alias(k) for k, v in md.score_columns(F.col("__p"), bundle.threshold).items()])
    return scored, quarantined


def content_hash(df: DataFrame):
    """A hash of a row's whole content (a ``Column``)."""
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)


def with_row_id(df: DataFrame, spec: TableSpec, block: int = 1 << 16) -> DataFrame:
    """``df`` with the id column that the jobs need, where it has none.

    The id is a hash of the row's content and its number among equal rows, so it doesn't depend on the
    partitioning. Equal rows are counted and numbered out again in blocks of ``block`` that are dealt
    over tasks: a row repeated any number of times fills no array and no single task.
    """
    if not spec.id_col or spec.id_col in df.columns:
        return df
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__id", content_hash(df))
    blocks = rows.withColumn("__b", F.explode(F.expr(f"sequence(0L, (__n - 1) div {block})"))).repartition("__id", "__b")
    numbered = blocks.withColumn("__k", F.explode(F.expr(f"sequence(__b * {block} + 1, least(__n, (__b + 1) * {block}))")))
    return numbered.select(F.concat_ws("-", "__id", F.col("__k").cast("string")).alias(spec.id_col), *df.columns)


def split_labelled(raw: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows) of the rows with a known label; the same for every job.

    Rows are ranked themselves, so repeated ids keep their number of rows; equal ids follow their
    content's hash, rows without an id are ranked by it. The split is made once and written: both parts
    are files.
    """
    known = raw.where(pp.encode_target_expr(raw, spec).isNotNull())
    content = content_hash(known)
    keyed = known.select("*", pp.encode_target_expr(known, spec).alias("__y"), F.coalesce(F.col(spec.id_col).cast("string"), content).alias("__key"), F.unhex(content).alias("__tie"))
    split = smp.stratified_split(keyed, "__y", "__key", split_col="__part", tie="__tie").select(*raw.columns, "__part")
    parts = written(split, "split", by="__part")
    return tuple(parts.where(F.col("__part") == part).select(*raw.columns) for part in ("train", "test"))


def fit_bundle(raw_train: DataFrame, spec: TableSpec, model: Any = None) -> tuple[Bundle, DataFrame]:
    """Fit preprocessing and the correlation drop on training rows."""
    params = pp.Preprocessor(spec).fit(raw_train)
    processed = pp.transform(raw_train, spec, params)
    exclude = [c for c in (spec.id_col, spec.target) if c]
    built, dropped = feat.build_features(processed, exclude=exclude, null_free=True)
    # a column without any value has nothing to fill it with and nothing to tell a model
    empty = {c for c, p in params.columns.items() if p.role in ("numeric", "binary") and p.fill is None}
    features = [c for c in feat.numeric_columns(built, exclude) if c not in exclude and c not in empty]
    return Bundle(spec, params, dropped, features, model), built


def train(raw: DataFrame, spec: TableSpec, families: Sequence[str] = MODEL_ORDER, n_iter: int = SEARCH_DRAWS,
          use_weights: bool = True, registry_root: str | None = None, parallelism: int = 4) -> tuple[Bundle, DataFrame]:
    """Split -> fit preprocessing on the training part -> features -> tune each
    family with stratified folds (recall) -> pick the best -> optionally register.

    Rows whose label is NULL after encoding are left out (counted in meta).
    Returns the bundle and the table of tuning results.
    """
    raw = with_row_id(raw, spec)
    n_unlabelled = raw.agg(F.count_if(pp.encode_target_expr(raw, spec).isNull())).first()[0]
    raw_train, raw_test = split_labelled(raw, spec)
    bundle, built = fit_bundle(raw_train, spec)
    data = built.withColumn("label", F.col(spec.target).cast("double"))
    content = content_hash(data)
    data = data.withColumns({"__tie": F.unhex(content), "__key": F.coalesce(F.col(spec.id_col).cast("string"), content)})
    data = smp.stratified_folds(data, "label", "__key", tie="__tie").drop("__key", "__tie")
    if use_weights:
        data = smp.with_class_weights(data, "label")
    # every fold of every setting re-reads this table: write it once to the shared
    # checkpoint folder so a lost executor does not replay the preprocessing chain
    data = written(data, "train")
    results = []
    best_models = {}
    for fam in families:
        try:
            t0 = time.time()
            model, res = md.tune(data, bundle.features, fam, n_iter, weight="weight" if use_weights else None,
                                 parallelism=parallelism)
            best_models[fam] = model
            results.append(res.withColumn("seconds", F.lit(round(time.time() - t0, 2))))
        except Exception as e:  # noqa: BLE001 - a failing family is recorded and skipped
            bundle.meta.setdefault("failed", {})[fam] = str(e)
    if not results:
        raise RuntimeError(f"every model family failed: {bundle.meta.get('failed')}")
    table = results[0]
    for r in results[1:]:
        table = table.unionByName(r)
    best = md.select_best(table).first()
    bundle.model = best_models[best["family"]]
    bundle.meta.update({"family": best["family"], "setting": best["setting"], "cv_recall": best["recall"],
                        "n_rows": data.count(), "n_unlabelled": n_unlabelled})
    folds = md.cross_validate(data, bundle.features, best["family"], ast.literal_eval(best["setting"]),
                              weight="weight" if use_weights else None, keep=(spec.id_col,))
    folds = written(folds.select("fold", "label", "score"), "out-of-fold")  # scored once, read by each metric
    summary = {r["metric"]: (r["mean"], r["std"]) for r in mt.cv_summary(mt.cv_metrics(folds)).collect()}
    metrics = {"cv_recall": best["recall"]}
    for name, (mean, std) in summary.items():
        metrics |= {f"cv_{name}_mean": mean, f"cv_{name}_std": std}
    metrics |= headline(evaluate(written(score_labelled(raw_test, bundle).select("label", "score"), "scored"), threshold=bundle.threshold))
    bundle.meta["metrics"] = metrics
    if registry_root:
        version = reg.save_model(raw.sparkSession, registry_root, bundle.model, bundle.meta["family"], bundle.meta["n_rows"], metrics,
                                 save_state=lambda path: save_bundle_state(raw.sparkSession, path, bundle))
        bundle.meta["version"] = version
    return bundle, table


def save_bundle_state(spark, path: str, bundle: Bundle) -> None:
    """Parameter table and bundle metadata in the folder of one version."""
    bundle.params.save(spark, f"{path}/params")
    state = {"dropped": bundle.dropped, "features": bundle.features, "threshold": bundle.threshold,
             "linear": isinstance(bundle.model, md.LinearModel)}
    spark.createDataFrame([(json.dumps(state),)], "json string").coalesce(1).write.text(f"{path}/bundle")


def load_bundle(spark, root: str, spec: TableSpec, version: int | None = None) -> Bundle:
    """Bundle of a registered version (the latest when not given); raises if there is none."""
    from pyspark.ml import PipelineModel

    version, path = reg.version_path(spark, root, version)
    state = json.loads(spark.read.text(f"{path}/bundle").first()[0])
    params = pp.PreprocessParams.load(spark, f"{path}/params")
    model = md.LinearModel.load(spark, f"{path}/model") if state.get("linear") else PipelineModel.load(f"{path}/model")
    return Bundle(spec, params, state["dropped"], state["features"], model, state["threshold"], {"version": version})


def evaluate(scored: DataFrame, label: str = "label", score_col: str = "score",
             threshold: float = DEFAULT_THRESHOLD) -> dict[str, DataFrame]:
    """Every evaluation table for one scored table."""
    s = scored.select(F.col(label).alias("label"), F.col(score_col).alias("score"))
    curve = mt.curve_table(s)
    return {
        "metrics": mt.binary_metrics(s, threshold=threshold),
        "unscored": mt.unscored(s),
        "roc_auc": mt.roc_auc(s, curve=curve),
        "average_precision": mt.average_precision(s, curve=curve),
        "report": mt.classification_report(mt.complete(s, "label", "score").withColumn("prediction", mt.predict_at("score", threshold))),
        "roc_curve": mt.roc_curve(s, curve=curve),
        "pr_curve": mt.pr_curve(s, curve=curve),
        "threshold_sweep": mt.threshold_sweep(s),
        "optimal_threshold": mt.optimal_threshold(s),
    }


def score_labelled(raw: DataFrame, bundle: Bundle) -> DataFrame:
    """``(id, label, score)`` of labelled rows under a fitted bundle."""
    spec = bundle.spec
    prepared = prepare(raw, bundle)
    if isinstance(bundle.model, md.LinearModel):
        out, p = prepared, bundle.model.probability()
    else:
        out, p = bundle.model.transform(prepared), md.positive_probability()
    return out.select(spec.id_col, F.col(spec.target).cast("int").alias("label"), p.alias("score"))


def evaluate_model(raw: DataFrame, bundle: Bundle) -> dict[str, DataFrame]:
    """The evaluation tables of a fitted bundle on the held-out part of ``raw``
    (the rows that :func:`train` on the same table didn't see)."""
    _, raw_test = split_labelled(with_row_id(raw, bundle.spec), bundle.spec)
    return evaluate(cut_lineage(score_labelled(raw_test, bundle)), threshold=bundle.threshold)


def headline(tables: dict[str, DataFrame]) -> dict[str, float]:
    """The single numbers of an evaluation."""
    m = tables["metrics"].first().asDict()
    return {f"test_{k}": m[k] for k in ("accuracy", "recall", "precision", "f1")} | {
        "test_roc_auc": tables["roc_auc"].first()[0], "test_average_precision": tables["average_precision"].first()[0]}


REPORT_TABLES = ("metrics", "roc_auc", "average_precision", "report", "optimal_threshold", "threshold_sweep")


def report_json(tables: dict[str, DataFrame]) -> DataFrame:
    """K9: one JSON document per bounded evaluation table (a row, a row per class,
    81 thresholds). Curves grow with the distinct scores and stay tables."""
    out = None
    for name, df in tables.items():
        if name not in REPORT_TABLES:
            continue
        j = df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("json")).select(
            F.lit(name).alias("table"), "json")
        out = j if out is None else out.unionByName(j)
    return out


def explain(df: DataFrame, bundle: Bundle, id_col: str, permutations: int = 8,
            n_background: int | None = None) -> dict[str, DataFrame]:
    """C4: Shapley values (exact for a linear bundle, along sampled orders otherwise) against all rows of ``df``
    (or ``n_background`` drawn ones) and the global / beeswarm tables."""
    if isinstance(bundle.model, md.LinearModel):
        phi = xp.shap_linear(df, bundle.model, id_col)
    else:
        phi = xp.shap_sampled(df, bundle.model, bundle.features, id_col, permutations=permutations,
                              n_background=n_background)
    return {"phi": phi, "global": xp.global_importance(phi), "distribution": xp.distribution(phi)}


def retrain(base: DataFrame, appended: DataFrame | None, spec: TableSpec, **kw) -> tuple[Bundle, DataFrame]:
    """The base table plus appended records (schema-union) -> check -> train and evaluate on the
    held-out part -> register with all metrics -> load the version again."""
    data = base if appended is None else base.unionByName(appended, allowMissingColumns=True)
    val.check_columns(data, spec.required)
    bundle, table = train(data, spec, **kw)
    if kw.get("registry_root"):  # the version just written must load and carry its metrics
        root, version = kw["registry_root"], bundle.meta["version"]
        load_bundle(data.sparkSession, root, spec, version)
        if reg.latest_version(data.sparkSession, root) != version:
            raise RuntimeError(f"version {version} is not the latest under {root}")
    return bundle, table
