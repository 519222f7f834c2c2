import glob

from riskframe.operators import preprocess as pp
from riskframe.plans import cli


def test_cli_validate_and_preprocess(spark, survey, tmp_path):
    survey.drop("row_id").coalesce(1).write.option("header", True).csv(str(tmp_path / "raw"))
    raw = glob.glob(str(tmp_path / "raw" / "*.csv"))[0]
    cli.main(["validate", "--input", raw])
    cli.main(["preprocess", "--input", raw, "--params", str(tmp_path / "params"), "--output", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300
    params = pp.PreprocessParams.load(spark, str(tmp_path / "params"))
    assert params.columns["age"].role == "numeric" and params.columns["smoker"].role == "binary"


def test_train_score_evaluate_retrain_on_thirty_columns(spark, survey, tmp_path):
    """The canonical table has 30 columns and no id; repeated rows stay rows."""
    from riskframe.spec import SURVEY_COLUMNS

    raw, new, root = str(tmp_path / "raw"), str(tmp_path / "new"), str(tmp_path / "models")
    table = survey.select(*SURVEY_COLUMNS)
    table.unionByName(table.limit(5)).coalesce(1).write.option("header", True).csv(raw)
    table.limit(40).coalesce(1).write.option("header", True).csv(new)
    few = ["--families", "logistic_regression", "--n-iter", "2"]
    cli.main(["train", "--input", raw, "--registry", root, *few])
    cli.main(["score", "--input", raw, "--registry", root, "--output", str(tmp_path / "scored")])
    assert spark.read.parquet(str(tmp_path / "scored")).select("row_id").distinct().count() == 305
    cli.main(["evaluate", "--input", raw, "--registry", root, "--output", str(tmp_path / "report")])
    tables = {r.table for r in spark.read.json(str(tmp_path / "report")).collect()}
    assert {"metrics", "roc_auc", "average_precision", "report", "threshold_sweep"} <= tables
    cli.main(["retrain", "--input", raw, "--appended", new, "--registry", root, *few])
    import json

    from riskframe.sources import registry as reg

    rows = reg.list_versions(spark, root).collect()
    assert [r.version for r in rows] == [1, 2]
    metrics = json.loads(rows[1].metrics)
    assert {"cv_recall_mean", "cv_precision_std", "cv_f1_mean", "cv_roc_auc_mean", "test_roc_auc", "test_recall"} <= set(metrics)
