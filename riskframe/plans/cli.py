"""Command-line entry for spark-submit: the reference's scripted steps as Spark jobs.

    spark-submit -m riskframe.plans.cli validate  --input raw.csv
    spark-submit -m riskframe.plans.cli preprocess --input raw.csv --params out/params --output out/processed
    spark-submit -m riskframe.plans.cli train     --input raw.csv --registry out/models
    spark-submit -m riskframe.plans.cli evaluate  --input raw.csv --registry out/models --output out/report
    spark-submit -m riskframe.plans.cli retrain   --input raw.csv --appended new.csv --registry out/models
    spark-submit -m riskframe.plans.cli score     --input new.csv --registry out/models [--version 1] --output out/scored

Inputs are CSV (header) or parquet by extension; outputs are parquet. The
session comes from spark-submit (``getOrCreate``), so cluster settings and
``spark.checkpoint.dir`` are the cluster's.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from ..operators import preprocess as pp
from ..operators import validate as val
from ..sources import files
from ..spec import SURVEY_SPEC
from . import jobs


def _read(spark: SparkSession, path: str) -> DataFrame:
    """CSV by extension or, for a folder, by what lies in it; else parquet."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if path.endswith(".csv") or fs.exists(fs_path) and any(f.getPath().getName().endswith(".csv") for f in fs.listStatus(fs_path)):
        return files.load_csv(spark, path)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="riskframe")
    ap.add_argument("command", choices=["validate", "preprocess", "train", "retrain", "evaluate", "score"])
    ap.add_argument("--input")
    ap.add_argument("--params")
    ap.add_argument("--model")
    ap.add_argument("--registry")
    ap.add_argument("--scored", help="a table (label, score) to evaluate in place of a model")
    ap.add_argument("--appended")
    ap.add_argument("--output")
    ap.add_argument("--families", default="logistic_regression,random_forest,gradient_boosting")
    ap.add_argument("--n-iter", type=int, default=20)
    ap.add_argument("--version", type=int, default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"riskframe-{a.command}").getOrCreate()
    spec = SURVEY_SPEC

    if a.command == "validate":
        df = _read(spark, a.input)
        val.validate_data(df, spec)
        print(json.dumps({"valid": True, "rows": df.count()}))
    elif a.command == "preprocess":
        df = _read(spark, a.input)
        out, params = pp.preprocess(df, spec)
        if a.params:
            params.save(spark, a.params)
        out.write.mode("overwrite").parquet(a.output)
    elif a.command in ("train", "retrain"):
        df = _read(spark, a.input)
        more = {"families": tuple(a.families.split(",")), "n_iter": a.n_iter, "registry_root": a.registry}
        if a.command == "train":
            bundle, results = jobs.train(df, spec, **more)
        else:
            bundle, results = jobs.retrain(df, _read(spark, a.appended) if a.appended else None, spec, **more)
        if a.params:
            bundle.params.save(spark, a.params)
        results.show(truncate=False)
        print(json.dumps({k: v for k, v in bundle.meta.items() if k != "failed"}, default=str))
    elif a.command == "evaluate":
        if a.scored:
            tables = jobs.evaluate(spark.read.parquet(a.scored))
        else:
            tables = jobs.evaluate_model(_read(spark, a.input), jobs.load_bundle(spark, a.registry, spec, a.version))
        jobs.report_json(tables).write.mode("overwrite").json(a.output)
    elif a.command == "score":
        bundle = jobs.load_bundle(spark, a.registry, spec, a.version)
        scored, quarantined = jobs.score(jobs.with_row_id(_read(spark, a.input), spec), bundle)
        scored.write.mode("overwrite").parquet(a.output)
        quarantined.write.mode("overwrite").parquet(a.output.rstrip("/") + "_quarantine")


if __name__ == "__main__":
    main()
