"""Model registry: whole version folders, and one commit file per version that readers follow.

A save writes everything into a folder of its own and then claims a number by putting a finished
commit file under that number's name, which fails if another writer was first; that one takes the
next number. A save that dies before its claim leaves a folder that nothing points to and no
number taken. Claims need a file system whose rename is atomic and doesn't overwrite (HDFS and
the like), or a local one with hard links.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = "version bigint, created string, model_type string, n_rows bigint, metrics string, path string"


def parse_versions(names: DataFrame, col: str, prefix: str, suffix: str = "") -> DataFrame:
    """Integer version of every name ``prefix<digits>suffix``; others give NULL."""
    pattern = "^" + _re_escape(prefix) + r"(\d+)" + _re_escape(suffix) + "$"
    return names.select(F.col(col), F.regexp_extract(F.col(col), pattern, 1).try_cast("bigint").alias("version"))


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def next_version(names: DataFrame, col: str, prefix: str, suffix: str = "") -> DataFrame:
    """K6: max parsed version + 1, or 1 when no name parses."""
    v = parse_versions(names, col, prefix, suffix)
    return v.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commits(root: str) -> str:
    return f"{root}/_registry"


def taken_versions(spark: SparkSession, root: str) -> list[int]:
    """The committed numbers, ascending."""
    fs, folder = _file_system(spark, _commits(root))
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry's rows; none where nothing has been committed. A commit that can't be read raises."""
    versions = taken_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    files = [f"{_commits(root)}/{v}.json" for v in versions]
    return spark.read.schema(REGISTRY_SCHEMA).option("mode", "FAILFAST").json(files)


def _claim(spark: SparkSession, root: str, version: int, line: str) -> bool:
    """Puts a finished commit file under its number; False if the number is taken."""
    fs, draft = _file_system(spark, f"{_commits(root)}/.draft-{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{_commits(root)}/{version}.json")
    out = fs.create(draft, False)
    out.write(bytearray(line.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and bool(fs.rename(draft, target))
        try:  # a local rename would overwrite
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def save_model(spark: SparkSession, root: str, model, model_type: str, n_rows: int, metrics: dict,
               version: int | None = None, save_state: Callable[[str], None] | None = None) -> int:
    """K6-K8: write the model, its metrics JSON and what ``save_state`` adds to a new folder, then
    commit them as the next version (or as ``version``, which must be free); the registry row has
    the metrics without ``best_*`` keys."""
    if version is not None and version in taken_versions(spark, root):
        raise FileExistsError(f"model version {version} is there already under {root}")
    path = f"{root}/models/{uuid.uuid4().hex}"
    model.save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metrics),)], "json string").coalesce(1).write.text(f"{path}/metrics")
    if save_state is not None:
        save_state(path)
    clean = {k: v for k, v in metrics.items() if not str(k).startswith("best_")}
    row = {"created": _dt.datetime.now(_dt.timezone.utc).isoformat(), "model_type": model_type, "n_rows": int(n_rows),
           "metrics": json.dumps(clean), "path": path}
    while True:
        number = int(version) if version is not None else max(taken_versions(spark, root), default=0) + 1
        if _claim(spark, root, number, json.dumps({"version": number, **row})):
            return number
        if version is not None:
            raise FileExistsError(f"model version {version} is there already under {root}")


def version_path(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, str]:
    """Number and folder of a committed version (the latest unless given)."""
    versions = taken_versions(spark, root)
    if not versions or (version is not None and version not in versions):
        raise FileNotFoundError(f"no model registered under {root}" if version is None else f"no model version {version} under {root}")
    version = versions[-1] if version is None else version
    return version, registry(spark, root).where(F.col("version") == version).first()["path"]


def metrics_json(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """K7: all metrics of a committed version (the latest unless given)."""
    return json.loads(spark.read.text(f"{version_path(spark, root, version)[1]}/metrics").first()[0])


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Versions in numeric order; raises when the registry is empty."""
    reg = registry(spark, root).orderBy("version")
    if reg.limit(1).count() == 0:
        raise FileNotFoundError(f"no model registered under {root}")
    return reg


def latest_version(spark: SparkSession, root: str) -> int | None:
    return max(taken_versions(spark, root), default=None)
