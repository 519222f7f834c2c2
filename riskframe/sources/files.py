"""File sources and sinks: CSV with strict header handling, JSON records, append."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SourceError(ValueError):
    pass


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. A missing path or an empty file raises; so does a
    folder whose files have their columns in different orders or by other names
    (each file's header is held against the first's).

    With a schema, columns are taken by header name (a reordered header reads
    right; a missing name raises) and cast to the declared types; with ANSI
    on, a malformed cell fails the read instead of becoming NULL.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    if schema is None:
        reader = reader.option("inferSchema", True)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise SourceError(f"Data file not found: {path}") from e
    if not df.columns:
        raise SourceError(f"Empty data file: {path}")
    if schema is None:
        return df
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    missing = [f.name for f in st.fields if f.name not in df.columns]
    if missing:
        raise SourceError(f"Missing required columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])


def save_csv(df: DataFrame, path: str) -> str:
    """K1: write with a header, no index."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema (no inference)."""
    return spark.read.schema(schema).json(path)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | str, prefix: str = "") -> DataFrame:
    """Parse a JSON text column into typed columns."""
    parsed = df.withColumn("__j", F.from_json(F.col(col), schema))
    fields = parsed.schema["__j"].dataType.fieldNames()
    return parsed.select(*[c for c in df.columns], *[F.col(f"__j.{f}").alias(prefix + f) for f in fields])


def append_records(existing_path: str, new: DataFrame) -> None:
    """K3: append rows; columns absent on one side become NULL on read (mergeSchema)."""
    new.write.mode("append").parquet(existing_path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def union_records(base: DataFrame, new: DataFrame) -> DataFrame:
    """Union all by name; a column missing on one side is NULL there."""
    return base.unionByName(new, allowMissingColumns=True)
