import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskframe.operators.validate import ValidationError, check_columns, domain_violations, validate_data
from riskframe.sources.files import SourceError, load_csv, save_csv
from synth import generate_survey, generate_survey_uniform
from riskframe.spec import SURVEY_COLUMNS, SURVEY_SPEC


def test_missing_csv_raises(spark, tmp_path):
    with pytest.raises(SourceError):
        load_csv(spark, str(tmp_path / "nope.csv"))


def test_empty_csv_raises(spark, tmp_path):
    p = tmp_path / "empty.csv"
    p.write_text("")
    with pytest.raises(SourceError):
        load_csv(spark, str(p))


def test_csv_round_trip_keeps_rows_and_order(spark, survey, tmp_path):
    path = save_csv(survey.drop("row_id").limit(50), str(tmp_path / "raw"))
    back = load_csv(spark, path, survey.drop("row_id").schema)
    assert back.count() == 50
    assert tuple(back.columns) == SURVEY_COLUMNS


def test_csv_header_in_other_order_is_read_by_name(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("b,a\n1,2\n")
    row = load_csv(spark, str(p), "a int, b int").first()
    assert (row["a"], row["b"]) == (2, 1)


def test_csv_bad_cell_fails(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a,b\n1,x\n")
    with pytest.raises(Exception):
        load_csv(spark, str(p), "a int, b int").collect()


def test_missing_columns_error(spark):
    df = spark.createDataFrame([(30, 1)], "AGE int, GENDER int")
    with pytest.raises(ValidationError, match="Missing required columns"):
        check_columns(df, SURVEY_SPEC.required)


def test_bad_binary_value_collected(spark, survey):
    bad = survey.withColumn("smoker", F.when(F.col("row_id") == 1, F.lit(5)).otherwise(F.col("smoker")))
    with pytest.raises(ValidationError, match="Data validation failed"):
        validate_data(bad, SURVEY_SPEC)
    assert validate_data(survey, SURVEY_SPEC)


def test_domain_violations_ignore_null(spark):
    df = spark.createDataFrame([(0,), (1,), (None,), (2,), (2,), (7,)], "f int")
    assert sorted(map(tuple, domain_violations(df, ["f"]).collect())) == [("f", 2.0, 2), ("f", 7.0, 1)]


def test_generator_shape_and_determinism(spark, survey):
    assert survey.count() == 300
    assert tuple(survey.columns) == ("row_id", *SURVEY_COLUMNS)
    again = generate_survey(spark.range(1, 301).withColumnRenamed("id", "k").repartition(7), "k")
    assert sorted(survey.collect()) == sorted(again.collect())


def test_generator_ranges_and_dependencies(survey):
    r = survey.agg(F.min("age"), F.max("age"), F.max(F.when(F.col("smoker") == 0, F.col("pack_years"))),
                   F.min(F.when(F.col("smoker") == 1, F.col("cigarettes_per_day"))),
                   F.max(F.abs(F.col("pack_years") - F.col("cigarettes_per_day") / 20 * F.col("smoking_years")))).first()
    assert 18 <= r[0] and r[1] <= 89
    assert r[2] == 0.0 and r[3] >= 1 and r[4] < 1e-9


def test_uniform_profile(spark):
    df = generate_survey_uniform(spark.range(0, 100).withColumnRenamed("id", "k"), "k")
    assert df.count() == 100 and tuple(df.columns[1:]) == SURVEY_COLUMNS
    r = df.agg(F.min("age"), F.max("age"), F.max("bmi")).first()
    assert r[0] >= 20 and r[1] <= 84 and r[2] < 40


def test_append_and_union_fill_missing_with_null(spark, tmp_path):
    from riskframe.sources.files import append_records, read_appended, union_records

    base = spark.createDataFrame([(1, "a", 2.0)], "k int, name string, v double")
    new = spark.createDataFrame([(2, "b")], "k int, name string")
    u = union_records(base, new).orderBy("k").collect()
    assert u[1]["v"] is None and len(u) == 2
    path = str(tmp_path / "t")
    base.write.parquet(path)
    append_records(path, new)
    back = read_appended(spark, path).orderBy("k").collect()
    assert [r["k"] for r in back] == [1, 2] and back[1]["v"] is None


def test_csv_folder_with_another_header_order_raises(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "in" / "b.csv").write_text("b,a\n20,10\n")
    with pytest.raises(Exception):
        load_csv(spark, str(tmp_path / "in"), "a int, b int").collect()
