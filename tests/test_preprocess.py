import pytest
from pyspark.sql import functions as F

from riskframe.operators import preprocess as pp
from riskframe.operators.profile import exact_quantiles, mode_values
from riskframe.spec import TableSpec


def test_encode_target_strings(spark):
    df = spark.createDataFrame([("YES",), ("NO",), ("yes",), ("maybe",)], "t string")
    spec = TableSpec(id_col=None, target="t")
    out = [r[0] for r in pp.encode(df, spec).collect()]
    assert out == [1, 0, 1, None]


def test_encode_target_numeric_unchanged(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (0,)], "t int")
    assert [r[0] for r in pp.encode(df, TableSpec(None, "t")).collect()] == [1, 0, 1, 0]


def test_encode_gender(spark):
    df = spark.createDataFrame([("M",), ("F",), ("male",), ("Female",)], "g string")
    spec = TableSpec(None, None, binary=("g",), gender="g")
    assert [r[0] for r in pp.encode(df, spec).collect()] == [1, 0, 1, 0]


@pytest.mark.parametrize("vals,expect,flag", [
    ([1, 2, 1, 2], [0, 1, 0, 1], True),
    ([1, 1, None], [0, 0, None], True),
    ([0, 1, 2], [0, 1, 2], False),
    ([None, None], [None, None], True),
])
def test_remap_binary(spark, vals, expect, flag):
    df = spark.createDataFrame([(v,) for v in vals], "f int")
    out, flags = pp.remap_binary(df, ["f"])
    assert [r[0] for r in out.collect()] == expect and flags["f"] is flag


def test_outlier_caps_exact(spark):
    df = spark.createDataFrame([(float(v),) for v in (20, 30, 40, 50, 60, 200)], "x double")
    q1, q3, lo, hi = pp.iqr_caps(df, ["x"])["x"]
    assert (q1, q3, lo, hi) == (32.5, 57.5, -5.0, 95.0)
    assert max(r[0] for r in pp.cap_outliers_iqr(df, ["x"]).collect()) == 95.0


def test_no_outlier_unchanged_and_null_kept(spark):
    df = spark.createDataFrame([(30.0,), (40.0,), (50.0,), (55.0,), (60.0,), (None,)], "x double")
    assert [r[0] for r in pp.cap_outliers_iqr(df, ["x"]).collect()] == [30.0, 40.0, 50.0, 55.0, 60.0, None]


def test_impute_median_and_mode_tie(spark):
    df = spark.createDataFrame([(30.0, 1), (None, 1), (50.0, 3), (60.0, 3), (40.0, None)], "x double, f int")
    out, fills = pp.impute(df, ["x"], ["f"])
    assert fills["x"] == 45.0 and fills["f"] == 1.0
    assert out.where(F.col("x").isNull() | F.col("f").isNull()).count() == 0


def test_exact_quantiles_narrowing_matches_numpy(spark):
    import numpy as np

    vals = [float((i * 7919) % 1000) / 7.0 for i in range(5000)] + [3.0] * 2000
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = exact_quantiles(df, {"x": F.col("x")}, [0.1, 0.25, 0.5, 0.9])
    assert np.allclose(q["x"], np.quantile(vals, [0.1, 0.25, 0.5, 0.9]), rtol=0, atol=1e-12)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert [r[0] for r in pp.standard_scale(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_fit_transform_reload_same_rows(spark, survey, tmp_path):
    from riskframe.spec import SURVEY_SPEC

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    a = pp.transform(survey, SURVEY_SPEC, params)
    params.save(spark, str(tmp_path / "p"))
    b = pp.transform(survey, SURVEY_SPEC, pp.PreprocessParams.load(spark, str(tmp_path / "p")))
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.columns[-1] == SURVEY_SPEC.target
    stats = a.agg(F.avg("age"), F.stddev_pop("age")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9


def test_single_row_scoring_keeps_learned_encoding(spark, survey):
    """A 0/1-coded flag of 1 stays 1 when one row is transformed."""
    from riskframe.spec import SURVEY_SPEC

    params = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    one = survey.where(F.col("smoker") == 1).limit(1)
    assert pp.transform(one, SURVEY_SPEC, params).first()["smoker"] == 1


def test_approximate_fit_close_to_exact(spark, survey):
    from riskframe.spec import SURVEY_SPEC

    exact = pp.Preprocessor(SURVEY_SPEC).fit(survey)
    approx = pp.Preprocessor(SURVEY_SPEC, exact=False).fit(survey)
    for c, p in exact.columns.items():
        q = approx.columns[c]
        assert p.remap == q.remap
        if p.role == "numeric":
            span = (p.cap_hi - p.cap_lo) or 1.0
            assert abs(p.fill - q.fill) <= 0.05 * span


def test_nan_becomes_null_and_clip_keeps_null(spark):
    spec = TableSpec(id_col=None, target=None, numeric=("x",))
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,), (2.0,)], "x double")
    enc = pp.encode(df, spec)
    assert enc.where(F.col("x").isNull()).count() == 2
    params = pp.Preprocessor(spec).fit(df)
    assert params.columns["x"].fill == 2.0
    # quartiles after imputation: [1, 2, 2, 3, 2] -> Q1 = Q3 = 2, caps [2, 2]
    assert (params.columns["x"].cap_lo, params.columns["x"].cap_hi) == (2.0, 2.0)
    out = pp.transform(df, spec, params, impute=False, scale=False)
    assert [r[0] for r in out.collect()] == [2.0, None, None, 2.0, 2.0]


def test_text_category_filled_with_mode(spark, tmp_path):
    spec = TableSpec(id_col=None, target=None, numeric=("x",), categorical=("city",))
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, None), (4.0, "b"), (5.0, "a"), (6.0, "a")],
                               "x double, city string")
    params = pp.Preprocessor(spec).fit(df)
    assert params.columns["city"].fill_text == "a"
    params.save(spark, str(tmp_path / "p"))
    out = pp.transform(df, spec, pp.PreprocessParams.load(spark, str(tmp_path / "p")))
    assert [r["city"] for r in out.collect()] == ["b", "a", "a", "b", "a", "a"]


def test_all_null_columns_pass_through(spark):
    spec = TableSpec(id_col="id", target="y", binary=("f",), numeric=("x", "z"))
    df = spark.createDataFrame([(i, None, None, float(i), i % 2) for i in range(10)],
                               "id int, f int, x double, z double, y int")
    params = pp.Preprocessor(spec).fit(df)
    assert params.columns["x"].fill is None and params.columns["x"].mean is None
    assert params.columns["f"].fill is None and params.columns["f"].remap is True
    out = pp.transform(df, spec, params).collect()
    assert all(r["x"] is None and r["f"] is None for r in out)
    assert abs(sum(r["z"] for r in out)) < 1e-9


def test_order_key_orders_all_doubles(spark):
    """Zeros, subnormals, powers of two and their neighbours, infinities: the key is the value's bits."""
    import math
    import struct

    from riskframe.operators.profile import with_order_key

    sizes = [0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 1.0, 0.1, 1e300, 1.7976931348623157e308, math.inf]
    sizes += [f(2.0**e, x) for e in range(-1073, 1024, 13) for f, x in ((math.nextafter, 0.0), (math.nextafter, math.inf), (max, 0.0))]
    vals = sizes + [-v for v in sizes]
    got = with_order_key(spark.createDataFrame([(v,) for v in vals], "x double"), "x", "k").collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.k == (-bits if r.x < 0 else bits)


def test_exact_quantiles_of_many_rows_and_hard_values(spark):
    """Several passes: more rows than a digit has, values that differ in the last bits only, infinities, NaN and NULL."""
    import numpy as np

    df = spark.range(300_000).select(
        (F.lit(1.0) + F.pmod(F.xxhash64("id"), F.lit(1 << 20)) * 2.0**-52).alias("close"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, float("nan")).otherwise(F.sin("id") * F.exp(F.col("id") % 700)).alias("wide"),
        F.when(F.col("id") % 3 == 0, float("-inf")).when(F.col("id") % 3 == 1, float("inf")).otherwise(F.col("id").cast("double")).alias("ends"),
        F.lit(None).cast("double").alias("none"), (-(F.col("id") % 97)).alias("whole"))
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 1.0]
    q = exact_quantiles(df, {c: F.col(c) for c in df.columns}, probs)
    rows = df.toPandas()
    assert q["none"] == [None] * len(probs)
    for c in ("close", "wide", "ends", "whole"):
        v = np.sort(rows[c].dropna().to_numpy(dtype=float))
        for p, x in zip(probs, q[c]):
            at = p * (len(v) - 1)
            lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert x == lo if lo == hi else abs(x - (lo + (hi - lo) * (at - np.floor(at)))) <= 1e-12 * abs(x)


def test_exact_quantile_half_zeros_half_ones(spark):
    """Ties far beyond any sketch: 500k rows on two values."""
    df = spark.range(500_000).select((F.col("id") % 2).alias("x"))
    assert exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 0.75]) == {"x": [0.0, 0.5, 1.0]}


def test_imputed_quantiles_in_one_search(spark):
    import pandas as pd

    from riskframe.operators.profile import median_and_imputed_quantiles

    for every in (2, 3, 50):
        vals = [None if i % every == 0 else float((i * 37) % 11) for i in range(400)]
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        m, qs = median_and_imputed_quantiles(df, {"x": F.col("x")}, [0.1, 0.25, 0.75])["x"]
        col = pd.Series(vals, dtype=float)
        assert m == col.median() and qs == list(col.fillna(m).quantile([0.1, 0.25, 0.75]))
