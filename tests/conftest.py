import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from riskframe.session import checkpoint_root

    checkpoint_root(s)
    yield s


@pytest.fixture(scope="session")
def survey(spark):
    from synth import generate_survey

    return generate_survey(spark.range(1, 301).withColumnRenamed("id", "k"), "k").persist()
