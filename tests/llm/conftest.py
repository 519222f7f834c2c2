import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def docs(spark):
    """DataFrame of (doc_id, text) rows with a clashing extra column."""
    def make(rows):
        return spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int")
    return make
