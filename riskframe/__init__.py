"""riskframe: supervised risk modelling on flat tables, Spark-native."""

from .spec import SURVEY_SPEC, Rule, TableSpec

__all__ = ["SURVEY_SPEC", "Rule", "TableSpec"]
__version__ = "0.1.0"
