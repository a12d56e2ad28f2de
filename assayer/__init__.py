"""Data-quality rules for Spark tables, and snapshot-tagged datasets."""

from .operators import RULES, Rule, RuleType, column_rule, multi_rule, pair_rule, table_rule
from .plans.job import run_validation
from .plans.suite import Suite
from .plans.validate import Validation, fill_for_display, latest_results, suite_statistics, validate

__all__ = [
    "RULES",
    "Rule",
    "RuleType",
    "Suite",
    "Validation",
    "column_rule",
    "fill_for_display",
    "latest_results",
    "multi_rule",
    "pair_rule",
    "run_validation",
    "suite_statistics",
    "table_rule",
    "validate",
]
