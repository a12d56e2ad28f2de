"""The rules.  Importing this package registers all of them."""

from . import column_rules, multi_rules, pair_rules, table_rules  # noqa: F401
from .registry import RULES, Rule, RuleType, column_rule, multi_rule, pair_rule, table_rule

__all__ = ["RULES", "Rule", "RuleType", "column_rule", "multi_rule", "pair_rule", "table_rule"]
