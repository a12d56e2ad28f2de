"""Rules on two columns of a row."""

from __future__ import annotations

from ..functions.conditions import as_date, as_double, compare, same_domain
from ..functions.sqltext import Field
from .registry import RULES, pair_rule


@pair_rule("expect_column_pair_values_to_be_equal", ignore_row_if="both_values_are_missing")
def pair_equal(a: Field, b: Field):
    left, right = same_domain(a, b)
    return compare(left, "==", right)


@pair_rule("expect_column_pair_days_diff_to_meet_condition", operator="==", days=0)
def days_between(a: Field, b: Field, operator, days):
    """``a`` minus ``b``, in days, compared with ``days``."""
    return compare(f"datediff({as_date(a)}, {as_date(b)})", operator, str(int(days)))


@pair_rule("expect_column_pair_values_to_meet_compare_condition", operator="==")
def pair_compare(a: Field, b: Field, operator):
    return compare(as_double(a), operator, as_double(b))


RULES["expect_column_pair_values_to_meet_compare_condition"].derive(
    "expect_column_pair_values_to_meet_compare_condition_nfn", ignore_row_if="neither"
)
