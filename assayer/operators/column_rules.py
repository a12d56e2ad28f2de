"""Rules on one column."""

from __future__ import annotations

from ..functions.conditions import (
    as_date,
    as_double,
    as_text,
    comparable,
    compare,
    date_format_regex,
    date_literal,
    member,
    today_in_hong_kong,
)
from ..functions.sqltext import Field, Sure, quote
from ..functions.timeformats import is_parseable, matches_strftime
from .registry import FRACTION, JUDGE, LIST, PERCENT_ROUNDED, RULES, RuleType, column_rule, register


@column_rule("expect_column_values_to_not_be_null", nulls=JUDGE)
def not_null(field: Field):
    return f"NOT ({field.missing})"


@column_rule("expect_column_values_to_be_between", min_value=None, max_value=None)
def between(field: Field, min_value, max_value):
    if min_value is None and max_value is None:
        raise ValueError("min_value and max_value are both missing")
    given = [b for b in (min_value, max_value) if b is not None]
    value, bounds = comparable(field, given)
    signs = [sign for sign, b in ((">=", min_value), ("<=", max_value)) if b is not None]
    condition = " AND ".join(compare(value, sign, bound) for sign, bound in zip(signs, bounds))
    return condition if "TRY_CAST" in value else Sure(condition)


@column_rule("expect_column_values_to_be_in_set")
def in_set(field: Field, value_set):
    condition = member(field, value_set)
    return condition if "TRY_CAST" in condition else Sure(condition)


@column_rule("expect_column_values_to_not_be_in_set")
def not_in_set(field: Field, value_set):
    return f"NOT coalesce({member(field, value_set)}, false)"


@column_rule("expect_column_values_to_match_regex")
def match_regex(field: Field, regex):
    return Sure(f"{as_text(field)} RLIKE {quote(regex)}")


@column_rule("expect_column_values_to_match_strftime_format")
def match_strftime(field: Field, strftime_format):
    matched = matches_strftime(as_text(field), strftime_format)
    if strftime_format == "%Y-%m-%d" and field.is_text:
        # Most such text has all its digits; that check is shared with the date rules.
        return f"({as_date(field)}) IS NOT NULL OR {matched}"
    return matched


@column_rule("expect_column_values_to_be_dateutil_parseable")
def parseable(field: Field):
    return "true" if field.is_time else is_parseable(as_text(field))


@column_rule("expect_column_values_to_meet_date_condition", date=today_in_hong_kong, operator="==")
def date_condition(field: Field, date, operator):
    return compare(as_date(field), operator, date_literal(date))


DATE_CONDITION = RULES["expect_column_values_to_meet_date_condition"]
# Every row is judged, and the percentage is over all rows, to one decimal.
DATE_CONDITION_V1 = DATE_CONDITION.derive(
    "expect_column_values_to_meet_date_condition_v1", nulls=JUDGE, percent=PERCENT_ROUNDED
)
DATE_CONDITION.derive("expect_column_values_to_meet_date_condition_nfn", nulls=LIST)
DATE_CONDITION.derive("expect_column_values_to_meet_date_condition_uuid")
RULES["expect_column_values_to_not_be_null"].derive("expect_column_values_to_not_be_null_uuid")
RULES["expect_column_values_to_be_between"].derive("expect_column_values_to_be_between_nfn", nulls=LIST)


def _unpack_method(kwargs: dict) -> dict:
    method = kwargs.pop("method")
    return {**kwargs, **dict(zip(("column", "date", "operator", "mostly"), method, strict=True))}


# The same rule with its four arguments packed into one.
DATE_CONDITION_V1.derive("expect_column_values_to_meet_condition", adapt=_unpack_method)


@column_rule("expect_column_values_to_match_date_format", nulls=LIST, date_format="YYYY-MM-DD")
def match_date_format(field: Field, date_format):
    text = as_text(field)
    regex = date_format_regex(date_format)
    if date_format == "YYYY-MM-DD" and field.is_text:
        return f"({as_date(field)}) IS NOT NULL"
    return f"CASE WHEN {text} RLIKE {quote(regex)} THEN TRY_CAST({text} AS DATE) IS NOT NULL ELSE false END"


@column_rule("expect_column_values_to_be_specific_day", day_of_month=None, day_of_week=None)
def specific_day(field: Field, day_of_month, day_of_week):
    """A day of the month (negative: from its end) and/or of the week (1 = Monday)."""
    for name, value in (("day_of_month", day_of_month), ("day_of_week", day_of_week)):
        if value is not None and (isinstance(value, bool) or not isinstance(value, int)):
            raise TypeError(f"{name} must be a whole number")
    if day_of_week is not None and not 1 <= day_of_week <= 7:
        raise ValueError("day_of_week must be 1 (Monday) to 7 (Sunday)")
    day = as_date(field)
    tests = [f"({day}) IS NOT NULL"]
    if day_of_month is not None and day_of_month > 0:
        tests.append(f"dayofmonth({day}) = {day_of_month}")
    elif day_of_month is not None:
        tests.append(f"datediff(last_day({day}), {day}) + 1 = {-day_of_month}")
    if day_of_week is not None:
        tests.append(f"weekday({day}) + 1 = {day_of_week}")
    return " AND ".join(tests)


@column_rule(
    "expect_column_values_to_be_greater_than_one_hundred", nulls=JUDGE, percent=FRACTION, observe_ratio=True
)
def greater_than_one_hundred(field: Field):
    return f"{as_double(field)} > 100"


register(RuleType("expect_column_values_to_be_unique", "duplicates"))
register(RuleType("expect_column_values_to_be_increasing", "order"))
