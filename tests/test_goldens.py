"""Rules on a small dirty table, with results worked out in plain Python."""

import datetime as dt

import pytest

from assayer import Rule, Suite, validate

NOW = dt.datetime(2025, 7, 11, tzinfo=dt.timezone.utc)
COLUMNS = "visit int, fee double, channel string, guest int, nights int, arrival string, leaving string, paid double"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def visit(i):
    arrival = dt.date(2024, 3, 1) + dt.timedelta(days=i)
    leaving = arrival + dt.timedelta(days=i % 4 - (i == 9))
    return (
        i,
        None if i % 11 == 0 else 40.0 + 7 * (i % 13),
        [None, "desk", "web_shop", "phone", "web_page"][i % 5],
        100 + i % 17,
        i % 4,
        None if i % 10 == 4 else "soon" if i == 7 else str(arrival)[:7] if i == 8 else str(arrival),
        None if i % 9 == 5 else str(leaving),
        None if i % 7 == 3 else (40.0 + 7 * (i % 13)) * (i % 4) + (5 if i == 12 else 0),
    )


ROWS = [dict(zip(NAMES, visit(i))) for i in range(28)]


def day(text):
    try:
        return dt.date.fromisoformat(text) if text and len(text) == 10 else None
    except ValueError:
        return None


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame([tuple(r.values()) for r in ROWS], COLUMNS)


def column(name, good, **kwargs):
    """(rule, missing, unexpected, listed) of a rule that leaves missing values out."""
    values = [r[name] for r in ROWS]
    given = [v for v in values if v is not None]
    bad = sum(not good(v) for v in given)
    return dict(column=name, **kwargs), len(values) - len(given), bad, bad


def listing_missing(case):
    """The same for a rule that also lists missing values, but does not count them as unexpected."""
    kwargs, missing, bad, _ = case
    return kwargs, missing, bad, bad + missing


def judging_missing(case):
    """The same for a rule to which a missing value is unexpected."""
    kwargs, missing, bad, _ = case
    return kwargs, 0, bad + missing, bad + missing


SINCE = dt.date(2024, 3, 6)
CASES = {
    "column_values_to_be_between": column("fee", lambda v: 50 <= v <= 100, min_value=50, max_value=100),
    "column_values_to_be_in_set": column("channel", {"desk", "phone"}.__contains__, value_set=["desk", "phone"]),
    "column_values_to_not_be_in_set": column("channel", lambda v: v != "desk", value_set=["desk", "boat"]),
    "column_values_to_match_regex": column("channel", lambda v: v.startswith("web_"), regex="^web_"),
    "column_values_to_match_date_format": listing_missing(column("arrival", day)),
    "column_values_to_match_strftime_format": column("arrival", day, strftime_format="%Y-%m-%d"),
    "column_values_to_be_dateutil_parseable": column("arrival", lambda v: v != "soon"),
    "column_values_to_meet_date_condition": column(
        "arrival", lambda v: day(v) is not None and day(v) >= SINCE, date=str(SINCE), operator=">="
    ),
    "column_values_to_be_specific_day": column("leaving", lambda v: day(v).isoweekday() == 1, day_of_week=1),
    "column_values_to_be_greater_than_one_hundred": judging_missing(column("fee", lambda v: v > 100)),
    "column_values_to_be_unique": column("guest", lambda v: sum(r["guest"] == v for r in ROWS) == 1),
}


@pytest.mark.parametrize("name", CASES)
def test_column_rules(spark, visits, name):
    kwargs, missing, unexpected, listed = CASES[name]
    outcome = validate(visits, [Rule.of(f"expect_{name}", **kwargs)], run_time=NOW, strict=True)
    row = outcome.graded.collect()[0]
    assert (row.element_count, row.missing_count or 0, row.unexpected_count) == (len(ROWS), missing, unexpected)
    assert row.success == (unexpected == 0) and outcome._listed.count() == listed


@pytest.mark.parametrize(
    "mode,kept",
    [("both_values_are_missing", lambda a, b: a or b), ("either_value_is_missing", lambda a, b: a and b), ("neither", lambda a, b: 1)],
)
def test_days_between(spark, visits, mode, kept):
    pairs = [(r["arrival"], r["leaving"]) for r in ROWS]
    pairs = [(a, b) for a, b in pairs if kept(a is not None, b is not None)]
    bad = sum(not (day(a) and day(b) and (day(b) - day(a)).days >= 0) for a, b in pairs)
    rule = Rule.of(
        "expect_column_pair_days_diff_to_meet_condition",
        column_A="leaving",
        column_B="arrival",
        operator=">=",
        days=0,
        ignore_row_if=mode,
    )
    row = validate(visits, [rule], run_time=NOW, strict=True).graded.collect()[0]
    assert (row.element_count, row.unexpected_count) == (len(pairs), bad)


def test_arithmetic(spark, visits):
    judged = [r for r in ROWS if None not in (r["fee"], r["nights"], r["paid"])]
    bad = sum(abs(r["fee"] * r["nights"] - r["paid"]) > 0.01 for r in judged)
    rule = Rule.of(
        "expect_columns_arithmetic_to_equals_result_column",
        column_list=["fee", "nights", "paid"],
        expr="{0}*{1}",
        ignore_row_if="any_value_is_missing",
    )
    row = validate(visits, [rule], run_time=NOW, strict=True).graded.collect()[0]
    assert (row.element_count, row.unexpected_count) == (len(judged), bad) and bad == 1


def test_suite_of_table_rules(spark, visits):
    fees = [r["fee"] for r in ROWS if r["fee"] is not None]
    rules = {
        "column_to_exist": (dict(column="fee"), True),
        "column_values_to_be_of_type": (dict(column="guest", type_="int64"), False),
        "table_row_count_to_be_between": (dict(min_value=len(ROWS), max_value=len(ROWS)), True),
        "table_column_count_to_be_between": (dict(min_value=9), False),
        "column_mean_to_be_between": (dict(column="fee", min_value=min(fees), max_value=max(fees)), True),
    }
    outcome = validate(visits, Suite("table", [Rule.of(f"expect_{n}", **k) for n, (k, _) in rules.items()]), run_time=NOW)
    assert [r.success for r in outcome.graded.orderBy("position").collect()][2:] == [True, False, True]
    stats = outcome.stats.first()
    assert stats.evaluated_expectations == 5 and stats.successful_expectations in (3, 4)
    assert abs(outcome.graded.filter("position = 4").first().observed_value - sum(fees) / len(fees)) < 1e-9


def test_falling_values_and_offending_rows(spark, visits):
    given = [r["fee"] for r in ROWS if r["fee"] is not None]
    falls = sum(b < a for a, b in zip(given, given[1:]))
    rule = Rule.of("expect_column_values_to_be_increasing", column="fee", order_by="visit")
    outcome = validate(visits, [rule], keys=["visit"], run_time=NOW, strict=True)
    assert outcome.graded.first().unexpected_count == falls == outcome.violations.count() > 0
