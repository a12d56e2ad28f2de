"""Semantics of suites, domains and results, on small tables with known answers."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayer import RULES, Rule, Suite, column_rule, fill_for_display, run_validation, table_rule, validate

ROWS = [
    (1, "2024-01-01", 10.0, 10.0, "a"),
    (2, "2024-02-30", None, 5.0, "a"),
    (3, None, 30.0, None, "b"),
    (4, "abc", float("nan"), 40.0, None),
    (5, "2024-09-08", 50.0, 50.5, "c"),
    (6, "2024-12-31", None, None, "c"),
]
SCHEMA = "id int, day string, x double, y double, kind string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def one(df, name, **kwargs):
    outcome = validate(df, [Rule.of(f"expect_{name}", **kwargs)], keys=["id"], strict=True)
    row = outcome.graded.collect()[0]
    listed = [r.id for r in outcome.violations.orderBy("id").collect()]
    return (row.element_count, row.missing_count, row.unexpected_count, row.success), listed


def test_missing_rows_are_neither_judged_nor_listed(df):
    assert one(df, "column_values_to_be_between", column="x", min_value=20) == ((6, 3, 1, False), [1])


def test_missing_rows_can_be_listed(df):
    assert one(df, "column_values_to_be_between_nfn", column="x", min_value=20) == ((6, 3, 1, False), [1, 2, 4, 6])


def test_every_row_can_be_judged(df):
    args = dict(column="day", date="2024-09-08", operator=">=")
    assert one(df, "column_values_to_meet_date_condition", **args) == ((6, 1, 3, False), [1, 2, 4])
    assert one(df, "column_values_to_meet_date_condition_v1", **args) == ((6, None, 4, False), [1, 2, 3, 4])


def test_nan_is_missing(df):
    assert one(df, "column_values_to_not_be_null", column="x") == ((6, None, 3, False), [2, 4, 6])


@pytest.mark.parametrize(
    "mode, rows, listed",
    [
        ("both_values_are_missing", 5, [2, 3, 4, 5]),
        ("either_value_is_missing", 2, [5]),
        ("neither", 6, [2, 3, 4, 5, 6]),
    ],
)
def test_pair_modes(df, mode, rows, listed):
    args = dict(column_A="x", column_B="y", ignore_row_if=mode)
    counts, ids = one(df, "column_pair_values_to_be_equal", **args)
    assert (counts[0], ids) == (rows, listed)


def test_row_condition_and_empty_domain(df):
    args = dict(column="x", min_value=20)
    assert one(df, "column_values_to_be_between", row_condition='kind IN ("a", "c")', **args) == ((4, 2, 1, False), [1])
    assert one(df, "column_values_to_be_between", row_condition="id > 99", **args) == ((0, 0, 0, True), [])


def test_division_by_zero_is_unexpected(spark):
    df = spark.createDataFrame([(1, 4.0, 2.0, 2.0), (2, 4.0, 0.0, 2.0)], "id int, a double, b double, c double")
    rule = dict(column_list=["a", "b", "c"], expr="{0}/{1}")
    assert one(df, "columns_arithmetic_to_equals_result_column", **rule) == ((2, None, 1, False), [2])


def test_tolerance_is_strict(spark):
    df = spark.createDataFrame([(1, 1.0, 1.5)], "id int, a double, c double")
    rule = dict(column_list=["a", "c"], expr="{0}")
    assert one(df, "columns_arithmetic_to_equals_result_column", tolerance=0.5, **rule)[1] == [1]
    assert one(df, "columns_arithmetic_to_equals_result_column", tolerance=0.51, **rule)[1] == []


def test_default_date_is_today_in_hong_kong(spark):
    df = spark.createDataFrame([(1, "2024-09-08"), (2, "2024-09-09")], "id int, day string")
    late = dt.datetime(2024, 9, 8, 20, 0, tzinfo=dt.timezone.utc)  # already the 9th there
    rule = Rule.of("expect_column_values_to_meet_date_condition", column="day")
    assert [r.id for r in validate(df, [rule], ["id"], run_time=late).violations.collect()] == [1]


def test_type_and_schema_rules(df):
    def passed(name, **kwargs):
        return validate(df, [Rule.of(f"expect_{name}", **kwargs)], strict=True).graded.collect()[0].success

    assert passed("column_to_exist", column="x") and not passed("column_to_exist", column="z")
    assert passed("column_values_to_be_of_type", column="id", type_="int64")
    assert passed("column_values_to_be_of_type", column="kind", type_="StringType")
    assert not passed("column_values_to_be_of_type", column="kind", type_="float64")
    assert passed("table_column_count_to_be_between", min_value=5, max_value=5)
    assert not passed("column_mean_to_be_between", column="x", max_value=1)
    assert passed("column_mean_to_be_between", column="x", min_value=30, max_value=30)


def test_suite_identity():
    price = dict(column="price")
    suite = Suite(
        "s",
        [
            Rule.of("expect_column_values_to_be_between", min_value=1, **price),
            Rule.of("expect_column_values_to_not_be_null", **price),
            Rule.of("expect_column_values_to_be_between", min_value=2, **price),
            Rule.of("expect_column_values_to_be_between", min_value=3, row_condition="1=1", **price),
            Rule.of("expect_column_values_to_be_between", min_value=4, uuid="u", **price),
        ],
    )
    assert [(r.rule_id, r.kwargs.get("min_value")) for r in suite] == [
        ("rule_001", 2),
        ("rule_002", None),
        ("rule_003", 3),
        ("u", 4),
    ]


def test_config_keeps_meta_in_both_places_and_fills_parameters():
    config = [
        {"expectation_type": "t", "kwargs": {"column": "a", "value_set": [{"$PARAMETER": "p"}], "meta": {"Rule": "R1"}}},
        {"expectation_type": "t", "kwargs": {"column": "b"}, "meta": {"Rule": "R2"}},
    ]
    rules = list(Suite.from_config("s", config, {"p": 7}))
    assert [r.meta["Rule"] for r in rules] == ["R1", "R2"]
    assert rules[0].kwargs["value_set"] == [7] and "meta" not in rules[0].kwargs
    with pytest.raises(KeyError, match="'p'"):
        Suite.from_config("s", config)


def test_saved_suite_is_the_same(spark, tmp_path):
    suite = Suite("s", [Rule.of("expect_column_values_to_be_in_set", column="a", value_set=[1, "ü"], meta={"Rule": "R"})])
    suite.save(spark, str(tmp_path / "suite"))
    assert Suite.load(spark, str(tmp_path / "suite")) == suite


def test_bad_rules_fail_alone(df):
    rules = [
        Rule.of("expect_column_values_to_not_be_null", column="id"),
        Rule.of("expect_column_values_to_not_be_null", column="nowhere"),
        Rule.of("expect_column_values_to_be_between", column="x", min_value=1, row_condition="id >"),
        Rule.of("expect_column_values_to_match_date_format", column="day", date_format="DD"),
        Rule.of("expect_column_values_to_be_specific_day", column="day", day_of_month="1"),
        Rule.of("expect_column_values_to_be_increasing", column="x"),
        Rule.of("expect_column_values_to_be_between", column="y", min_value=1, unknown=2),
        Rule.of("expect_column_values_to_not_be_null", column="x", mostly=2),
    ]
    rows = validate(df, rules, result_format="COMPLETE").results.orderBy("position").collect()
    assert [r.success for r in rows] == [True] + [False] * 7
    assert [r.raised_exception for r in rows] == [False] + [True] * 7
    assert all(r.exception_message and "Traceback" in r.exception_traceback for r in rows[1:])
    with pytest.raises(KeyError):
        validate(df, rules, strict=True)


def test_only_bad_rules_and_no_rules(df):
    assert validate(df, [Rule.of("expect_nothing")]).stats.collect()[0][:2] == (False, 1)
    assert validate(df, []).stats.collect()[0][:2] == (True, 0)
    assert validate(df, [], keys=["id"]).report().count() == 0


def test_result_levels(df):
    rules = [
        Rule.of("expect_column_values_to_be_between", column="x", min_value=20),
        Rule.of("expect_column_values_to_not_be_null", column="kind", result_format="SUMMARY"),
    ]
    basic, summary = validate(df, rules, keys=["id"]).results.orderBy("position").collect()
    assert basic.partial_unexpected_list == ["10.0"] and basic.partial_unexpected_counts is None
    assert summary.partial_unexpected_index_list == [{"id": "4"}]
    assert [tuple(c) for c in summary.partial_unexpected_counts] == [(None, 1)]
    options = {
        "result_format": "COMPLETE",
        "unexpected_index_column_names": ["id"],
        "return_unexpected_index_query": False,
        "partial_unexpected_count": 0,
    }
    complete = validate(df, rules, result_format=options).results.orderBy("position").first()
    assert complete.unexpected_index_query is None and complete.partial_unexpected_list is None
    query = validate(df, rules[:1], ["id"], "COMPLETE").results.first().unexpected_index_query
    assert [r.id for r in df.filter(query).collect()] == [1]
    with pytest.raises(ValueError):
        validate(df, rules, result_format="VERBOSE")


def test_report_and_display(df):
    rules = [
        Rule.of("expect_column_values_to_be_between", column="x", min_value=20, meta={"Rule": "R2"}),
        Rule.of("expect_column_values_to_not_be_null", column="id", meta={"Rule": "R2"}),
        Rule.of("expect_column_values_to_not_be_null", column="kind", meta={"Rule": "R1"}),
        Rule.of("expect_column_values_to_be_in_set", column="kind", value_set=["a", "b", "c"], meta={"Rule": "R0"}),
    ]
    outcome = validate(df, rules, keys=["id"])
    assert [(r.rule, r.column, r.value, r.id, r["pass"]) for r in outcome.report().collect()] == [
        ("R0", "kind", None, None, True),
        ("R1", "kind", None, 4, False),
        ("R2", "x", "10.0", 1, False),
        ("R2", "id", None, None, False),
    ]
    assert fill_for_display(outcome.violations).filter("value = 'nan'").count() == 1


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 5, 1), (2, 5, 3)], "`a key` int, value int, position int")
    rules = [
        Rule.of("expect_column_values_to_be_unique", column="value"),
        Rule.of("expect_column_values_to_be_between", column="value", min_value=6),
        Rule.of("expect_column_values_to_be_between", column="position", max_value=2),
        Rule.of("expect_column_values_to_be_increasing", column="position", order_by="a key"),
    ]
    rows = validate(df, rules, keys=["a key"], strict=True).violations.collect()
    assert sorted((r.rule_id, r.value, r["a key"]) for r in rows) == [
        ("rule_001", "5", 1),
        ("rule_001", "5", 2),
        ("rule_002", "5", 1),
        ("rule_002", "5", 2),
        ("rule_003", "3", 2),
    ]
    with pytest.raises(ValueError, match="value"):
        validate(df, rules, keys=["value"])


def test_own_rules(spark, df):
    @column_rule("expect_test_even", factor=1)
    def even(field, factor):
        return (field.col * factor) % 2 == 0

    @table_rule("expect_test_any", at_least=1)
    def any_rows(table, at_least):
        return table.agg((F.count(F.lit(1)) >= at_least).alias("success"), F.count(F.lit(1)).alias("element_count"))

    RULES["expect_test_even"].derive("expect_test_even_twice", defaults=dict(factor=2))
    rules = [
        Rule.of("expect_test_even", column="id"),
        Rule.of("expect_test_even_twice", column="id"),
        Rule.of("expect_test_any", at_least=7),
    ]
    outcome = validate(df, rules, keys=["id"], result_format="COMPLETE", strict=True)
    rows = outcome.results.orderBy("position").collect()
    assert [r.success for r in rows] == [False, True, False]
    assert rows[0].unexpected_count == 3 and rows[0].unexpected_index_query is None
    assert sorted(r.id for r in outcome.violations.collect()) == [1, 3, 5]


def test_job(spark, df):
    seen = []
    outcome = run_validation(
        spark,
        lambda session, least: df.filter(F.col("id") >= least),
        [{"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "day"}}],
        lambda results, into: into.extend(results.collect()),
        loader_kwargs={"least": 3},
        writer_kwargs={"into": seen},
        run_id="r1",
    )
    assert (seen[0].run_id, seen[0].element_count, seen[0].unexpected_count) == ("r1", 4, 1)
    assert outcome.stats.collect()[0].success is False
    with pytest.raises(TypeError):
        validate([1], [])
    with pytest.raises(TypeError):
        run_validation(spark, lambda session: [1], [])


MIXED = [
    Rule.of("expect_column_values_to_be_between", column="n", min_value=-2, max_value=4, rule_id="between"),
    Rule.of("expect_column_values_to_be_between", column="t", min_value=0, rule_id="text number"),
    Rule.of("expect_column_values_to_be_in_set", column="t", value_set=["1", "x"], rule_id="set"),
    Rule.of("expect_column_values_to_not_be_null", column="t", rule_id="null"),
    Rule.of("expect_column_values_to_match_date_format_", column="t", rule_id="bad"),
    Rule.of("expect_column_values_to_match_date_format", column="t", date_format="YYYY-MM", rule_id="format"),
    Rule.of("expect_column_values_to_meet_date_condition_v1", column="t", date="2024-01-01", operator="<=", rule_id="v1"),
    Rule.of("expect_column_pair_values_to_meet_compare_condition", column_A="n", column_B="t", rule_id="pair"),
    Rule.of("expect_multicolumn_sum_to_equal", column_list=["n", "m"], value=3, rule_id="sum"),
    Rule.of("expect_column_values_to_be_unique", column="n", rule_id="unique"),
    Rule.of("expect_column_values_to_be_unique", column="t", row_condition="n > 0", rule_id="unique text"),
    Rule.of("expect_column_values_to_be_increasing", column="m", order_by="n", rule_id="order"),
]
ROW = st.tuples(
    st.one_of(st.none(), st.integers(-3, 6)),
    st.one_of(st.none(), st.integers(-3, 6)),
    st.sampled_from([None, "1", "-1.5", "x", "2024-01", "2024-01-01", "2023-02-30", "", "3"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=25))
def test_counts_agree_with_rows(spark, rows):
    """Fused, single and listed forms agree, and the counts add up, with and without ANSI mode."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n int, m int, t string")
    seen = {}
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            outcome = validate(df, Suite("mixed", MIXED), keys=["i"])
            graded = {r.rule_id: r for r in outcome.graded.collect()}
            listed = outcome.violations.groupBy("rule_id").count().collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        listed = {r[0]: r[1] for r in listed}
        for name, row in graded.items():
            if name == "bad":
                continue
            missing = row.missing_count or 0
            assert 0 <= row.unexpected_count <= row.element_count - missing
            assert row.success == (row.unexpected_count == 0)
            extra = missing if name == "format" else 0
            assert listed.get(name, 0) == row.unexpected_count + extra
            assert row.clean == (name not in listed)
        seen[ansi] = {k: (r.element_count, r.missing_count, r.unexpected_count) for k, r in graded.items()}
    assert seen["true"] == seen["false"]

    values = [r[0] for r in rows if r[0] is not None]
    assert seen["true"]["unique"] == (len(rows), len(rows) - len(values), sum(values.count(v) > 1 for v in values))
    steps = sorted(((r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None))
    falls = sum(b[2] < a[2] for a, b in zip(steps, steps[1:]))
    assert seen["true"]["order"] == (len(rows), sum(r[1] is None for r in rows), falls)
