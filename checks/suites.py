"""Queries over whole suites: results, lists of offending rows, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer import Rule, Suite, fill_for_display, latest_results, run_validation, validate
from assayer.sources import (
    read_csv,
    read_latest,
    read_results,
    read_runs,
    read_violations,
    stored_report,
    write_csv,
    write_results,
    write_violations,
)

from .oracle import day, row_result, union
from .rules import MANY, many_uniques, repeated_sql, verdicts
from .tables import scratch, table, table_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

ORDERS = table_sql("dirty_orders")
KEYS = ["o_orderkey"]
FIRST_RUN = dt.datetime(2024, 9, 8, 8, 0, tzinfo=dt.timezone.utc)
SECOND_RUN = dt.datetime(2024, 9, 9, 8, 0, tzinfo=dt.timezone.utc)
SINCE = dict(column="order_date", date="1996-01-01", operator=">=")


def grouped_rules() -> list[Rule]:
    """Two business rules: a date with a not-null check, a format with another; and a clean one."""
    return [
        Rule.of("expect_column_values_to_meet_date_condition", meta={"Rule": "R0001"}, rule_id="since", **SINCE),
        Rule.of("expect_column_values_to_not_be_null", meta={"Rule": "R0001"}, rule_id="dated", column="order_date"),
        Rule.of(
            "expect_column_values_to_match_date_format", meta={"Rule": "R0002"}, rule_id="format", column="order_date"
        ),
        Rule.of(
            "expect_column_values_to_be_in_set",
            meta={"Rule": "R0002"},
            rule_id="state",
            column="status",
            value_set=["F", "O", "P"],
        ),
        Rule.of(
            "expect_column_values_to_be_between", meta={"Rule": "R0003"}, rule_id="priced", column="price", min_value=0
        ),
    ]


# The same five rules in SQL: rule, type, column, predicate for a listed row, shown value.
LISTED = [
    (
        "since",
        "R0001",
        "column_values_to_meet_date_condition",
        "order_date",
        f"order_date is not null and not coalesce({day('order_date')} >= date '1996-01-01', false)",
    ),
    ("dated", "R0001", "column_values_to_not_be_null", "order_date", "order_date is null"),
    ("format", "R0002", "column_values_to_match_date_format", "order_date", f"({day('order_date')}) is null"),
    ("state", "R0002", "column_values_to_be_in_set", "status", "status not in ('F', 'O', 'P')"),
    ("priced", "R0003", "column_values_to_be_between", "price", "not price >= 0"),
]


def listed_sql(only: tuple[str, ...] = ()) -> str:
    return union(
        *[
            f"select '{rule_id}' as rule_id, '{rule}' as rule, 'expect_{name}' as expectation_type,"
            f" '{column}' as \"column\", cast({column} as string) as value, o_orderkey from {ORDERS} t where {bad}"
            for rule_id, rule, name, column, bad in LISTED
            if not only or rule_id in only
        ]
    )


def grouped(spark: SparkSession, sf_dir: str, **kwargs):
    return validate(table(spark, sf_dir, "dirty_orders"), Suite("grouped", grouped_rules()), keys=KEYS, **kwargs)


def query(name: str, sql: str | None):
    def wrap(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return wrap


RESULTS_SQL = union(
    row_result(
        "column_values_to_meet_date_condition",
        "dirty_orders",
        f"{day('order_date')} >= date '1996-01-01'",
        "order_date is null",
        rule_id="since",
    ),
    row_result("column_values_to_not_be_null", "dirty_orders", "order_date is not null", rule_id="dated"),
    row_result(
        "column_values_to_match_date_format",
        "dirty_orders",
        f"({day('order_date')}) is not null",
        "order_date is null",
        rule_id="format",
    ),
    row_result(
        "column_values_to_be_in_set",
        "dirty_orders",
        "status in ('F', 'O', 'P')",
        "status is null",
        rule_id="state",
    ),
    row_result("column_values_to_be_between", "dirty_orders", "price >= 0", "price is null", rule_id="priced"),
)


def short(results: DataFrame, *more: Column) -> DataFrame:
    """The columns of a result that the oracles compare."""
    return results.select(
        "rule_id",
        "expectation_type",
        "success",
        "element_count",
        "missing_count",
        "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"),
        F.round("observed_value", 6).alias("observed_value"),
        *more,
    )


@query(
    "suite_results",
    f"""
select *, round(100::double * missing_count / element_count, 6) as missing_percent,
       round(100::double * unexpected_count / element_count, 6) as unexpected_percent_total,
       round(100::double * unexpected_count / (element_count - coalesce(missing_count, 0)), 6)
           as unexpected_percent_nonmissing
from ({RESULTS_SQL}) r""",
)
def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = ("missing_percent", "unexpected_percent_total", "unexpected_percent_nonmissing")
    return short(grouped(spark, sf_dir).graded, *[F.round(c, 6).alias(c) for c in shares])


@query(
    "suite_stats",
    f"""
select count(*) filter (where not success) = 0 as success, count(*) as evaluated_expectations,
       count(*) filter (where success) as successful_expectations,
       count(*) filter (where not success) as unsuccessful_expectations,
       round(100::double * count(*) filter (where success) / count(*), 6) as success_percent
from ({RESULTS_SQL}) r""",
)
def suite_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).stats.withColumn("success_percent", F.round("success_percent", 6))


@query("violations", f"select * exclude (rule) from ({listed_sql()}) v")
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).violations.drop("run_id", "rule")


@query(
    "violations_shuffled_rules",
    f"""
select 'repeated' as rule_id, cast(user_id as string) as value, event_id
from (select *, count(*) over (partition by user_id) as k from events where event_type = 'error') t where k > 1
union all
select 'falling' as rule_id, cast(value as string) as value, event_id
from (select event_id, value, lag(value) over (order by event_id) as before
      from {table_sql('dirty_events')} t where value is not null) steps
where value < before""",
)
def violations_shuffled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind a uniqueness and an order rule."""
    rules = [
        Rule.of(
            "expect_column_values_to_be_unique",
            column="user_id",
            row_condition="given_type = 'error'",
            rule_id="repeated",
        ),
        Rule.of("expect_column_values_to_be_increasing", column="value", order_by="event_id", rule_id="falling"),
    ]
    return validate(table(spark, sf_dir, "dirty_events"), Suite("shuffled", rules), keys=["event_id"]).violations.select(
        "rule_id", "value", "event_id"
    )


@query(
    "violations_unique_many",
    union(
        *[
            f"select 'u{i:02}' as rule_id, cast({c} as string) as value, l_orderkey, l_linenumber"
            f" from {repeated_sql(c, r)} t where inside and k > 1 and {c} is not null"
            for i, (c, r) in enumerate(MANY)
            if c not in ("l_extendedprice", "quantity", "discount")
        ]
    ),
)
def violations_unique_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind many uniqueness rules; engines write doubles differently, so those are left out."""
    rules = [Rule.of(f"expect_{name}", **kwargs) for name, kwargs in many_uniques()]
    kept = [r for r in rules if r.kwargs["column"] not in ("l_extendedprice", "quantity", "discount")]
    found = validate(table(spark, sf_dir, "dirty_lines"), Suite("uniques", kept), keys=["l_orderkey", "l_linenumber"])
    return found.violations.select("rule_id", "value", "l_orderkey", "l_linenumber")


@query(
    "violations_filled",
    f"select rule_id, coalesce(value, 'nan') as value, o_orderkey from ({listed_sql()}) v",
)
def violations_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_for_display(grouped(spark, sf_dir).violations).select("rule_id", "value", "o_orderkey")


@query(
    "violations_report",
    f"""
with listed as ({listed_sql()}),
rules as ({union(*[f"select '{i}' as rule_id, '{r}' as rule, 'expect_{n}' as expectation_type, '{c}' as col"
                   for i, r, n, c, _ in LISTED])})
select rule, expectation_type, "column", value, o_orderkey, false as pass from listed
union all
select rule, expectation_type, col, null, null, rule not in (select rule from listed) as pass
from rules where rule_id not in (select rule_id from listed)""",
)
def violations_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).report()


@query(
    "rule_pass",
    f"""
select rule, rule not in (select rule from ({listed_sql()}) v) as passed
from ({union(*[f"select '{r}' as rule" for r in ("R0001", "R0002", "R0003")])}) rules""",
)
def rule_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).rule_pass


@query("unexpected_counts", f'select rule_id, value, count(*) as "count" from ({listed_sql()}) v group by all')
def unexpected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).unexpected_counts.select("rule_id", "value", "count")


RANKED = f"select *, row_number() over (partition by rule_id order by o_orderkey) as place from ({listed_sql()}) v"


@query("partial_unexpected", f"select rule_id, place, value, o_orderkey from ({RANKED}) r where place <= 20")
def partial_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = grouped(spark, sf_dir, result_format="SUMMARY").results
    pairs = F.arrays_zip(
        F.col("partial_unexpected_list").alias("value"), F.col("partial_unexpected_index_list").alias("index")
    )
    rows = results.select("rule_id", F.posexplode(pairs).alias("place", "row"))
    return rows.select(
        "rule_id",
        (F.col("place") + 1).cast("bigint").alias("place"),
        F.col("row.value").alias("value"),
        F.col("row.index")["o_orderkey"].cast("bigint").alias("o_orderkey"),
    )


@query(
    "partial_unexpected_counts",
    f"""
select rule_id, value, n as "count" from (
    select rule_id, value, count(*) as n,
           row_number() over (partition by rule_id order by count(*) desc, value nulls last) as place
    from ({listed_sql()}) v group by rule_id, value) r
where place <= 20""",
)
def partial_unexpected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = grouped(spark, sf_dir, result_format="SUMMARY").results
    return results.select("rule_id", F.inline("partial_unexpected_counts"))


@query(
    "format_levels",
    f"""
with listed as (select rule_id, count(*) as n, count(distinct value) + max((value is null)::int) as v
                from ({listed_sql()}) v group by rule_id),
rules as (select * from (values {', '.join(f"('{r[0]}')" for r in LISTED)}) x(rule_id)),
levels as (select * from (values ('BASIC', 0), ('SUMMARY', 1), ('COMPLETE', 2)) x(level, depth))
select level, rules.rule_id, least(20, coalesce(n, 0))::bigint as listed,
       case when depth >= 1 then least(20, coalesce(n, 0)) end::bigint as indexed,
       case when depth >= 1 then least(20, coalesce(v, 0)) end::bigint as counted,
       depth >= 2 as has_query
from levels, rules left join listed on rules.rule_id = listed.rule_id""",
)
def format_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    def filled(level: str) -> DataFrame:
        return grouped(spark, sf_dir, result_format=level).results.select(
            F.lit(level).alias("level"),
            "rule_id",
            F.array_size("partial_unexpected_list").cast("bigint").alias("listed"),
            F.array_size("partial_unexpected_index_list").cast("bigint").alias("indexed"),
            F.array_size("partial_unexpected_counts").cast("bigint").alias("counted"),
            F.col("unexpected_index_query").isNotNull().alias("has_query"),
        )

    return filled("BASIC").unionByName(filled("SUMMARY")).unionByName(filled("COMPLETE"))


@query(
    "unexpected_query",
    f"select rule_id, count(*) as n, cast(sum(o_orderkey) as bigint) as key_sum from ({listed_sql()}) v group by rule_id",
)
def unexpected_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule's query text, used as a filter on the table."""
    orders = table(spark, sf_dir, "dirty_orders")
    found = None
    for check in grouped(spark, sf_dir).checks:
        rows = orders.filter(check.query).select(F.lit(check.rule.rule_id).alias("rule_id"), "o_orderkey")
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "rule_identity",
    f"""
select rule_id, row_condition,
       (select count(*) from {ORDERS} t where status is null) as unexpected_count
from (values ('00001', null), ('00002', null), ('rule_001', '1=1'), ('rule_002', '2=2')) x(rule_id, row_condition)""",
)
def rule_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rules replace each other unless an id or a row condition tells them apart."""
    status = dict(column="status")
    rules = [
        Rule.of("expect_column_values_to_not_be_null_uuid", uuid="00001", **status),
        Rule.of("expect_column_values_to_not_be_null_uuid", uuid="00002", **status),
        Rule.of("expect_column_values_to_not_be_null_uuid", uuid="00002", **status),
        Rule.of("expect_column_values_to_not_be_null", row_condition="1=1", condition_parser="spark", **status),
        Rule.of("expect_column_values_to_not_be_null", row_condition="2=2", condition_parser="spark", **status),
        Rule.of("expect_column_values_to_not_be_null", row_condition="2=2", mostly=0.5, **status),
    ]
    results = validate(table(spark, sf_dir, "dirty_orders"), Suite("identity", rules)).results
    return results.select("rule_id", F.col("kwargs")["row_condition"].alias("row_condition"), "unexpected_count")


@query(
    "rule_exception",
    f"""
select 'good' as rule_id, false as raised_exception, count(*) filter (where status is null) = 0 as success,
       count(*) filter (where status is null) as unexpected_count from {ORDERS} t
union all
select rule_id, true, false, null
from (values ('column'), ('operator'), ('condition'), ('unknown'), ('weekday'), ('regex'), ('bound'), ('member'),
             ('sum')) x(rule_id)
union all
select 'casting', false, true, 0""",
)
def rule_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule that cannot run fails by itself and says why."""
    rules = [
        Rule.of("expect_column_values_to_not_be_null", column="status", rule_id="good"),
        Rule.of("expect_column_values_to_not_be_null", column="nowhere", rule_id="column"),
        Rule.of(
            "expect_column_values_to_meet_date_condition", column="order_date", operator="<>", rule_id="operator"
        ),
        Rule.of(
            "expect_column_values_to_not_be_null", column="price", row_condition="nowhere > 1", rule_id="condition"
        ),
        Rule.of("expect_column_values_to_be_perfect", column="price", rule_id="unknown"),
        Rule.of("expect_column_values_to_be_specific_day", column="order_date", day_of_week=8, rule_id="weekday"),
        Rule.of("expect_column_values_to_match_regex", column="status", regex="(", rule_id="regex"),
        Rule.of("expect_column_values_to_be_between", column="o_orderdate", min_value="someday", rule_id="bound"),
        Rule.of("expect_column_values_to_be_in_set", column="o_orderdate", value_set=["someday"], rule_id="member"),
        Rule.of(
            "expect_multicolumn_sum_to_equal", column_list=["price", "o_orderkey"], value="much", rule_id="sum"
        ),
        # Not every status is a number; the condition then leaves its row out.
        Rule.of(
            "expect_column_values_to_not_be_null",
            column="price",
            row_condition="CAST(status AS INT) > 1",
            rule_id="casting",
        ),
    ]
    results = validate(table(spark, sf_dir, "dirty_orders"), Suite("exceptions", rules)).results
    told = F.col("exception_message").isNotNull() == F.col("raised_exception")
    return results.filter(told).select("rule_id", "raised_exception", "success", "unexpected_count")


CONFIG = [
    {
        "expectation_type": "expect_column_values_to_be_in_set",
        "kwargs": {"column": "status", "value_set": ["F", "O", "P"]},
        "rule_id": "state",
    },
    {
        "expectation_type": "expect_column_values_to_meet_date_condition",
        "kwargs": {
            "column": "order_date",
            "date": {"$PARAMETER": "since"},
            "operator": ">=",
            "meta": {"description": "dates"},
            "row_condition": "o_orderkey > -1",
            "condition_parser": "pandas",
        },
        "rule_id": "since",
    },
]


def config_sql(since: str) -> str:
    return union(
        row_result(
            "column_values_to_be_in_set",
            "dirty_orders",
            "status in ('F', 'O', 'P')",
            "status is null",
            rule_id="state",
        ),
        row_result(
            "column_values_to_meet_date_condition",
            "dirty_orders",
            f"{day('order_date')} >= date '{since}'",
            "order_date is null",
            rule_id="since",
        ),
    )


@query("suite_from_config", config_sql("1996-01-01"))
def suite_from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = [CONFIG[0], {**CONFIG[1], "kwargs": {**CONFIG[1]["kwargs"], "date": "1996-01-01"}}]
    return verdicts(table(spark, sf_dir, "dirty_orders"), list(Suite.from_config("config", fixed)))


@query("suite_params", config_sql("1998-07-01"))
def suite_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = Suite.from_config("config", CONFIG, {"since": "1998-07-01"})
    return verdicts(table(spark, sf_dir, "dirty_orders"), list(suite))


@query("suite_roundtrip", RESULTS_SQL)
def suite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "suite")
    Suite("grouped", grouped_rules()).save(spark, path)
    return short(validate(table(spark, sf_dir, "dirty_orders"), Suite.load(spark, path, "grouped")).graded)


def _stored_runs(spark: SparkSession, sf_dir: str) -> str:
    """Two runs in one results dataset: all orders, then those with a price."""
    path = scratch(spark, "results")
    write_results(grouped(spark, sf_dir, run_id="first", run_time=FIRST_RUN).results, path)
    priced = table(spark, sf_dir, "dirty_orders").filter("price is not null")
    again = validate(priced, Suite("grouped", grouped_rules()), keys=KEYS, run_id="second", run_time=SECOND_RUN)
    write_results(again.results, path)
    return path


PRICED = f"(select * from {ORDERS} o where price is not null) t"
PRICED_SQL = RESULTS_SQL.replace(f"from {ORDERS} t", f"from {PRICED}")
PRICED_LISTED = listed_sql().replace(f"from {ORDERS} t", f"from {PRICED}")


@query("sink_result_json", f"select 'first' as run_id, * from ({RESULTS_SQL}) a")
def sink_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "results")
    write_results(grouped(spark, sf_dir, run_id="first", run_time=FIRST_RUN, result_format="COMPLETE").results, path)
    stored = read_results(spark, path)
    return short(stored, F.col("run_id"))


@query("result_by_run", PRICED_SQL)
def result_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short(read_results(spark, _stored_runs(spark, sf_dir), "second"))


@query("latest_result", PRICED_SQL)
def latest_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short(read_latest(spark, _stored_runs(spark, sf_dir)))


@query(
    "latest_of_results",
    PRICED_SQL,
)
def latest_of_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from results at hand, without the index."""
    return short(latest_results(read_results(spark, _stored_runs(spark, sf_dir))))


@query(
    "run_repeated",
    f"""
select 'kept' as run, 'results' as part, (select count(*) from ({RESULTS_SQL}) r)::bigint as n union all
select 'again', 'results', (select count(*) from ({PRICED_SQL}) r) union all
select 'kept', 'rows', (select count(*) from ({listed_sql()}) v) union all
select 'again', 'rows', (select count(*) from ({PRICED_LISTED}) v) union all
select run, 'index', 1 from (values ('kept'), ('again')) x(run) where (select count(*) from orders) > 0 union all
select 'empty', 'index', 1 where (select count(*) from orders) > 0 union all
select 'empty', 'results', (select count(*) from ({RESULTS_SQL}) r)""",
)
def run_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs are stored; two of them once more, one on fewer rows, one on none: each is there once, as it was last."""
    results, rows = scratch(spark, "results"), scratch(spark, "violations")
    orders = table(spark, sf_dir, "dirty_orders")
    runs = [("kept", "true"), ("again", "true"), ("empty", "true"), ("again", "price is not null"), ("empty", "false")]
    for run, condition in runs:
        run_validation(
            spark,
            lambda session, condition=condition: orders.filter(condition),
            Suite("grouped", grouped_rules()),
            write_results,
            write_rows=write_violations,
            keys=KEYS,
            result_format="COMPLETE",
            run_id=run,
            writer_kwargs={"path": results},
            rows_kwargs={"path": rows, "run_id": run},
        )
    parts = {"results": read_results(spark, results), "rows": read_violations(spark, rows), "index": read_runs(spark, results)}
    counted = [
        df.groupBy(F.col("run_id").alias("run")).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(part))
        for part, df in parts.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("validate_job", config_sql("1996-01-01"))
def validate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a CSV, validate it by a config with parameters, write the results, read them back."""
    source, target = scratch(spark, "orders"), scratch(spark, "results")
    write_csv(table(spark, sf_dir, "dirty_orders").select("o_orderkey", "status", "order_date"), source)
    run_validation(
        spark,
        lambda session, path: read_csv(session, path),
        CONFIG,
        lambda results, path: write_results(results, path),
        params={"since": "1996-01-01"},
        result_format={"result_format": "COMPLETE", "unexpected_index_column_names": KEYS},
        loader_kwargs={"path": source},
        writer_kwargs={"path": target},
        run_id="job",
    )
    return short(read_results(spark, target, "job"))


# -- stored runs with all their offending rows ------------------------------


def _complete_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(results, offending rows) of a complete run, as read back from storage."""
    target, rows = scratch(spark, "results"), scratch(spark, "violations")
    run_validation(
        spark,
        lambda session: table(session, sf_dir, "dirty_orders"),
        Suite("grouped", grouped_rules()),
        write_results,
        write_rows=write_violations,
        keys=KEYS,
        result_format="COMPLETE",
        run_id="complete",
        writer_kwargs={"path": target},
        rows_kwargs={"path": rows},
    )
    return read_results(spark, target, "complete"), read_violations(spark, rows, "complete")


@query("stored_violations", f"select * from ({listed_sql()}) v")
def stored_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _complete_run(spark, sf_dir)[1].drop("run_id")


@query("stored_report", ORACLES["violations_report"])
def stored_report_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, rows = _complete_run(spark, sf_dir)
    return stored_report(results, rows).select("rule", "expectation_type", "column", "value", *KEYS, "pass")
