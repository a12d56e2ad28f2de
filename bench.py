"""Headline timings; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS``
the local cores.  Each query runs once to warm up and then twice; the
lower counts.  Results are written to the ``noop`` sink, so all rows are made.
The suite of 25 rules runs from one scan (``suite_25_fused``) and, as the yardstick
``jobs`` counts the jobs of both.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from assayer import Rule, Suite, validate  # noqa: E402
from checks import suites  # noqa: E402
from checks.tables import table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def suite_25() -> Suite:
    """25 rules on lineitem, of every row-wise family and the column statistics."""

    def rule(name: str, **kwargs) -> Rule:
        return Rule.of(f"expect_{name}", **kwargs)

    net = dict(column_list=["l_extendedprice", "l_discount", "net_price"])
    dates = dict(column_A="receipt_date", column_B="ship_date")
    counts = dict(column_A="quantity", column_B="counted")
    fills = ("quantity", "discount", "ship_date", "receipt_date", "net_price", "counted")
    return Suite(
        "lines",
        [
            *[rule("column_values_to_not_be_null", column=c, mostly=0.9) for c in fills],
            rule("column_values_to_be_between", column="quantity", min_value=1, max_value=50),
            rule("column_values_to_be_between", column="discount", min_value=0.02),
            rule("column_values_to_be_between", column="l_extendedprice", min_value=1000),
            rule("column_values_to_be_in_set", column="l_linenumber", value_set=list(range(1, 8))),
            rule("column_values_to_not_be_in_set", column="counted", value_set=["none", "many"]),
            rule("column_values_to_match_regex", column="counted", regex=r"^[0-9]+\.0$"),
            rule("column_values_to_match_strftime_format", column="ship_date", strftime_format="%Y-%m-%d"),
            rule("column_values_to_match_date_format", column="ship_date"),
            rule("column_values_to_meet_date_condition", column="ship_date", date="1996-01-01", operator=">="),
            rule("column_values_to_meet_date_condition_v1", column="receipt_date", date="1996-01-01", operator=">="),
            rule("column_values_to_be_specific_day", column="ship_date", day_of_week=1),
            rule("column_values_to_be_specific_day", column="receipt_date", day_of_month=-1),
            rule("column_pair_days_diff_to_meet_condition", operator=">=", days=0, **dates),
            rule("column_pair_values_to_meet_compare_condition", operator=">=", **counts),
            rule("column_pair_values_to_be_equal", **counts),
            rule("columns_arithmetic_to_equals_result_column", expr="{0}*(1-{1})", **net),
            rule("multicolumn_sum_to_equal", column_list=["quantity", "discount", "l_linenumber"], value=30),
            rule("column_mean_to_be_between", column="quantity", min_value=10, max_value=40),
            rule("table_row_count_to_be_between", min_value=1),
        ],
    )


def lines(spark: SparkSession) -> DataFrame:
    return table(spark, SF_DIR, "dirty_lines")


def fused(spark: SparkSession) -> None:
    noop(validate(lines(spark), suite_25()).graded)


def one_by_one(spark: SparkSession) -> None:
    for rule in suite_25():
        noop(validate(lines(spark), Suite("one", [rule])).graded)


def violations(spark: SparkSession) -> None:
    noop(validate(lines(spark), suite_25(), keys=["l_orderkey", "l_linenumber"]).violations)


def complete(spark: SparkSession) -> None:
    noop(validate(lines(spark), suite_25(), keys=["l_orderkey", "l_linenumber"], result_format="COMPLETE").results)


def unique(spark: SparkSession) -> None:
    rule = Rule.of("expect_column_values_to_be_unique", column="l_orderkey")
    noop(validate(lines(spark), [rule]).graded)


def unique_rows(spark: SparkSession) -> None:
    rule = Rule.of("expect_column_values_to_be_unique", column="l_orderkey")
    noop(validate(lines(spark), [rule], keys=["l_orderkey", "l_linenumber"]).violations)


def increasing(spark: SparkSession) -> None:
    rule = Rule.of("expect_column_values_to_be_increasing", column="value", order_by="event_id")
    noop(validate(table(spark, SF_DIR, "dirty_events"), [rule]).graded)


def report(spark: SparkSession) -> None:
    noop(suites.grouped(spark, SF_DIR).report())


def stored_runs(spark: SparkSession) -> None:
    noop(suites.latest_result(spark, SF_DIR))


def snapshots(spark: SparkSession) -> None:
    from checks import storage

    noop(storage.snap_previous(spark, SF_DIR))


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


HEADLINES = {
    "suite_25_fused": fused,
    "suite_25_violations": violations,
    "suite_25_complete": complete,
    "unique_counts": unique,
    "unique_rows": unique_rows,
    "increasing": increasing,
    "violations_report": report,
    "results_write_read": stored_runs,
    "snapshots_append_as_of": snapshots,
}


def timed(spark: SparkSession, run, runs: int = RUNS) -> float:
    run(spark)
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run(spark)
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def jobs_of(spark: SparkSession, run, group: str) -> int:
    context = spark.sparkContext
    context.setJobGroup(group, group)
    run(spark)
    jobs = len(context.statusTracker().getJobIdsForGroup(group))
    context.setLocalProperty("spark.jobGroup.id", None)
    return jobs


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.codegen.maxFields", "400")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: timed(spark, run) for name, run in HEADLINES.items()}
    yardstick = timed(spark, one_by_one, runs=1)
    line = {
        "metric": "total of headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "suite_25_one_by_one": yardstick,
        "jobs": {
            "suite_25_fused": jobs_of(spark, fused, "fused"),
            "suite_25_one_by_one": jobs_of(spark, one_by_one, "single"),
        },
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
