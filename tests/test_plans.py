"""The plans that matter at scale: scans, shuffles, pruning, bounded lists."""

import contextlib
import datetime as dt
import io
import itertools
import re
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayer import Rule, validate
from assayer.sources import read_as_of, read_latest, read_results, write_results, write_snapshot

TABLES = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{TABLES}/lineitem.parquet")


def between(column, **kwargs):
    return Rule.of("expect_column_values_to_be_between", column=column, min_value=1, max_value=40, **kwargs)


ROW_RULES = [
    between("l_quantity"),
    between("l_discount"),
    Rule.of("expect_column_values_to_not_be_null", column="l_partkey"),
    Rule.of("expect_column_values_to_match_regex", column="l_returnflag", regex="^[AN]$"),
    Rule.of("expect_column_mean_to_be_between", column="l_tax", max_value=1),
]


def test_row_rules_share_one_scan_and_one_small_exchange(lines):
    text = tree(validate(lines, ROW_RULES).graded)
    assert text.count("Scan parquet") == 1
    assert text.count("Exchange") == 1 and "SinglePartition" in plan(validate(lines, ROW_RULES).graded)
    assert "Python" not in text and "Join" not in text


def test_only_needed_columns_are_read(lines):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan(validate(lines, ROW_RULES).graded)).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "l_discount",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_tax",
    ]


def test_violations_need_no_shuffle_and_no_repeated_flags(lines):
    text = plan(validate(lines, ROW_RULES, keys=["l_orderkey"]).violations)
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "Exchange" not in text
    assert "size(array" not in text  # the optimizer would repeat every flag in this filter


def test_shared_row_condition_reaches_the_scan(lines):
    rules = [between(c, row_condition="l_quantity > 30") for c in ("l_discount", "l_tax")]
    for df in (validate(lines, rules).graded, validate(lines, rules, ["l_orderkey"]).violations):
        assert "GreaterThan(l_quantity,30.0)" in plan(df)


def test_not_null_violations_are_pushed_down(lines):
    rule = Rule.of("expect_column_values_to_not_be_null", column="l_partkey")
    assert "IsNull(l_partkey)" in plan(validate(lines, [rule], ["l_orderkey"]).violations)


def test_range_and_set_violations_are_pushed_down(lines):
    outcome = validate(lines, [between("l_linenumber")], ["l_orderkey"], "COMPLETE")
    pushed = "PushedFilters: [IsNotNull(l_linenumber), Or(LessThan(l_linenumber,1),GreaterThan(l_linenumber,40))]"
    assert pushed in plan(outcome.violations)
    assert pushed in plan(lines.filter(outcome.checks[0].query))
    rule = Rule.of("expect_column_values_to_be_in_set", column="l_linenumber", value_set=[1, 2])
    assert "Not(In(l_linenumber, [1,2]))" in plan(validate(lines, [rule], ["l_orderkey"]).violations)


@pytest.mark.parametrize("length", [20, 2000])
def test_lists_are_one_scan_cut_before_the_shuffle(lines, length):
    options = {"result_format": "COMPLETE", "partial_unexpected_count": length}
    outcome = validate(lines, ROW_RULES, keys=["l_orderkey"], result_format=options)
    text = tree(outcome._partial_lists)
    assert text.count("Scan parquet") == 1 and text.count("MapInArrow") == 1
    # Through the first exchange go the tasks' least rows and counts, through the others the lists themselves.
    assert text.count("Exchange") == 3
    assert tree(outcome.results).count("Scan parquet") == 2


def plain_lists(outcome, length, keys):
    """(first values, first keys, frequent values) of each rule, from all offending rows."""
    rows = outcome._listed.collect()
    found = {}
    for position in {r.position for r in rows}:
        own = [r for r in rows if r.position == position]
        own.sort(key=lambda r: [(r[k] is None, r[k] or 0) for k in keys] + [(r["value"] is None, r["value"] or "")])
        counts = Counter(r["value"] for r in own)
        frequent = sorted(counts.items(), key=lambda c: (-c[1], c[0] is None, c[0] or ""))[:length]
        first = own[:length]
        index = [{k: None if r[k] is None else str(r[k]) for k in keys} for r in first] if keys else None
        found[position] = ([r["value"] for r in first], index, frequent)
    return found


@pytest.mark.parametrize("length", [3, 40])
@pytest.mark.parametrize("keys", [["id"], ["id", "day"], []])
def test_lists_against_all_rows(spark, monkeypatch, length, keys):
    """Repeated rows, missing keys and values, nested columns; values so many that tasks hand their counts on early."""
    monkeypatch.setattr("assayer.plans.lists.HELD", 50)
    df = spark.range(0, 900, 1, 6).selectExpr(
        "if(id % 50 = 7, null, (id * 37) % 900) as id",
        "date_add(DATE'2024-01-01', int(id % 3)) as day",
        "if(id % 11 = 0, null, if(id % 13 = 0, double('nan'), id % 70 / 4)) as x",
        "concat('t', id % 90) as t",
        "array(id % 5) as a",
    )
    df = df.union(df.filter("id < 40")).union(df.filter("id = 3")).repartition(4)
    rules = [
        Rule.of("expect_column_values_to_be_between", column="x", max_value=3),
        Rule.of("expect_column_values_to_not_be_null", column="x"),
        Rule.of("expect_column_values_to_match_regex", column="t", regex="^t1"),
        Rule.of("expect_column_pair_values_to_be_equal", column_A="x", column_B="id", ignore_row_if="neither"),
        Rule.of("expect_column_values_to_be_in_set", column="day", value_set=["2024-01-01"]),
        Rule.of("expect_column_values_to_be_unique", column="t"),
        Rule.of("expect_column_values_to_be_unique", column="a", row_condition="id > 880"),
        Rule.of("expect_column_values_to_be_increasing", column="x", order_by="id"),
    ]
    options = {"result_format": "COMPLETE", "partial_unexpected_count": length}
    outcome = validate(df, rules, keys=keys, result_format=options)
    want = plain_lists(outcome, length, keys)
    for r in outcome.results.collect():
        first, index, frequent = want.get(r.position, ([], [], []))
        index = index or []
        assert [tuple(c) for c in r.partial_unexpected_counts] == frequent
        assert r.partial_unexpected_index_list == index
        if keys:  # rows with equal keys come in an order of their own
            by_key = [sorted(map(str, g)) for g in grouped_by(zip(map(str, index), r.partial_unexpected_list))]
            assert by_key == [sorted(map(str, g)) for g in grouped_by(zip(map(str, index), first))] or len(first) == length
        else:
            assert r.partial_unexpected_list == first


def grouped_by(pairs):
    return [[v for _, v in g] for _, g in itertools.groupby(pairs, key=lambda p: p[0])]


def test_uniqueness_combines_before_the_shuffle(lines):
    text = tree(validate(lines, [Rule.of("expect_column_values_to_be_unique", column="l_orderkey")]).counts)
    assert text.count("Scan parquet") == 1
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate", text)


UNIQUE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
UNIQUES = [Rule.of("expect_column_values_to_be_unique", column=c) for c in UNIQUE_COLUMNS] + [
    Rule.of("expect_column_values_to_be_unique", column=c, row_condition="l_linenumber = 1") for c in UNIQUE_COLUMNS[:3]
]


def test_many_uniqueness_rules_share_scans_and_exchanges(lines):
    outcome = validate(lines, UNIQUES, keys=["l_orderkey", "l_linenumber"])
    text = tree(outcome.counts)
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") <= 2 or text.count("Exchange") == 3
    assert final_scans(outcome.violations) <= 2


def test_values_without_order_fail_their_rule_alone(spark):
    df = spark.range(3).selectExpr("id", "map('a', id) as m", "array(id) as a", "named_struct('x', id) as s")
    rules = [Rule.of("expect_column_values_to_be_unique", column=c) for c in ("m", "a", "s", "id")]
    found = validate(df, rules, keys=["id"]).results.orderBy("position").collect()
    assert [r.raised_exception for r in found] == [True, False, False, False]
    assert [r.success for r in found] == [False, True, True, True]


def test_order_rule_is_one_exchange_into_ranges(spark):
    events = spark.read.parquet(f"{TABLES}/events.parquet")
    rule = Rule.of("expect_column_values_to_be_increasing", column="value", order_by="event_id")
    rows = validate(events, [rule], keys=["event_id"])._listed
    text = plan(rows)
    assert text.count("Arguments: rangepartitioning(") == 1
    # The other exchange gets the rows that fall, and one row for each range.
    assert tree(rows).count("Exchange") == 2 and tree(rows).count("Scan parquet") == 1


def test_validate_starts_no_job_and_changes_no_setting(spark, lines):
    context, limit = spark.sparkContext, "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(limit)
    context.setJobGroup("compile", "compile")
    rules = [*ROW_RULES, *UNIQUES, Rule.of("expect_column_values_to_be_increasing", column="l_tax", order_by="l_orderkey")]
    options = {"result_format": "COMPLETE", "partial_unexpected_count": 2000}
    outcome = validate(lines, rules, keys=["l_orderkey"], result_format=options)
    outcome.results, outcome.violations, outcome.report()  # noqa: B018
    assert not context.statusTracker().getJobIdsForGroup("compile")
    assert spark.conf.get(limit) == before
    context.setLocalProperty("spark.jobGroup.id", None)


def many_rules(n):
    names = ("l_tax", "l_quantity", "l_discount", "l_linenumber", "l_extendedprice")
    rules = [
        Rule.of(
            "expect_column_values_to_be_between",
            column=names[i % 5],
            min_value=i / 50,
            max_value=1000 * i,
            row_condition="l_quantity > 30" if i % 3 == 0 else None,
            rule_id=f"r{i}",
        )
        for i in range(n)
    ]
    return [*rules, Rule.of("expect_column_mean_to_be_between", column="l_tax", min_value=0, max_value=0.01)]


def test_any_number_of_rules_is_one_scan(lines):
    outcome = validate(lines, many_rules(200), keys=["l_orderkey"])
    assert tree(outcome.graded).count("Scan parquet") == 1
    assert tree(outcome.violations).count("Scan parquet") == 1


@pytest.mark.parametrize("empty", [False, True])
def test_many_rules_count_as_few_do(lines, monkeypatch, empty):
    lines = lines.limit(0) if empty else lines
    columns = ["position", "element_count", "missing_count", "unexpected_count", "listed_count", "passed"]

    def counts():
        outcome = validate(lines, many_rules(45))
        rows = outcome.counts.select(*columns).collect()
        return sorted(map(tuple, rows)), outcome.graded.filter("position = 45").first().observed_value

    many = counts()
    monkeypatch.setattr("assayer.plans.validate.AGGREGATES", 1000)
    few = counts()
    assert many[0] == few[0] and many[1] == (few[1] if empty else pytest.approx(few[1]))


def final_scans(df) -> int:
    """Scans that really run, once adaptive execution has reused what is the same."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan")


def test_report_and_repeated_rows_scan_twice(lines):
    assert final_scans(validate(lines, ROW_RULES, keys=["l_orderkey"]).report()) == 2
    rule = Rule.of("expect_column_values_to_be_unique", column="l_partkey")
    assert final_scans(validate(lines, [rule], keys=["l_orderkey"]).violations) <= 2


def test_snapshots_and_runs_are_partition_filters(spark, lines, tmp_path):
    path = str(tmp_path / "lines")
    for snapshot in (1, 2):
        write_snapshot(lines.limit(10), path, snapshot)
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan(read_as_of(spark, path, 1))
    outcome = validate(lines, ROW_RULES, run_id="r1")
    write_results(outcome.results, str(tmp_path / "results"))
    assert "PartitionFilters: [isnotnull(run_id" in plan(read_results(spark, str(tmp_path / "results"), "r1"))


def test_the_latest_run_is_read_alone(spark, lines, tmp_path):
    path = str(tmp_path / "results")
    made = validate(lines, ROW_RULES[:2], run_id="r0", run_time=dt.datetime(2024, 1, 1)).results
    write_results(made, path)
    for i in range(1, 100):  # as that many runs would have left them, but their results cannot be read
        shutil.copytree(tmp_path / "results" / "_runs" / "run_id=r0", tmp_path / "results" / "_runs" / f"run_id=r{i}")
        folder = tmp_path / "results" / f"run_id=r{i}"
        folder.mkdir()
        (folder / "part-0.json.gz").write_bytes(b"not compressed")
    write_results(made.withColumn("run_id", F.lit("last")).withColumn("run_time", F.lit(dt.datetime(2024, 1, 2))), path)
    latest = read_latest(spark, path)
    assert re.search(r"PartitionFilters: \[.*run_id.* = last", plan(latest))
    assert {(r.run_id, r.position) for r in latest.collect()} == {("last", 0), ("last", 1)}
    with pytest.raises(Exception, match="not in gzip|incorrect header|FAILED_READ_FILE"):
        read_results(spark, path).collect()
