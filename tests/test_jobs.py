import importlib.util
import json
import os

import pytest
from conftest import ROOT

from assayer import Rule, Suite, run_validation
from assayer.sources import read_results, read_violations, write_csv


def test_validate_csv(spark, tmp_path):
    spec = importlib.util.spec_from_file_location("validate_csv", os.path.join(ROOT, "jobs", "validate_csv.py"))
    job = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(job)

    rows = [(1, "2021-03-17", 0.4), (2, "2021-03-02", 0.6), (3, None, 0.8)]
    rows += [(i, "2020-01-01", 0.5) for i in range(100, 140)]
    write_csv(spark.createDataFrame(rows, "visit int, arrival string, rebate double"), str(tmp_path / "in"))
    config = [
        {
            "expectation_type": "expect_column_values_to_meet_date_condition",
            "kwargs": {"column": "arrival", "date": {"$PARAMETER": "since"}, "operator": ">="},
            "meta": {"Rule": "R0001"},
        },
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "rebate", "min_value": 0.3},
            "meta": {"Rule": "R0002"},
        },
    ]
    (tmp_path / "rules.json").write_text(json.dumps(config))
    common = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--keys", "visit"]
    common += ["--config", str(tmp_path / "rules.json"), "--violations", str(tmp_path / "bad")]
    assert job.main([*common, "--run-id", "a", "--param", "since=2021-03-10"]) is False
    assert job.main([*common, "--run-id", "b", "--param", "since=2019-01-01"]) is True
    stored = read_results(spark, str(tmp_path / "out"), "a").orderBy("position").collect()
    assert [(r.success, r.unexpected_count) for r in stored] == [(False, 41), (True, 0)]
    assert stored[0].partial_unexpected_index_list[0] == {"visit": "2"}
    # Every offending row is stored, not only those of the bounded list.
    bad = read_violations(spark, str(tmp_path / "bad"), "a").collect()
    assert sorted(r.visit for r in bad) == [2, *range(100, 140)]
    assert {(r.value, r.rule) for r in bad if r.visit == 2} == {("2021-03-02", "R0001")}


def test_a_rule_that_fails_on_the_data_fails_alone(spark):
    df = spark.createDataFrame([(1, "3"), (2, "x")], "i int, t string")
    rules = [
        Rule.of("expect_column_values_to_not_be_null", column="t", rule_id="good"),
        Rule.of("expect_column_values_to_not_be_null", column="i", row_condition="10 / (i - 1) > 1", rule_id="bad"),
        Rule.of("expect_column_values_to_be_between", column="i", min_value=2, rule_id="other"),
    ]
    stored, rows = [], []
    run_validation(
        spark,
        lambda session: df,
        Suite("mixed", rules),
        lambda results: stored.extend(results.collect()),
        write_rows=lambda violations: rows.extend(violations.collect()),
        keys=["i"],
        result_format="COMPLETE",
    )
    found = {r.rule_id: (r.success, r.raised_exception) for r in stored}
    assert found == {"good": (True, False), "bad": (False, True), "other": (False, False)}
    assert [(r.rule_id, r.i) for r in rows] == [("other", 1)]
    with pytest.raises(RuntimeError, match="the writer"):
        run_validation(spark, lambda session: df, Suite("good", rules[:1]), _broken)


def _broken(results):
    raise RuntimeError("the writer")


def test_failing_rules_are_found_on_their_split(spark, monkeypatch):
    """40 rules on 32 splits, one of which two rules fail on, another a third; each search costs about one scan."""
    df = spark.range(0, 3200, 1, 32).selectExpr("id", "id % 100 as x")
    bad = {7: "10 / (id - 250) > 1", 23: "1 / (id - 251) >= -1", 31: "10 / (id - 3000) > 1"}
    rules = [
        Rule.of("expect_column_values_to_be_between", column="x", max_value=90, row_condition=bad.get(i, f"id > {i}"), rule_id=f"r{i}")
        for i in range(40)
    ]
    rules.append(Rule.of("expect_column_values_to_be_unique", column="x", row_condition="1 / (id - 249) > 2", rule_id="u"))
    from assayer.plans import validate as module

    tried, raises = [], module._raises
    monkeypatch.setattr(module, "_raises", lambda work, splits: tried.append(len(splits)) or raises(work, splits))
    stored = []
    run_validation(spark, lambda session: df, Suite("many", rules), lambda results: stored.extend(results.collect()), keys=["id"])
    failed = {r.rule_id: r.exception_message for r in stored if r.raised_exception}
    assert set(failed) == {"r7", "r23", "r31", "u"} and all("DIVIDE_BY_ZERO" in m for m in failed.values())
    assert sum(r.unexpected_count is not None for r in stored) == 37
    # Two searches by halves, each a scan less one split, and the halving of rules on single splits.
    assert sum(n for n in tried if n > 1) <= 2 * 32
