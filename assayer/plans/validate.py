"""Run a suite over a table.

All rules that judge single rows share one aggregation, so they cost one scan
and exchange one row per task.  Rules that need a shuffle of their own (repeated
values, order) are separate branches of the same plan.  Offending rows come from
a second plan, again one scan for all row rules, and are never collected.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.conditions import as_date, as_double
from ..functions.sqltext import Predicate, as_column, both, ident, literal, quote
from ..operators.duplicates import Unique, duplicate_counts, duplicate_rows
from ..operators.ordering import falling_rows
from ..operators.registry import FRACTION, LIST, PERCENT_ROUNDED, Rule
from .compile import Check, compile_suite, failed
from .lists import COUNT, FLAGS, POSITION, TIE, bounded, condensed, is_atomic
from .suite import Suite

Rewrite = Callable[[Predicate | None], Predicate | None]

LEVELS = ("BASIC", "SUMMARY", "COMPLETE")

FUSED_SCOPES = ("column", "pair", "multi", "aggregate", "order")

# Rules that are counted by an aggregate each.  Above this the code generated for
# so many aggregates outgrows what the JVM compiles, and rows tell by numbers which
# conditions they meet; either way the table is scanned once.
AGGREGATES = 40

# A number that a hash of a row's values has as good as never.
CERTAIN_HASH = 2**62 + 12345

# Helpers between two steps of the plan of offending rows.
PLACE, SHOWN = POSITION, "__value"
GOOD = -1

PARTIAL_ROWS = 20

COUNT_TYPES = {
    "element_count": "bigint",
    "missing_count": "bigint",
    "unexpected_count": "bigint",
    "listed_count": "bigint",
    "observed_value": "double",
    "passed": "boolean",
}

ABOUT_SCHEMA = (
    "array<struct<rule_id:string,rule:string,expectation_type:string,column:string,column_list:array<string>,"
    "kwargs:map<string,string>,meta:map<string,string>,mostly:double,percent:string,level:int,"
    "unexpected_index_query:string,exception_message:string,exception_traceback:string>>"
)

RESULT_COLUMNS = [
    "run_id",
    "suite",
    "position",
    "rule_id",
    "expectation_type",
    "column_list",
    "kwargs",
    "meta",
    "success",
    "element_count",
    "missing_count",
    "missing_percent",
    "unexpected_count",
    "unexpected_percent",
    "unexpected_percent_total",
    "unexpected_percent_nonmissing",
    "observed_value",
    "partial_unexpected_list",
    "partial_unexpected_index_list",
    "partial_unexpected_counts",
    "unexpected_index_query",
    "raised_exception",
    "exception_message",
    "exception_traceback",
    "run_time",
]

# The bounded lists of a result, their types, and the least level that fills them.
LISTS = [
    ("partial_unexpected_list", "array<string>", 0),
    ("partial_unexpected_index_list", "array<map<string,string>>", 1),
    ("partial_unexpected_counts", "array<struct<value:string,count:bigint>>", 1),
]

WORKING_COLUMNS = ["about", "clean", "hash", "is_hot", "pass", "position", "rank", "salt"]
VIOLATION_COLUMNS = ["run_id", "rule_id", "rule", "expectation_type", "column", "value"]


def validate(
    df: DataFrame,
    suite: Suite | list[Rule],
    keys: list[str] | None = None,
    result_format: str | Mapping | None = None,
    run_id: str | None = None,
    run_time: dt.datetime | None = None,
    strict: bool = False,
) -> "Validation":
    """Check a table against a suite; nothing runs until a result is read.

    ``keys`` name the columns that identify a row in the lists of offending
    rows.  ``result_format`` is BASIC, SUMMARY or COMPLETE, or a mapping with
    ``result_format``, ``unexpected_index_column_names`` (the keys),
    ``return_unexpected_index_query`` and ``partial_unexpected_count``.
    With ``strict`` a rule that cannot be compiled raises instead of failing.
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"only Spark DataFrames can be validated, not {type(df).__name__}")
    options = dict(result_format) if isinstance(result_format, Mapping) else {"result_format": result_format}
    keys = list(keys or options.get("unexpected_index_column_names") or [])
    reserved = {*VIOLATION_COLUMNS, *WORKING_COLUMNS} & set(keys)
    if reserved:
        raise ValueError(f"key columns {sorted(reserved)} clash with result columns; rename them first")
    if not isinstance(suite, Suite):
        suite = Suite("default", suite)
    now = run_time or dt.datetime.now(dt.timezone.utc)
    return Validation(
        df=df,
        suite=suite,
        checks=compile_suite(df, list(suite), now, keys, strict),
        keys=keys,
        level=_level(options.get("result_format")),
        partial_rows=int(options.get("partial_unexpected_count", PARTIAL_ROWS)),
        with_query=bool(options.get("return_unexpected_index_query", True)),
        run_id=run_id or now.strftime("%Y%m%d%H%M%S"),
        run_time=now,
    )


def _level(name) -> int:
    if isinstance(name, Mapping):
        name = name.get("result_format")
    name = name or "BASIC"
    if name not in LEVELS:
        raise ValueError(f"result_format {name!r} is not one of {', '.join(LEVELS)}")
    return LEVELS.index(name)


@dataclass(frozen=True)
class Validation:
    """A suite bound to a table; every result is a lazy DataFrame."""

    df: DataFrame
    suite: Suite
    checks: list[Check]
    keys: list[str]
    level: int
    partial_rows: int
    with_query: bool
    run_id: str
    run_time: dt.datetime

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    @property
    def complete(self) -> bool:
        """Whether a rule is to be reported with all its offending rows."""
        levels = [_level(c.kwargs["result_format"]) for c in self.checks if c.kwargs.get("result_format")]
        return max([self.level, *levels]) == LEVELS.index("COMPLETE")

    def failing(self) -> dict[int, Exception]:
        """Rules, by position, that raise when they run.

        What rows do is tried first, on splits of the input: the first half of
        them, then half of the half that fails, until one split is left, which
        costs one scan in all.  On that split the rules are halved until each
        that raises is known; others may raise on other splits.  Rules that
        fail elsewhere, in tables of their own, are halved on the whole table.
        """
        found: dict[int, Exception] = {}
        by_rows = {c.position: p for c in self.checks if (p := self._row_work(c)) is not None}
        if by_rows:
            work = self._row_rdd(list(by_rows.values()))
            splits = list(range(work.getNumPartitions()))
            while len(splits) > 1:
                half = splits[: len(splits) // 2]
                splits = half if _raises(work, half) else splits[len(splits) // 2 :]

            def search_split(positions: list[int]) -> None:
                error = _raises(self._row_rdd([by_rows[p] for p in positions]), splits)
                if error is not None and len(positions) == 1:
                    found[positions[0]] = error
                elif error is not None:
                    search_split(positions[: len(positions) // 2])
                    search_split(positions[len(positions) // 2 :])

            search_split(list(by_rows))
        if found:
            return found

        def search(checks: list[Check]) -> None:
            part = replace(self, checks=checks)
            try:
                part.graded.write.format("noop").mode("overwrite").save()
                part.violations.write.format("noop").mode("overwrite").save()
            except Exception as error:  # noqa: BLE001 - whatever it is, it goes to the rule's result
                if len(checks) == 1:
                    found[checks[0].position] = error
                else:
                    search(checks[: len(checks) // 2])
                    search(checks[len(checks) // 2 :])

        search(self.checks)
        return found

    def _row_work(self, check: Check) -> list[Column] | None:
        """What a rule works out for each row; None if that is not all it does, or nothing."""
        if check.judges_rows:
            listed = as_column(check.listed)
            return [as_column(check.counted), listed, F.when(listed, F.expr(check.value))]
        if check.scope in ("duplicates", "order", "aggregate"):
            domain = F.lit(True) if check.domain is None else as_column(check.domain)
            return [domain, *[F.when(domain, f.col.cast("string")) for f in check.fields]]
        return None

    def _row_rdd(self, work: list[list[Column]]) -> RDD:
        """The rows, with all of the work done for each; no row comes out but one whose work has one certain hash."""
        return self.df.filter(F.xxhash64(*[c for columns in work for c in columns]) == CERTAIN_HASH).rdd

    def without(self, failing: Mapping[int, Exception]) -> "Validation":
        """The same validation, with some rules failed by what they raised."""
        checks = [failed(c.position, c.rule, failing[c.position]) if c.position in failing else c for c in self.checks]
        return replace(self, checks=checks)

    # -- counts ------------------------------------------------------------

    @cached_property
    def counts(self) -> DataFrame:
        """One row per rule: ``position`` and the columns of COUNT_TYPES."""
        fused = self._of_scope(*FUSED_SCOPES)
        parts = [self._numbered_counts(fused) if len(fused) > AGGREGATES else self._fused_counts(fused)] if fused else []
        if self._of_scope("schema", "failed") or not parts:
            parts.append(self._settled_counts())
        if unique := self._of_scope("duplicates"):
            counted = duplicate_counts(self._base(unique), _uniques(unique))
            parts.append(_count_row(counted, listed_count=F.col("unexpected_count")))
        for check in self._of_scope("order"):
            fallen = self._fallen(check, keys=[]).agg(F.count(F.lit(1)).alias("unexpected_count"))
            parts.append(_count_row(fallen.withColumn("position", F.lit(check.position)), listed_count=F.col("unexpected_count")))
        for check in self._of_scope("table"):
            made = check.kind.condition(self._within(check), **_table_arguments(check))
            parts.append(_count_row(made.withColumn("position", F.lit(check.position)), passed=F.col("success")))
        counts = reduce(DataFrame.unionByName, parts)
        if self._of_scope("order"):
            # The fused aggregation gave the rows and missing values, the branch the falls.
            counts = counts.groupBy("position").agg(
                *[F.sum(c).alias(c) for c in ("element_count", "missing_count", "unexpected_count", "listed_count")],
                F.max("observed_value").alias("observed_value"),
                F.every("passed").alias("passed"),
            )
        return counts

    def _of_scope(self, *scopes: str) -> list[Check]:
        return [c for c in self.checks if c.scope in scopes]

    def _within(self, check: Check) -> DataFrame:
        return self.df if check.domain is None else self.df.filter(as_column(check.domain))

    def _base(self, checks: list[Check]) -> DataFrame:
        """The table, filtered at the scan if all these rules share one row condition."""
        conditions = {c.row_condition if isinstance(c.row_condition, str) else None for c in checks}
        if len(conditions) == 1 and None not in conditions:
            return self.df.filter(conditions.pop())
        return self.df

    def _with_parsed(self, base: DataFrame, checks: list[Check]) -> tuple[DataFrame, Rewrite]:
        """Add the dates and numbers that several predicates parse from the same text.

        Spark would parse them again in each rule: once a comparison has moved
        into the branches of the parsing CASE, the rules have little in common.
        """
        predicates = [p for c in checks if c.judges_rows for p in (c.counted, c.listed) if isinstance(p, str)]
        parsed: dict[str, str] = {}
        for field in {f for c in checks for f in c.fields if f.is_text}:
            for text in (as_date(field), as_double(field)):
                if sum(p.count(text) for p in predicates) > 1:
                    name = f"__parsed_{len(parsed)}"
                    while name in base.columns:
                        name = f"_{name}"
                    parsed[text] = name

        def rewrite(predicate: Predicate | None) -> Predicate | None:
            if isinstance(predicate, str):
                for text, name in parsed.items():
                    predicate = predicate.replace(text, name)
            return predicate

        if parsed:
            base = base.withColumns({name: F.expr(text) for text, name in parsed.items()})
        return base, rewrite

    def _settled_counts(self) -> DataFrame:
        """Rules decided by the schema alone, or not at all."""
        rows = []
        for check in self._of_scope("schema", "failed"):
            passed, seen = check.decided or (False, None)
            rows.append(_count_struct(check, {"passed": literal(passed), "observed_value": literal(seen)}))
        if not rows:
            columns = [f"CAST(NULL AS {kind}) AS {name}" for name, kind in COUNT_TYPES.items()]
            return self.spark.range(0).selectExpr("CAST(id AS INT) AS position", *columns)
        return self.spark.range(1).select(F.expr(f"inline(array({', '.join(rows)}))"))

    def _fused_counts(self, fused: list[Check]) -> DataFrame:
        """All given rules by one aggregation; equal counts are made once."""
        base, rewrite = self._with_parsed(self._base(fused), fused)
        names: dict[str, str] = {}
        aggregates: list[Column] = []

        def made(total: Column, key: str) -> str:
            """The name of an aggregate; equal ones are made once."""
            if key not in names:
                names[key] = f"n{len(names)}"
                aggregates.append(total.alias(names[key]))
            return names[key]

        def count(predicate: Predicate | None, check: Check) -> str:
            predicate = rewrite(predicate)
            if predicate is None:
                return made(F.count(F.lit(1)), "count(1)")
            if isinstance(predicate, str):
                return made(F.expr(f"count_if({predicate})"), predicate)
            return made(F.count_if(predicate), f"rule at {check.position}")

        rows = self._count_structs(fused, count, made)
        return base.agg(*aggregates).select(F.expr(f"inline(array({', '.join(rows)}))"))

    def _numbered_counts(self, fused: list[Check]) -> DataFrame:
        """The same for many rules: each row gives the numbers of the conditions it meets, and these are counted.

        Most conditions are about rows that are not as they should be, so few
        rows give more than one number, and what is shuffled is one count for
        each number and task.  Statistics, of which there are few kinds, stay
        aggregates, over the same scan's rows.
        """
        base, rewrite = self._with_parsed(self._base(fused), fused)
        numbers: dict[str, int] = {"true": 0}
        conditions: list[Column] = [F.lit(0)]
        seen: dict[str, Column] = {}

        def made(total: Column, key: str) -> str:
            seen.setdefault(key, total)
            return f"s{list(seen).index(key)}"

        def count(predicate: Predicate | None, check: Check) -> str:
            predicate = rewrite(predicate)
            key = "true" if predicate is None else predicate if isinstance(predicate, str) else f"rule {check.position}"
            if key not in numbers:
                numbers[key] = len(numbers)
                conditions.append(F.when(as_column(predicate), numbers[key]).otherwise(GOOD))
            return f"coalesce(met[{numbers[key]}], 0L)"

        rows = self._count_structs(fused, count, made)
        statistics = [total.alias(f"s{i}") for i, total in enumerate(seen.values())]
        if statistics:
            # The numbers and the statistics come from one scan: the statistics are worked out per number, for
            # the number that every row gives.
            kept = base.withColumn(FLAGS, F.array(*conditions))
            numbered = kept.select("*", F.expr(f"explode(array_remove({FLAGS}, {GOOD}))").alias(PLACE))
            grouped = numbered.groupBy(PLACE).agg(F.count(F.lit(1)).alias("n"), *statistics)
        else:
            numbered = base.select(F.explode(F.array_remove(F.array(*conditions), GOOD)).alias(PLACE))
            grouped = numbered.groupBy(PLACE).agg(F.count(F.lit(1)).alias("n"))
        first = [F.max(F.when(F.col(PLACE) == 0, F.col(f"s{i}"))).alias(f"s{i}") for i in range(len(statistics))]
        met = F.map_from_entries(F.collect_list(F.struct(PLACE, "n"))).alias("met")
        return grouped.agg(met, *first).select(F.expr(f"inline(array({', '.join(rows)}))"))

    def _count_structs(self, fused: list[Check], count: Callable, made: Callable) -> list[str]:
        """A struct of counts for each rule, as SQL over what ``count`` and ``made`` name."""
        rows = []
        for check in fused:
            values: dict[str, str] = {}
            if check.scope == "aggregate":
                text = check.kind.condition(check.fields[0] if check.fields else None, check.domain)
                seen = made(F.expr(text), text)
                low, high = check.arguments["min_value"], check.arguments["max_value"]
                bounds = [f"{seen} IS NOT NULL"]
                bounds += [f"{seen} >= {literal(low)}"] if low is not None else []
                bounds += [f"{seen} <= {literal(high)}"] if high is not None else []
                values = {"observed_value": seen, "passed": " AND ".join(bounds)}
            else:
                values["element_count"] = count(check.domain, check)
                if check.missing is not None:
                    values["missing_count"] = count(both(check.domain, check.missing), check)
                if check.judges_rows:
                    bad = count(check.counted, check)
                    values["unexpected_count"] = bad
                    values["listed_count"] = bad if check.kind.nulls != LIST else count(check.listed, check)
                    if check.kind.observe_ratio:
                        values["observed_value"] = f"1 - {bad} / nullif({values['element_count']}, 0)"
            rows.append(_count_struct(check, values))
        return rows

    # -- graded results ----------------------------------------------------

    @cached_property
    def _about(self) -> Column:
        """What is known of each rule before any row is read, as one literal."""
        # A place for each position; some have no check while failing rules are searched for.
        items = [{}] * (1 + max((c.position for c in self.checks), default=-1))
        for check in self.checks:
            level = _level(check.kwargs["result_format"]) if check.kwargs.get("result_format") else self.level
            items[check.position] = {
                "rule_id": check.rule.rule_id,
                "rule": check.group,
                "expectation_type": check.rule.expectation_type,
                "column": check.column_label,
                "column_list": list(check.rule.columns),
                "kwargs": _texts(check.rule.kwargs),
                "meta": _texts(check.rule.meta),
                "mostly": check.mostly if check.error is None else 1.0,
                "percent": check.kind.percent if check.kind else "percent",
                "level": level,
                "unexpected_index_query": check.query if self.with_query else None,
                "exception_message": check.error,
                "exception_traceback": check.trace,
            }
        listing = F.from_json(F.lit(json.dumps(items, ensure_ascii=False)), ABOUT_SCHEMA)
        return F.element_at(listing, F.col("position") + 1)

    @cached_property
    def graded(self) -> DataFrame:
        """The counts with percentages and success; one row per rule, no lists."""
        judged = "nullif(element_count - coalesce(missing_count, 0L), 0L)"
        every = "nullif(element_count, 0L)"
        good = f"(CASE WHEN {judged} IS NULL THEN true ELSE ({judged} - unexpected_count) / {judged} >= about.mostly END)"
        percent = f"100 * unexpected_count / {judged}"
        return (
            self.counts.withColumn("about", self._about)
            .withColumn("success", F.expr(f"coalesce(passed, {good})"))
            .selectExpr(
                "position",
                "about.*",
                "success",
                "element_count",
                "missing_count",
                f"100 * missing_count / {every} AS missing_percent",
                "unexpected_count",
                f"CASE about.percent WHEN '{FRACTION}' THEN round(unexpected_count / {judged}, 4)"
                f" WHEN '{PERCENT_ROUNDED}' THEN round(100 * (unexpected_count / {judged}), 1)"
                f" ELSE {percent} END AS unexpected_percent",
                f"100 * unexpected_count / {every} AS unexpected_percent_total",
                f"{percent} AS unexpected_percent_nonmissing",
                "observed_value",
                "coalesce(listed_count = 0, success) AS clean",
            )
        )

    @cached_property
    def results(self) -> DataFrame:
        """One row per rule, with the bounded lists the result format asks for."""
        graded = self.graded
        listed = self.partial_rows > 0 and bool(self._listing_checks)
        if listed:
            graded = graded.join(self._partial_lists, "position", "left")

        def bounded_list(name: str, kind: str, least: int) -> str:
            """The list, empty if nothing is in it, for a rule that lists rows and asks for that detail."""
            if not listed:
                return f"CAST(NULL AS {kind}) AS {name}"
            asked = f"exception_message IS NULL AND unexpected_count IS NOT NULL AND level >= {least}"
            return f"CASE WHEN {asked} THEN coalesce({name}, CAST(array() AS {kind})) END AS {name}"

        return graded.select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.suite.name).alias("suite"),
            *RESULT_COLUMNS[2:17],
            *[F.expr(bounded_list(*column)) for column in LISTS],
            F.expr("if(level >= 2, unexpected_index_query, NULL) AS unexpected_index_query"),
            F.expr("exception_message IS NOT NULL AS raised_exception"),
            "exception_message",
            "exception_traceback",
            F.lit(self.run_time).alias("run_time"),
        )

    @cached_property
    def stats(self) -> DataFrame:
        """One row: how many rules ran, passed and failed."""
        return suite_statistics(self.graded)

    @cached_property
    def rule_pass(self) -> DataFrame:
        """One row per business rule (``meta["Rule"]``): true if none of its checks lists a row."""
        return self.graded.groupBy("rule").agg(F.every("clean").alias("passed"))

    # -- offending rows ----------------------------------------------------

    @property
    def _listing_checks(self) -> list[Check]:
        return [c for c in self.checks if c.judges_rows or c.scope in ("duplicates", "order")]

    def _fallen(self, check: Check, keys: list[str]) -> DataFrame:
        field = check.fields[0]
        return falling_rows(self._within(check), field.col, F.expr(field.missing), check.kwargs["order_by"], keys)

    @cached_property
    def _listed(self) -> DataFrame:
        """``position``, ``value`` and the keys of every listed row."""
        return self._listed_by(self._listing_checks)

    def _listed_by(self, checks: list[Check]) -> DataFrame:
        quoted = [F.col(ident(k)).alias(k) for k in self.keys]
        parts = []
        if fused := [c for c in checks if c.judges_rows]:
            hit = self._fused_rows(fused)
            parts.append(hit.select(F.col(PLACE).alias("position"), F.col(SHOWN).alias("value"), *quoted))
        if unique := [c for c in checks if c.scope == "duplicates"]:
            hit = duplicate_rows(self._base(unique), _uniques(unique), self.keys)
            parts.append(hit.select("position", "value", *[ident(k) for k in self.keys]))
        for check in (c for c in checks if c.scope == "order"):
            parts.append(_placed(self._fallen(check, self.keys), check))
        if not parts:
            empty = self.df.select(F.lit(0).alias("position"), F.lit("").alias("value"), *quoted)
            return empty.filter("false")
        return reduce(DataFrame.unionByName, parts)

    def _fused_rows(self, fused: list[Check]) -> DataFrame:
        """The table's columns with a rule's position and shown value, once per rule that lists the row."""
        base = self._base(fused)
        if len(fused) == 1:
            # A plain filter, which can reach the scan.
            check = fused[0]
            hit = base.filter(as_column(check.listed))
            return hit.select("*", F.lit(check.position).alias(PLACE), F.expr(check.value).alias(SHOWN))
        # One projection works out the flags of all rules, so that Spark shares
        # what they have in common.  Dropping the good ones before exploding keeps
        # rows few, and keeps the optimizer from repeating the flags in a filter.
        base, rewrite = self._with_parsed(base, fused)
        flags = [_flag(rewrite(c.listed), c.position) for c in fused]
        bad = F.expr(f"explode(array_remove({FLAGS}, {GOOD}))").alias(PLACE)
        hit = base.withColumn(FLAGS, F.array(*flags)).select("*", bad)
        shown = " ".join(f"WHEN {c.position} THEN {c.value}" for c in fused)
        return hit.withColumn(SHOWN, F.expr(f"CASE {PLACE} {shown} END"))

    @cached_property
    def violations(self) -> DataFrame:
        """One row per offending value, with the typed key columns."""
        about = self._listed.withColumn("about", self._about)
        return about.select(*self._violation_head(), "value", *[ident(k) for k in self.keys])

    def _violation_head(self) -> list[Column]:
        names = ["rule_id", "rule", "expectation_type", "column"]
        return [F.lit(self.run_id).alias("run_id"), *[F.col(f"about.{n}").alias(n) for n in names]]

    @cached_property
    def unexpected_counts(self) -> DataFrame:
        """How often each offending value occurs, per rule."""
        counted = self._listed.groupBy("position", "value").agg(F.count(F.lit(1)).alias("count"))
        return counted.withColumn("about", self._about).select(*self._violation_head(), "value", "count")

    @cached_property
    def _partial_lists(self) -> DataFrame:
        """The first rows of each rule by key, and its most frequent values; one scan for all rules that judge rows."""
        levels = [_level(c.kwargs["result_format"]) for c in self.checks if c.kwargs.get("result_format")]
        counting = max([self.level, *levels]) >= 1 or not self.keys
        direct = [c for c in self.checks if c.judges_rows and all(is_atomic(f.dtype) for f in c.fields)]
        others = [c for c in self._listing_checks if c.position not in {d.position for d in direct}]
        parts = []
        if direct:
            columns = {c.position: [f.name for f in c.fields] for c in direct}
            found = condensed(self._flagged_rows(direct), columns, self.keys, self.partial_rows, counting)
            value = " ".join(f"WHEN {c.position} THEN {c.value}" for c in direct)
            parts.append(found.withColumn(SHOWN, F.expr(f"CASE {POSITION} {value} END")))
        if others:
            # The value is text here, and the column beside the keys.
            rows = self._listed_by(others).withColumnsRenamed({"value": SHOWN}).withColumn(FLAGS, F.array("position"))
            rows = rows.select(FLAGS, SHOWN, *self._key_columns(rows))
            columns = {c.position: [SHOWN] for c in others}
            parts.append(condensed(rows, columns, self.keys, self.partial_rows, counting))
        head = [F.col(POSITION).alias("position"), F.col(SHOWN).alias("value"), COUNT, TIE]
        keys = [F.col(ident(k)) for k in self.keys]
        rows = reduce(DataFrame.unionByName, [p.select(*head, *keys) for p in parts])
        lists = bounded(rows, self.keys, self.partial_rows)

        index = ", ".join(f"{quote(k)}, r.key_{i}" for i, k in enumerate(self.keys))
        return lists.selectExpr(
            "position",
            "transform(first, r -> r.value) AS partial_unexpected_list",
            (f"transform(first, r -> map({index}))" if index else "CAST(NULL AS array<map<string,string>>)")
            + " AS partial_unexpected_index_list",
            "frequent AS partial_unexpected_counts",
        )

    def _key_columns(self, rows: DataFrame) -> list[Column]:
        """The keys; those without a plain order are listed as text."""
        plain = {k: is_atomic(rows.schema[k].dataType) for k in self.keys}
        return [(F.col(ident(k)) if plain[k] else F.col(ident(k)).cast("string")).alias(k) for k in self.keys]

    def _flagged_rows(self, fused: list[Check]) -> DataFrame:
        """Each row that a rule lists, once, with the rules' numbers in FLAGS, the keys and the rules' columns."""
        base, rewrite = self._with_parsed(self._base(fused), fused)
        flags = [_flag(rewrite(c.listed), c.position) for c in fused]
        names = [n for n in dict.fromkeys(f.name for c in fused for f in c.fields) if n not in self.keys]
        used = [F.col(ident(n)) for n in names]
        if texts := [k for k in self.keys if not is_atomic(base.schema[k].dataType)]:
            base = base.withColumns({k: F.col(ident(k)).cast("string") for k in texts})
        marked = base.withColumn(FLAGS, F.array_remove(F.array(*flags), GOOD))
        # Exploding an array of none or one, as a filter would have the flags worked out twice.
        some = F.filter(F.array(FLAGS), lambda listed: F.size(listed) > 0)
        return marked.select(*[F.col(ident(k)) for k in self.keys], *used, F.explode(some).alias(FLAGS))

    def report(self, ordered: bool = True) -> DataFrame:
        """Violations with a pass flag per business rule; a clean check gives one row of nulls.

        The flags come from the counts, one row per rule, and are broadcast:
        no row of a rule has to meet the others.
        """
        group = Window.partitionBy("rule")
        flags = self.graded.select("position", "rule", "expectation_type", "column", "clean").withColumn(
            "pass", F.every("clean").over(group)
        )
        hit = self._listed.join(F.broadcast(flags.drop("clean")), "position")
        clean = flags.filter("clean").drop("clean")
        columns = ["position", "rule", "expectation_type", "column", "value", *self.keys, "pass"]
        report = hit.unionByName(clean, allowMissingColumns=True).select(*map(ident, columns))
        if ordered:
            # The task's number last, so that rows of one rule and key need not stay in one range.
            by_key = [F.col(ident(k)).asc_nulls_last() for k in self.keys]
            report = report.withColumn("rank", F.spark_partition_id()).orderBy("rule", *by_key, "position", "rank")
        return report.drop("position", "rank")


def suite_statistics(results: DataFrame) -> DataFrame:
    """Totals over any results, for example those read back from storage."""
    evaluated, successful = F.count(F.lit(1)), F.count_if(F.col("success"))
    return results.agg(
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
        evaluated.alias("evaluated_expectations"),
        successful.alias("successful_expectations"),
        (evaluated - successful).alias("unsuccessful_expectations"),
        (100 * successful / F.nullif(evaluated, F.lit(0))).alias("success_percent"),
    )


def latest_results(results: DataFrame) -> DataFrame:
    """The last run of each suite in a table of results, without a sort."""
    last = results.groupBy("suite").agg(F.max_by("run_id", "run_time").alias("run_id"))
    return results.join(last, ["suite", "run_id"], "left_semi")


def fill_for_display(violations: DataFrame, filler: str = "nan") -> DataFrame:
    """Replace nulls in the text columns, as for a printed table."""
    return violations.fillna(filler)


def _raises(work: RDD, splits: list[int]) -> Exception | None:
    """What the work on these splits raises, if it does."""
    try:
        work.context.runJob(work, lambda rows: [sum(1 for _ in rows)], splits)
    except Exception as error:  # noqa: BLE001 - whatever it is, it goes to a rule's result
        # The cause is a line of the job's message, as a class and a text.
        told = re.search(r"[\w.]*\.(\w+(?:Exception|Error): .+)", str(error))
        return RuntimeError(told[1]) if told else error
    return None


def _texts(values: Mapping) -> dict[str, str | None]:
    def text(value):
        if value is None or isinstance(value, str):
            return value
        return json.dumps(value, ensure_ascii=False, default=str)

    return {str(k): text(v) for k, v in values.items()}


def _table_arguments(check: Check) -> dict:
    given = {k: check.kwargs[k] for k in ("column", "mostly") if k in check.kwargs}
    return {**given, **check.arguments}


def _flag(predicate: Predicate, position: int) -> Column:
    if isinstance(predicate, str):
        return F.expr(f"CASE WHEN {predicate} THEN {position} ELSE {GOOD} END")
    return F.when(predicate, position).otherwise(GOOD)


def _count_struct(check: Check, values: dict[str, str]) -> str:
    columns = [f"'{name}', CAST({values.get(name, 'NULL')} AS {kind})" for name, kind in COUNT_TYPES.items()]
    return f"named_struct('position', {check.position}, {', '.join(columns)})"


def _count_row(df: DataFrame, **extra: Column) -> DataFrame:
    values = {c: F.col(c) for c in COUNT_TYPES if c in df.columns} | extra
    columns = [values.get(c, F.lit(None)).cast(t).alias(c) for c, t in COUNT_TYPES.items()]
    return df.select("position", *columns)


def _uniques(checks: list[Check]) -> list[Unique]:
    return [Unique(c.position, c.fields[0], c.domain) for c in checks]


def _placed(rows: DataFrame, check: Check) -> DataFrame:
    return rows.withColumn("value", F.col("value").cast("string")).withColumn("position", F.lit(check.position))
