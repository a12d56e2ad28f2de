"""From a rule and a schema to predicates and aggregates."""

from __future__ import annotations

import datetime as dt
import re
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import as_text
from ..functions.pandastext import pandas_condition
from ..functions.sqltext import Field, Predicate, as_column, both, fails
from ..operators.duplicates import comparable
from ..operators.registry import (
    COMMON_ARGUMENTS,
    JUDGE,
    LIST,
    MULTI_MODES,
    PAIR_MODES,
    RULES,
    SKIP,
    Rule,
    RuleType,
)


# A cast of quoted text in a compiled predicate.
CONSTANT = re.compile(r"\bCAST\('(?:[^'\\]|\\.)*' AS [A-Za-z_]+(?:\([0-9, ]+\))?\)")


@dataclass(frozen=True)
class Check:
    """A rule made ready for one table.

    ``domain`` says which rows the rule is about (those of its row condition,
    and not ignored), ``missing`` which of these it leaves unjudged,
    ``condition`` what the judged ones must meet.
    """

    position: int
    rule: Rule
    kind: RuleType | None
    kwargs: dict = field(default_factory=dict)
    fields: tuple[Field, ...] = ()
    row_condition: Predicate | None = None
    domain: Predicate | None = None
    missing: Predicate | None = None
    condition: Predicate | None = None
    arguments: dict = field(default_factory=dict)
    decided: tuple[bool, float | None] | None = None
    error: str | None = None
    trace: str | None = None

    @property
    def scope(self) -> str:
        if self.error is not None:
            return "failed"
        return self.kind.scope

    @property
    def judges_rows(self) -> bool:
        return self.scope in ("column", "pair", "multi")

    @property
    def mostly(self) -> float:
        return float(self.kwargs.get("mostly", 1.0))

    @property
    def group(self) -> str:
        return str(self.rule.meta.get("Rule", self.rule.rule_id))

    @property
    def column_label(self) -> str:
        return ", ".join(self.rule.columns)

    @property
    def counted(self) -> Predicate:
        """Rows that count as unexpected."""
        judged = both(self.domain, f"NOT ({self.missing})" if self.missing is not None else None)
        return both(judged, fails(self.condition, given=self.missing is not None))

    @property
    def listed(self) -> Predicate:
        """Rows shown as unexpected; they may include missing ones."""
        if self.kind.nulls == LIST:
            return both(self.domain, fails(self.condition))
        return self.counted

    @property
    def query(self) -> str | None:
        """The listed rows as SQL text for ``df.filter``."""
        if self.judges_rows and isinstance(self.listed, str):
            return self.listed
        return None

    @property
    def value(self) -> str:
        """The judged value as text, in SQL; for several columns, all of them."""
        if len(self.fields) == 1:
            return as_text(self.fields[0])
        shown = [f"coalesce({as_text(f)}, 'null')" for f in self.fields]
        return f"concat_ws(', ', {', '.join(shown)})"


def compile_suite(
    df: DataFrame, rules: list[Rule], now: dt.datetime, keys: list[str], strict: bool = False
) -> list[Check]:
    """Compile every rule; one that cannot be compiled becomes a failed check."""
    checks = []
    for position, rule in enumerate(rules):
        try:
            checks.append(_compile(df.schema, position, rule, now))
        except Exception as error:  # noqa: BLE001 - any bad argument must end up in the result
            if strict:
                raise
            checks.append(failed(position, rule, error))
    return _resolved(df, checks, keys, strict)


def failed(position: int, rule: Rule, error: Exception) -> Check:
    message = f"{type(error).__name__}: {error}".splitlines()[0]
    trace = "".join(traceback.format_exception(error))
    return Check(position, rule, RULES.get(rule.expectation_type), error=message, trace=trace)


def _compile(schema: T.StructType, position: int, rule: Rule, now: dt.datetime) -> Check:
    if rule.expectation_type not in RULES:
        raise KeyError(f"unknown rule {rule.expectation_type}")
    kind = RULES[rule.expectation_type]
    kwargs = dict(rule.kwargs)
    if kind.adapt:
        kwargs = kind.adapt(kwargs)
    if not 0 <= float(kwargs.get("mostly", 1.0)) <= 1:
        raise ValueError("mostly must lie between 0 and 1")
    arguments = {name: d(now) if callable(d) else d for name, d in kind.defaults.items()}
    arguments |= {k: v for k, v in kwargs.items() if k not in COMMON_ARGUMENTS}
    row_condition = _row_condition(schema, kwargs)
    check = Check(position, rule, kind, kwargs, row_condition=row_condition, domain=row_condition, arguments=arguments)

    if kind.scope == "schema":
        return replace(check, decided=kind.condition(schema, {**arguments, "column": kwargs.get("column")}))

    fields = _fields(schema, kind, kwargs)
    check = replace(check, fields=fields)
    if kind.scope == "column":
        missing = None if kind.nulls == JUDGE else fields[0].missing
        condition = kind.condition(fields[0], **arguments)
        return replace(check, missing=missing, condition=condition if kind.nulls == SKIP else _given(fields, condition))
    if kind.scope in ("duplicates", "order"):
        if kind.scope == "order":
            if not kwargs.get("order_by"):
                raise ValueError("order_by is required: a table has no row order of its own")
            _field(schema, kwargs["order_by"])
        elif not comparable(fields[0].dtype):
            raise ValueError(f"values of type {fields[0].dtype.simpleString()} cannot be compared")
        return replace(check, missing=fields[0].missing)
    if kind.scope == "pair":
        domain = both(row_condition, _kept(fields, kwargs.get("ignore_row_if", kind.ignore_row_if), PAIR_MODES))
        return replace(check, domain=domain, condition=_given(fields, kind.condition(*fields, **arguments)))
    if kind.scope == "multi":
        domain = both(row_condition, _kept(fields, kwargs.get("ignore_row_if", kind.ignore_row_if), MULTI_MODES))
        return replace(check, domain=domain, condition=_given(fields, kind.condition(list(fields), **arguments)))
    return check


def _row_condition(schema: T.StructType, kwargs: dict) -> Predicate | None:
    """A rule's row condition as a predicate; text for pandas that is no expression of Python is taken as SQL."""
    given = kwargs.get("row_condition")
    if isinstance(given, str) and given.strip() and kwargs.get("condition_parser") == "pandas":
        try:
            return pandas_condition(given, schema)
        except SyntaxError:
            pass
    return lenient(given) or None


def lenient(condition: str | None) -> str | None:
    """A row condition whose casts give null instead of an error; quoted text stays as it is."""
    if not isinstance(condition, str):
        return condition
    parts = re.split(r"('(?:[^'\\\\]|\\\\.)*'|\"(?:[^\"\\\\]|\\\\.)*\"|`[^`]*`)", condition)
    return "".join(p if i % 2 else re.sub(r"(?i)(?<![\w.])cast\s*\(", "try_cast(", p) for i, p in enumerate(parts))


def _given(fields: tuple[Field, ...], condition: Predicate) -> Predicate:
    """The condition, false where a number is NaN: Spark sorts NaN above all, but it is no value."""
    return both(*[f"NOT isnan({f})" for f in fields if f.is_float], condition)


def _fields(schema: T.StructType, kind: RuleType, kwargs: dict) -> tuple[Field, ...]:
    if kind.scope == "pair":
        return tuple(_field(schema, kwargs[name]) for name in ("column_A", "column_B"))
    if kind.scope == "multi":
        return tuple(_field(schema, name) for name in kwargs["column_list"])
    if kwargs.get("column"):
        return (_field(schema, kwargs["column"]),)
    if kind.scope in ("column", "duplicates", "order"):
        raise ValueError("column is required")
    return ()


def _field(schema: T.StructType, name: str) -> Field:
    if name not in schema.fieldNames():
        raise KeyError(f"column {name!r} does not exist")
    return Field(name, schema[name].dataType)


def _kept(fields: tuple[Field, ...], mode: str, modes: tuple[str, str, str]) -> str | None:
    """The rows an ``ignore_row_if`` mode leaves in the domain."""
    if mode not in modes:
        raise ValueError(f"ignore_row_if {mode!r} is not one of {', '.join(modes)}")
    if mode == modes[2]:
        return None
    word = " OR " if mode == modes[0] else " AND "
    return word.join(f"NOT ({f.missing})" for f in fields)


def _resolved(df: DataFrame, checks: list[Check], keys: list[str], strict: bool) -> list[Check]:
    """Fail the checks whose SQL does not resolve against the table.

    All are analysed together; only if that fails, one by one.
    """
    for key in keys:
        if key not in df.columns:
            raise KeyError(f"key column {key!r} does not exist")
    probes: dict[int, list[Callable[[], Column]]] = {}
    for check in checks:
        if check.judges_rows:
            probes[check.position] = [lambda c=check: as_column(c.counted)]
        elif check.error is None and check.domain is not None:
            probes[check.position] = [lambda c=check: as_column(c.domain)]

    def analyse(builders) -> None:
        probes = [build().alias(f"probe_{i}") for i, build in enumerate(builders)]
        df.select(*probes).schema

    # What is constant is worked out once, without the table: bounds, members, sums, patterns.
    constants: dict[int, list[Column]] = {}
    for check in checks:
        if check.error is None and isinstance(check.counted if check.judges_rows else None, str):
            constants[check.position] = [F.expr(m[0]) for m in CONSTANT.finditer(check.counted)]
        if check.error is None and isinstance(check.arguments.get("regex"), str):
            constants.setdefault(check.position, []).append(F.lit("").rlike(check.arguments["regex"]))

    def work_out(positions) -> None:
        made = [c for p in positions for c in constants.get(p, [])]
        if made:
            # Of a single literal row the optimizer makes another one; no job runs.
            one = df.sparkSession.sql("SELECT * FROM VALUES (1) AS one(one)")
            one.select(*[c.alias(f"constant_{i}") for i, c in enumerate(made)]).collect()

    try:
        analyse([b for builders in probes.values() for b in builders])
        work_out(constants)
        return checks
    except Exception:  # noqa: BLE001
        if strict:
            raise
    result = []
    for check in checks:
        try:
            analyse(probes.get(check.position, []))
            work_out([check.position])
            result.append(check)
        except Exception as error:  # noqa: BLE001
            result.append(failed(check.position, check.rule, error))
    return result
