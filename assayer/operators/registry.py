"""Rule types, the registry and the decorators that fill it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

# How a single-column rule treats rows whose value is missing.
SKIP = "skip"  # counted as missing, neither judged nor listed
LIST = "list"  # counted as missing, but listed when the condition is not met
JUDGE = "judge"  # judged like any other row; there is no missing count

# How unexpected_percent is worked out.
PERCENT = "percent"  # 100 * unexpected / judged rows
PERCENT_ROUNDED = "percent_rounded"  # the same, to one decimal
FRACTION = "fraction"  # unexpected / judged rows, to four decimals

# Arguments that belong to every rule and not to its condition.
COMMON_ARGUMENTS = frozenset(
    {
        "column",
        "column_A",
        "column_B",
        "column_list",
        "mostly",
        "row_condition",
        "condition_parser",
        "result_format",
        "ignore_row_if",
        "meta",
        "rule_id",
        "uuid",
        "order_by",
    }
)

PAIR_MODES = ("both_values_are_missing", "either_value_is_missing", "neither")
MULTI_MODES = ("all_values_are_missing", "any_value_is_missing", "never")


@dataclass(frozen=True)
class RuleType:
    """What a rule means, apart from the arguments of one use.

    ``scope`` says what ``condition`` is given: ``column`` one field, ``pair``
    two, ``multi`` a list; it returns a Spark SQL predicate or a ``Column``.
    ``aggregate``, ``schema`` and ``table`` rules judge the table as a whole,
    ``duplicates`` and ``order`` rules look at a value together with others.
    """

    name: str
    scope: str
    condition: Callable[..., Any] | None = None
    defaults: Mapping[str, Any] = field(default_factory=dict)
    nulls: str = SKIP
    ignore_row_if: str | None = None
    percent: str = PERCENT
    observe_ratio: bool = False
    adapt: Callable[[dict], dict] | None = None

    def derive(self, name: str, **changes) -> "RuleType":
        """Register a variant of this rule under another name.

        ``defaults`` given here are laid over those of this rule.
        """
        if "defaults" in changes:
            changes["defaults"] = {**self.defaults, **changes["defaults"]}
        return register(replace(self, name=name, **changes))


RULES: dict[str, RuleType] = {}


def register(kind: RuleType) -> RuleType:
    RULES[kind.name] = kind
    return kind


def _decorator(scope: str, name: str, options: dict, defaults: dict):
    def wrap(condition):
        register(RuleType(name, scope, condition, defaults, **options))
        return condition

    return wrap


def column_rule(name, *, nulls=SKIP, percent=PERCENT, observe_ratio=False, adapt=None, **defaults):
    """Register ``condition(field, **arguments)`` as a rule on one column."""
    options = dict(nulls=nulls, percent=percent, observe_ratio=observe_ratio, adapt=adapt)
    return _decorator("column", name, options, defaults)


def pair_rule(name, *, ignore_row_if="either_value_is_missing", adapt=None, **defaults):
    """Register ``condition(field_a, field_b, **arguments)`` as a rule on two columns."""
    return _decorator("pair", name, dict(ignore_row_if=ignore_row_if, adapt=adapt), defaults)


def multi_rule(name, *, ignore_row_if="any_value_is_missing", adapt=None, **defaults):
    """Register ``condition(fields, **arguments)`` as a rule on a list of columns."""
    return _decorator("multi", name, dict(ignore_row_if=ignore_row_if, adapt=adapt), defaults)


def table_rule(name, **defaults):
    """Register ``condition(df, **arguments)`` as a rule that makes its own result.

    It returns a DataFrame of one row with a boolean ``success`` and, as far as
    it knows them, ``element_count``, ``unexpected_count`` and ``observed_value``.
    """
    return _decorator("table", name, {}, defaults)


@dataclass(frozen=True)
class Rule:
    """One use of a rule type: its arguments, notes and identity."""

    expectation_type: str
    kwargs: Mapping[str, Any] = field(default_factory=dict)
    meta: Mapping[str, Any] = field(default_factory=dict)
    rule_id: str | None = None

    @staticmethod
    def of(expectation_type: str, *, meta: Mapping | None = None, rule_id: str | None = None, **kwargs) -> "Rule":
        """``Rule.of("expect_column_values_to_not_be_null", column="price", meta={"Rule": "R1"})``"""
        nested = kwargs.pop("meta", None)
        uuid = kwargs.get("uuid")
        return Rule(expectation_type, kwargs, dict(meta or nested or {}), rule_id or (str(uuid) if uuid else None))

    @property
    def columns(self) -> tuple[str, ...]:
        k = self.kwargs
        if "column_A" in k or "column_B" in k:
            return tuple(c for c in (k.get("column_A"), k.get("column_B")) if c)
        if "left_column" in k:
            return tuple(c for c in (k.get("left_column"), k.get("right_column"), k.get("result_column")) if c)
        if "column_list" in k:
            return tuple(k["column_list"])
        if "method" in k:
            return (k["method"][0],)
        return (k["column"],) if k.get("column") else ()

    @property
    def identity(self) -> tuple:
        """Rules of equal identity replace each other within a suite."""
        return (self.expectation_type, self.columns, self.kwargs.get("row_condition"), self.rule_id)
