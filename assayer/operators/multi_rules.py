"""Rules on a list of columns of a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import types as T

from ..functions.arithmetic import arithmetic
from ..functions.conditions import as_double
from ..functions.sqltext import Field, literal
from .registry import RULES, multi_rule


@multi_rule("expect_multicolumn_sum_to_equal", ignore_row_if="all_values_are_missing")
def multicolumn_sum(fields: list[Field], value):
    """The row's sum; one that overflows is null and so unexpected."""
    if isinstance(value, str):
        value = float(value)  # text that is no number fails the rule alone
    total = reduce(lambda a, b: f"try_add({a}, {b})", map(_addend, fields))
    return f"{total} = {literal(value)}"


def _addend(field: Field) -> str:
    if isinstance(field.dtype, T.IntegralType):
        return f"CAST({field} AS BIGINT)"
    return str(field) if field.is_number else as_double(field)


@multi_rule("expect_columns_arithmetic_to_equals_result_column", tolerance=1e-2)
def arithmetic_result(fields: list[Field], expr, tolerance):
    """The last column is the result; the others fill ``{0}``, ``{1}``, ... of ``expr``."""
    *operands, result = (as_double(f) for f in fields)
    present = " AND ".join(f"{value} IS NOT NULL" for value in (result, *operands))
    return f"{present} AND abs({arithmetic(expr, operands)} - {result}) < {literal(float(tolerance))}"


ARITHMETIC = RULES["expect_columns_arithmetic_to_equals_result_column"]
ARITHMETIC.derive("expect_columns_arithmetic_to_equals_result_column_nfn", ignore_row_if="never")


def _two_operands(kwargs: dict) -> dict:
    sign = kwargs.pop("operator")
    if sign not in ("+", "-", "*", "/"):
        raise ValueError(f"operator {sign!r} is not one of + - * /")
    operands = [kwargs.pop(name) for name in ("left_column", "right_column", "result_column")]
    return {**kwargs, "column_list": operands, "expr": f"{{0}} {sign} {{1}}"}


# The same rule with two operands and one sign; any column_list given is redundant.
ARITHMETIC.derive("expect_columns_arithmetic_to_equals_result_column_v1", adapt=_two_operands)
