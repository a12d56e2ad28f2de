"""Small helpers that write Spark SQL predicates.

Rule conditions are kept as SQL text wherever possible: the text goes to
``expr`` for the plan and is also what a user gets back as the query for the
offending rows.  A condition may be a ``Column`` instead; then there is no text.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from decimal import Decimal
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = Union[str, Column]


class Sure(str):
    """SQL that is true or false, never unknown, wherever its columns hold a value."""


@dataclass(frozen=True)
class Field:
    """A column of the checked table; prints as its quoted SQL name."""

    name: str
    dtype: T.DataType

    def __str__(self) -> str:
        return ident(self.name)

    @property
    def col(self) -> Column:
        return F.col(ident(self.name))

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, (T.StringType, T.CharType, T.VarcharType))

    @property
    def is_number(self) -> bool:
        return isinstance(self.dtype, T.NumericType)

    @property
    def is_float(self) -> bool:
        return isinstance(self.dtype, (T.DoubleType, T.FloatType))

    @property
    def is_time(self) -> bool:
        return isinstance(self.dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))

    @property
    def missing(self) -> str:
        if self.is_float:
            return f"({self} IS NULL OR isnan({self}))"
        return f"{self} IS NULL"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal(value) -> str:
    """A Python scalar as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return f"{value}L" if -(2**63) <= value < 2**63 else f"{value}BD"
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return f"double('{value}')"
        return f"{value!r}D"
    if isinstance(value, Decimal):
        return f"{value}BD"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return quote(str(value))


def as_column(predicate: Predicate) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def both(*predicates: Predicate | None) -> Predicate | None:
    """AND of the given predicates; ``None`` stands for "always true"."""
    given = [p for p in predicates if p is not None]
    if not given:
        return None
    if len(given) == 1:
        return given[0]
    if all(isinstance(p, str) for p in given):
        return " AND ".join(f"({p})" for p in given)
    result = as_column(given[0])
    for p in given[1:]:
        result = result & as_column(p)
    return result


def fails(predicate: Predicate, given: bool = False) -> Predicate:
    """True where the predicate is false or unknown.

    Where its columns are ``given`` a sure predicate is just negated: Spark can
    hand such a filter to the files, which then skip what cannot match.
    """
    if given and isinstance(predicate, Sure):
        return f"NOT ({predicate})"
    if isinstance(predicate, str):
        return f"NOT coalesce({predicate}, false)"
    return ~F.coalesce(predicate, F.lit(False))
