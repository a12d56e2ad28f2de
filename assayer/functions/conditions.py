"""Comparisons and conversions shared by the rules, as Spark SQL text.

Every conversion is a ``try_`` form, so a dirty cell becomes null and then an
unexpected value, also under ANSI mode; it never stops the job.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from .sqltext import Field, literal, quote

# The comparison signs a rule accepts, with their SQL form.
COMPARISONS = {">=": ">=", "<=": "<=", ">": ">", "<": "<", "==": "="}

# The accepted date formats and the digits they stand for.
DATE_FORMATS = {
    "YYYY-MM-DD": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "YYYY-MM": r"^[0-9]{4}-[0-9]{2}\z",
    "YYYY": r"^[0-9]{4}\z",
}


def compare(left: str, sign: str, right: str) -> str:
    if sign not in COMPARISONS:
        raise ValueError(f"operator {sign!r} is not one of {', '.join(COMPARISONS)}")
    return f"{left} {COMPARISONS[sign]} {right}"


def as_text(field: Field) -> str:
    return str(field) if field.is_text else f"CAST({field} AS STRING)"


def as_double(field: Field) -> str:
    if field.is_number:
        return f"CAST({field} AS DOUBLE)"
    return f"TRY_CAST({as_text(field)} AS DOUBLE)"


def as_date(field: Field) -> str:
    """The day a cell stands for; text must read exactly ``yyyy-MM-dd``."""
    if field.is_time:
        return f"CAST({field} AS DATE)"
    text = as_text(field)
    return f"CASE WHEN {text} RLIKE {quote(DATE_FORMATS['YYYY-MM-DD'])} THEN TRY_CAST({text} AS DATE) END"


def date_literal(value) -> str:
    if isinstance(value, dt.datetime):
        value = value.date()
    if not isinstance(value, dt.date):
        value = dt.date.fromisoformat(str(value))
    return literal(value)


def today_in_hong_kong(now: dt.datetime) -> str:
    return now.astimezone(ZoneInfo("Asia/Hong_Kong")).date().isoformat()


def date_format_regex(name: str) -> str:
    if name not in DATE_FORMATS:
        raise ValueError(f"date_format {name!r} is not one of {', '.join(DATE_FORMATS)}")
    return DATE_FORMATS[name]


def comparable(field: Field, bounds: list) -> tuple[str, list[str]]:
    """The field and the bounds in one domain, so that they can be compared."""
    if field.is_time:
        kind = field.dtype.simpleString()
        return str(field), [f"CAST({literal(str(b))} AS {kind})" for b in bounds]
    if any(isinstance(b, str) for b in bounds):
        return as_text(field), [quote(str(b)) for b in bounds]
    if field.is_text:
        return as_double(field), [literal(b) for b in bounds]
    return str(field), [literal(b) for b in bounds]


def member(field: Field, values) -> str:
    """``field IN (values)``; long lists become a hash set in the plan."""
    wanted = [v for v in values if v is not None]
    if not wanted:
        return "false"
    if field.is_time:
        kind = field.dtype.simpleString()
        items = [f"CAST({literal(str(v))} AS {kind})" for v in wanted]
        return f"{field} IN ({', '.join(items)})"
    if field.is_text and not any(isinstance(v, str) for v in wanted):
        return f"{as_double(field)} IN ({', '.join(f'CAST({literal(v)} AS DOUBLE)' for v in wanted)})"
    if field.is_text or any(isinstance(v, str) for v in wanted):
        return f"{as_text(field)} IN ({', '.join(quote(str(v)) for v in wanted)})"
    return f"{field} IN ({', '.join(literal(v) for v in wanted)})"


def same_domain(a: Field, b: Field) -> tuple[str, str]:
    """Two fields ready for ``=``: as numbers if either is a number."""
    if a.is_number != b.is_number:
        return as_double(a), as_double(b)
    if a.dtype != b.dtype and (a.is_text or b.is_text):
        return as_text(a), as_text(b)
    return str(a), str(b)
