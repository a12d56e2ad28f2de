"""SQL counterparts of rule results, written as plain aggregates and windows."""

from __future__ import annotations

from .tables import table_sql

DATE = r"regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}')"


def day(column: str) -> str:
    """The date a text column reads as, or null."""
    return f"case when {DATE.format(column)} then try_cast({column} as date) end"


def row_result(
    rule: str,
    table: str,
    good: str,
    missing: str | None = None,
    domain: str = "true",
    mostly: float = 1.0,
    percent: str = "percent",
    ratio: bool = False,
    rule_id: str = "rule_001",
) -> str:
    """One result row of a rule that judges rows."""
    judged = f"({domain}) and not ({missing})" if missing else f"({domain})"
    shares = {
        "percent": "100::double * u / nullif(j, 0)",
        "percent_rounded": "round(100::double * u / nullif(j, 0), 1)",
        "fraction": "round(u::double / nullif(j, 0), 4)",
    }
    missing_count = f"count(*) filter (where ({domain}) and ({missing}))" if missing else "null::bigint"
    return f"""
select '{rule_id}' as rule_id, 'expect_{rule}' as expectation_type,
       case when j = 0 then true else (j - u)::double / j >= {mostly} end as success,
       n as element_count, m as missing_count, u as unexpected_count,
       round({shares[percent]}, 6) as unexpected_percent,
       {'round(1 - u::double / nullif(n, 0), 6)' if ratio else 'null::double'} as observed_value
from (select count(*) filter (where {domain}) as n, {missing_count} as m,
             count(*) filter (where {judged}) as j,
             count(*) filter (where {judged} and not coalesce({good}, false)) as u
      from {table_sql(table)} t) counted"""


def verdict(rule: str, passed: str, observed: str = "null::double", rule_id: str = "rule_001") -> str:
    """One result row of a rule on the table as a whole; both are scalar SQL."""
    return f"""
select '{rule_id}' as rule_id, 'expect_{rule}' as expectation_type, ({passed}) as success,
       null::bigint as element_count, null::bigint as missing_count, null::bigint as unexpected_count,
       null::double as unexpected_percent, round(({observed})::double, 6) as observed_value"""


def union(*selects: str) -> str:
    return "\nunion all\n".join(selects)


def has_column(table: str, column: str) -> str:
    return (
        "select count(*) > 0 from information_schema.columns"
        f" where table_name = '{table}' and column_name = '{column}'"
    )
