"""The given tables with some dirt, by the same SQL in Spark and in the oracle.

The given tables are clean, so nulls, wrong values and badly written dates are
put in by key; every row is kept.
"""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession

from assayer.sources import remove_folder, scratch_folder

DAY = "cast(cast({} as date) as string)"
ORDER_DAY = DAY.format("o_orderdate")
SHIP_DAY = DAY.format("l_shipdate")
RECEIPT_DAY = DAY.format("cast(l_shipdate as date) + cast(l_orderkey % 7 - 2 as int)")

MONTH = "case month(o_orderdate) " + " ".join(
    f"when {n} then '{m}'"
    for n, m in enumerate(
        "January February March April May June July August September October November December".split(), 1
    )
) + " end"
YEAR_, MONTH_, DAY_ = (f"cast({part}(o_orderdate) as string)" for part in ("year", "month", "day"))
FORMS = [
    f"concat({DAY_}, '-', substring({MONTH}, 1, 3), '-', {YEAR_})",
    f"concat({MONTH}, ' ', {DAY_}, ', ', {YEAR_})",
    f"concat(substring({MONTH}, 1, 3), ' ', {DAY_})",
    f"concat({MONTH}, ' ', {YEAR_})",
    f"concat({MONTH_}, '/', {DAY_}, '/', substring({YEAR_}, 3, 2))",
    f"concat({DAY_}, '.', {MONTH_}, '.', {YEAR_})",
    f"concat({YEAR_}, '/', {MONTH_}, '/', {DAY_}, ' 10:30 PM')",
    f"concat('Sunday, ', {DAY_}, ' ', {MONTH}, ' ', {YEAR_})",
    f"concat('Mon ', substring({MONTH}, 1, 3), '  ', {DAY_}, ' 10:11:12 ', {YEAR_})",
    ORDER_DAY,
    f"concat('32 ', {MONTH}, ' ', {YEAR_})",
    f"concat({YEAR_}, '-13-', {DAY_}, ' or so')",
]

TABLES: dict[str, tuple[str, list[str]]] = {
    "dirty_orders": (
        "orders",
        [
            "o_orderkey",
            "o_custkey",
            "o_totalprice",
            "o_orderdate",
            f"case when o_orderkey % 101 = 0 then null when o_orderkey % 97 = 0 then 'abc'"
            f" when o_orderkey % 89 = 0 then substring({ORDER_DAY}, 1, 7) else {ORDER_DAY} end as order_date",
            f"case when o_orderkey % 101 = 0 then null when o_orderkey % 97 = 0 then '19-96'"
            f" when o_orderkey % 89 = 0 then {ORDER_DAY} else substring({ORDER_DAY}, 1, 7) end as order_month",
            f"case when o_orderkey % 101 = 0 then null when o_orderkey % 97 = 0 then '96'"
            f" when o_orderkey % 89 = 0 then {ORDER_DAY} else substring({ORDER_DAY}, 1, 4) end as order_year",
            "case when o_orderkey % 53 = 0 then null when o_orderkey % 61 = 0 then 'X' else o_orderstatus end as status",
            "case when o_orderkey % 71 = 0 then null else o_totalprice end as price",
            "case when o_orderkey % 71 = 0 then null when o_orderkey % 83 = 0 then 'n/a'"
            " else cast(o_totalprice as string) end as price_text",
            "case when o_orderkey % 43 = 0 then null else o_orderpriority end as priority",
        ],
    ),
    "written_orders": (
        "orders",
        [
            "o_orderkey",
            f"o_orderkey % {len(FORMS)} as form",
            "case when o_orderkey % 101 = 0 then null "
            + " ".join(f"when o_orderkey % {len(FORMS)} = {n} then {form}" for n, form in enumerate(FORMS))
            + " end as written",
        ],
    ),
    "dirty_lines": (
        "lineitem",
        [
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_extendedprice",
            "l_discount",
            "case when l_orderkey % 31 = 0 then null else l_quantity end as quantity",
            "case when l_orderkey % 37 = 0 then null else l_discount end as discount",
            f"case when l_orderkey % 47 = 0 then null when l_orderkey % 67 = 0 then 'abc' else {SHIP_DAY} end as ship_date",
            f"case when l_orderkey % 59 = 0 then null else {RECEIPT_DAY} end as receipt_date",
            "case when l_orderkey % 59 = 0 then null when l_orderkey % 41 = 0 then l_extendedprice * (1 - l_discount) + 1"
            " else l_extendedprice * (1 - l_discount) end as net_price",
            "case when l_orderkey % 29 = 0 then null when l_orderkey % 23 = 0 then 'none'"
            " else cast(l_quantity + l_orderkey % 2 as string) end as counted",
        ],
    ),
    "dirty_events": (
        "events",
        [
            "event_id",
            "user_id",
            "case when event_id % 19 = 0 then null else value end as value",
            "case when event_id % 73 = 0 then null else event_type end as event_type",
            "event_type as given_type",
        ],
    ),
}


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new shared folder for a query's files; results are read lazily, so it goes when the application ends."""
    path = scratch_folder(spark, purpose)

    def remove() -> None:
        with contextlib.suppress(Exception):  # a stopped session has no file system to ask
            remove_folder(spark, path)

    atexit.register(remove)
    return path


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or a dirty table as a DataFrame."""
    if name not in TABLES:
        return given(spark, sf_dir, name)
    source, columns = TABLES[name]
    return given(spark, sf_dir, source).selectExpr(*columns)


def table_sql(name: str) -> str:
    """The same as a subquery for the oracle."""
    if name not in TABLES:
        return name
    source, columns = TABLES[name]
    return f"(select {', '.join(columns)} from {source})"
