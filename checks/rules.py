"""One query per rule: its counts, percentage and verdict on a dirty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer import RULES, Rule, Suite, column_rule, multi_rule, pair_rule, table_rule, validate

from .oracle import day, has_column, row_result, union, verdict
from .tables import table, table_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def verdicts(df: DataFrame, rules: list[Rule], keys: list[str] | None = None) -> DataFrame:
    graded = validate(df, Suite("check", rules), keys=keys).graded
    return graded.select(
        "rule_id",
        "expectation_type",
        "success",
        "element_count",
        "missing_count",
        "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"),
        F.round("observed_value", 6).alias("observed_value"),
    )


def add(name: str, source: str, uses: list[tuple[str, dict]], sql: str | None) -> None:
    rules = [Rule.of(f"expect_{rule}", **kwargs) for rule, kwargs in uses]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return verdicts(table(spark, sf_dir, source), rules)

    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


ORDERS, LINES, EVENTS = "dirty_orders", "dirty_lines", "dirty_events"
NULL = "{} is null".format
ID2 = dict(rule_id="rule_002")
ID3 = dict(rule_id="rule_003")

# -- schema, counts, statistics -------------------------------------------

NOT_NULL_KEY = ("column_values_to_not_be_null", dict(column="o_orderkey"))
add(
    "dq_exists",
    "orders",
    [
        ("column_to_exist", dict(column="o_orderdate")),
        ("column_to_exist", dict(column="pay_date", rule_id="absent")),
        NOT_NULL_KEY,
    ],
    union(
        verdict("column_to_exist", has_column("orders", "o_orderdate")),
        verdict("column_to_exist", has_column("orders", "pay_date"), rule_id="absent"),
        row_result("column_values_to_not_be_null", "orders", "o_orderkey is not null", **ID2),
    ),
)
TYPE_OF = (
    "select count(*) > 0 from information_schema.columns where table_name = 'orders'"
    " and column_name = '{}' and data_type = '{}'"
)
add(
    "dq_of_type",
    "orders",
    [
        ("column_values_to_be_of_type", dict(column="o_orderkey", type_="int64")),
        ("column_values_to_be_of_type", dict(column="o_orderdate", type_="int64")),
        ("column_values_to_be_of_type", dict(column="o_totalprice", type_="float64")),
        ("column_values_to_not_be_null", dict(column="o_totalprice")),
    ],
    union(
        verdict("column_values_to_be_of_type", TYPE_OF.format("o_orderkey", "BIGINT")),
        verdict("column_values_to_be_of_type", TYPE_OF.format("o_orderdate", "BIGINT"), **ID2),
        verdict("column_values_to_be_of_type", TYPE_OF.format("o_totalprice", "DOUBLE"), **ID3),
        row_result("column_values_to_not_be_null", "orders", "o_totalprice is not null", rule_id="rule_004"),
    ),
)
add(
    "dq_row_count",
    ORDERS,
    [
        ("table_row_count_to_be_between", dict(min_value=1)),
        ("table_row_count_to_be_between", dict(max_value=10, row_condition="status = 'F'")),
    ],
    union(
        verdict("table_row_count_to_be_between", "select count(*) >= 1 from orders", "select count(*) from orders"),
        verdict(
            "table_row_count_to_be_between",
            f"select count(*) <= 10 from {table_sql(ORDERS)} t where status = 'F'",
            f"select count(*) from {table_sql(ORDERS)} t where status = 'F'",
            **ID2,
        ),
    ),
)
COLUMNS = "select count(*){} from information_schema.columns where table_name = 'lineitem'"
add(
    "dq_column_count",
    "lineitem",
    [
        ("table_column_count_to_be_between", dict(min_value=5, max_value=20)),
        ("table_row_count_to_be_between", dict(min_value=1)),
    ],
    union(
        verdict("table_column_count_to_be_between", COLUMNS.format(" between 5 and 20"), COLUMNS.format("")),
        verdict(
            "table_row_count_to_be_between",
            "select count(*) >= 1 from lineitem",
            "select count(*) from lineitem",
            **ID2,
        ),
    ),
)
add(
    "dq_mean_between",
    LINES,
    [
        ("column_mean_to_be_between", dict(column="quantity", min_value=10, max_value=40)),
        ("column_mean_to_be_between", dict(column="l_extendedprice", max_value=20)),
    ],
    union(
        verdict(
            "column_mean_to_be_between",
            f"select avg(quantity) between 10 and 40 from {table_sql(LINES)} t",
            f"select avg(quantity) from {table_sql(LINES)} t",
        ),
        verdict(
            "column_mean_to_be_between",
            "select avg(l_extendedprice) <= 20 from lineitem",
            "select avg(l_extendedprice) from lineitem",
            **ID2,
        ),
    ),
)

# -- one column -----------------------------------------------------------

add(
    "dq_not_null",
    ORDERS,
    [("column_values_to_not_be_null", dict(column="status", mostly=0.9))],
    row_result("column_values_to_not_be_null", ORDERS, "status is not null", mostly=0.9),
)
REPEATS = "(select *, count(*) over (partition by {}) as k from events)"
add(
    "dq_unique",
    "events",
    [
        ("column_values_to_be_unique", dict(column="event_id")),
        ("column_values_to_be_unique", dict(column="user_id", row_condition="event_type = 'error'")),
    ],
    union(
        row_result("column_values_to_be_unique", REPEATS.format("event_id"), "k = 1", "event_id is null"),
        row_result(
            "column_values_to_be_unique",
            REPEATS.format("user_id, event_type"),
            "k = 1",
            "user_id is null",
            domain="event_type = 'error'",
            **ID2,
        ),
    ),
)
# Whole numbers, doubles and texts, some rules on some of the rows.
MANY = [
    ("l_orderkey", None),
    ("l_partkey", None),
    ("l_extendedprice", None),
    ("quantity", None),
    ("discount", None),
    ("ship_date", None),
    ("receipt_date", None),
    ("counted", None),
    ("l_orderkey", "l_linenumber = 1"),
    ("l_partkey", "l_linenumber > 4 and quantity > 20"),
    ("ship_date", "counted = 'none'"),
    ("l_linenumber", "l_orderkey < 0"),
]


def repeated_sql(column: str, condition: str | None) -> str:
    """The table's rows with ``inside`` and the size ``k`` of the value's group inside."""
    return (
        f"(select *, count(*) over (partition by {column}, inside) as k"
        f" from (select *, coalesce({condition or 'true'}, false) as inside from {table_sql(LINES)} a) b)"
    )


def many_uniques() -> list[tuple[str, dict]]:
    return [
        ("column_values_to_be_unique", dict(column=c, rule_id=f"u{i:02}", **(dict(row_condition=r) if r else {})))
        for i, (c, r) in enumerate(MANY)
    ]


add(
    "dq_unique_many",
    LINES,
    many_uniques(),
    union(
        *[
            row_result(
                "column_values_to_be_unique", repeated_sql(c, r), "k = 1", NULL(c), domain="inside", rule_id=f"u{i:02}"
            )
            for i, (c, r) in enumerate(MANY)
        ]
    ),
)
add(
    "dq_between",
    LINES,
    [
        ("column_values_to_be_between", dict(column="quantity", min_value=5, max_value=45, mostly=0.7)),
        ("column_values_to_be_between", dict(column="discount", min_value=0.02)),
        ("column_values_to_be_between", dict(column="counted", max_value=30)),
    ],
    union(
        row_result(
            "column_values_to_be_between", LINES, "quantity between 5 and 45", "quantity is null", mostly=0.7
        ),
        row_result("column_values_to_be_between", LINES, "discount >= 0.02", "discount is null", **ID2),
        row_result(
            "column_values_to_be_between", LINES, "try_cast(counted as double) <= 30", "counted is null", **ID3
        ),
    ),
)
add(
    "dq_between_nfn",
    LINES,
    [("column_values_to_be_between_nfn", dict(column="quantity", min_value=5, max_value=45))],
    row_result("column_values_to_be_between_nfn", LINES, "quantity between 5 and 45", "quantity is null"),
)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
IN_PRIORITIES = "priority in ('1-URGENT', '2-HIGH', '3-MEDIUM')"
add(
    "dq_in_set",
    ORDERS,
    [
        ("column_values_to_be_in_set", dict(column="priority", value_set=PRIORITIES, mostly=0.5)),
        ("column_values_to_be_in_set", dict(column="status", value_set=["F", "O", "P"])),
    ],
    union(
        row_result("column_values_to_be_in_set", ORDERS, IN_PRIORITIES, "priority is null", mostly=0.5),
        row_result("column_values_to_be_in_set", ORDERS, "status in ('F', 'O', 'P')", "status is null", **ID2),
    ),
)
add(
    "dq_not_in_set",
    ORDERS,
    [("column_values_to_not_be_in_set", dict(column="status", value_set=["X", "Y"]))],
    row_result("column_values_to_not_be_in_set", ORDERS, "status not in ('X', 'Y')", "status is null"),
)
add(
    "dq_regex",
    ORDERS,
    [("column_values_to_match_regex", dict(column="priority", regex=r"^[1-3]-.*[A-Z]$"))],
    row_result(
        "column_values_to_match_regex", ORDERS, r"regexp_matches(priority, '^[1-3]-.*[A-Z]$')", "priority is null"
    ),
)
add(
    "dq_strftime",
    ORDERS,
    [
        ("column_values_to_match_strftime_format", dict(column="order_date", strftime_format="%Y-%m-%d")),
        ("column_values_to_match_strftime_format", dict(column="order_month", strftime_format="%Y-%m")),
    ],
    union(
        row_result(
            "column_values_to_match_strftime_format",
            ORDERS,
            "try_strptime(order_date, '%Y-%m-%d') is not null",
            "order_date is null",
        ),
        row_result(
            "column_values_to_match_strftime_format",
            ORDERS,
            "try_strptime(order_month, '%Y-%m') is not null",
            "order_month is null",
            **ID2,
        ),
    ),
)
add(
    "dq_parseable",
    ORDERS,
    [("column_values_to_be_dateutil_parseable", dict(column="order_date"))],
    row_result(
        "column_values_to_be_dateutil_parseable",
        ORDERS,
        "try_cast(order_date as timestamp) is not null or try_strptime(order_date, '%Y-%m') is not null",
        "order_date is null",
    ),
)
# Order dates as people write them: ten forms that are dates, two that are not.
add(
    "dq_parseable_forms",
    "written_orders",
    [("column_values_to_be_dateutil_parseable", dict(column="written"))],
    row_result("column_values_to_be_dateutil_parseable", "written_orders", "form < 10", "written is null"),
)
add(
    "dq_increasing",
    EVENTS,
    [("column_values_to_be_increasing", dict(column="value", order_by="event_id"))],
    f"""
select 'rule_001' as rule_id, 'expect_column_values_to_be_increasing' as expectation_type, u = 0 as success,
       n as element_count, m as missing_count, u as unexpected_count,
       round(100::double * u / nullif(n - m, 0), 6) as unexpected_percent, null::double as observed_value
from (select count(*) as n, count(*) filter (where value is null) as m from {table_sql(EVENTS)} t) sizes,
     (select count(*) filter (where value < before) as u
      from (select value, lag(value) over (order by event_id) as before
            from {table_sql(EVENTS)} t where value is not null) steps) falls""",
)
DATED = dict(column="order_date", date="1996-01-01", operator=">=")
SINCE = f"{day('order_date')} >= date '1996-01-01'"
add(
    "dq_date_condition",
    ORDERS,
    [("column_values_to_meet_date_condition", {**DATED, "mostly": 0.8})],
    row_result("column_values_to_meet_date_condition", ORDERS, SINCE, "order_date is null", mostly=0.8),
)
add(
    "dq_date_condition_nfn",
    ORDERS,
    [("column_values_to_meet_date_condition_nfn", DATED)],
    row_result("column_values_to_meet_date_condition_nfn", ORDERS, SINCE, "order_date is null"),
)
add(
    "dq_date_condition_v1",
    ORDERS,
    [("column_values_to_meet_date_condition_v1", DATED)],
    row_result("column_values_to_meet_date_condition_v1", ORDERS, SINCE, percent="percent_rounded"),
)
add(
    "dq_condition_packed",
    ORDERS,
    [("column_values_to_meet_condition", dict(method=["order_date", "1997-06-30", "<", 0.1]))],
    row_result(
        "column_values_to_meet_condition",
        ORDERS,
        f"{day('order_date')} < date '1997-06-30'",
        mostly=0.1,
        percent="percent_rounded",
    ),
)
for suffix, column, fmt, good in (
    ("ymd", "order_date", "YYYY-MM-DD", f"{day('order_date')} is not null"),
    (
        "ym",
        "order_month",
        "YYYY-MM",
        r"regexp_full_match(order_month, '\d{4}-\d{2}') and try_cast(order_month || '-01' as date) is not null",
    ),
    ("y", "order_year", "YYYY", r"regexp_full_match(order_year, '\d{4}')"),
):
    add(
        f"dq_date_format_{suffix}",
        ORDERS,
        [("column_values_to_match_date_format", dict(column=column, date_format=fmt))],
        row_result("column_values_to_match_date_format", ORDERS, good, NULL(column)),
    )
for name, kwargs, good in (
    ("dq_day_of_month", dict(day_of_month=15), "day({d}) = 15"),
    ("dq_day_from_end", dict(day_of_month=-2), "day(last_day({d})) - day({d}) + 1 = 2"),
    ("dq_day_of_week", dict(day_of_week=1), "isodow({d}) = 1"),
    (
        "dq_day_combined",
        dict(day_of_month=1, day_of_week=7),
        "day({d}) = 1 and isodow({d}) = 7",
    ),
):
    add(
        name,
        ORDERS,
        [("column_values_to_be_specific_day", dict(column="order_date", **kwargs))],
        row_result(
            "column_values_to_be_specific_day", ORDERS, good.format(d=f"({day('order_date')})"), "order_date is null"
        ),
    )
add(
    "dq_gt_100",
    ORDERS,
    [("column_values_to_be_greater_than_one_hundred", dict(column="price", mostly=0.9))],
    row_result(
        "column_values_to_be_greater_than_one_hundred",
        ORDERS,
        "price > 100",
        mostly=0.9,
        percent="fraction",
        ratio=True,
    ),
)
add(
    "dq_mostly",
    ORDERS,
    [
        ("column_values_to_be_in_set", dict(column="status", value_set=["F", "O", "P"], mostly=share, rule_id=name))
        for name, share in (("loose", 0.95), ("tight", 0.999))
    ]
    + [("column_values_to_not_be_null", dict(column="status", row_condition="o_orderkey < 0", rule_id="nothing"))],
    union(
        *[
            row_result(
                "column_values_to_be_in_set",
                ORDERS,
                "status in ('F', 'O', 'P')",
                "status is null",
                mostly=share,
                rule_id=name,
            )
            for name, share in (("loose", 0.95), ("tight", 0.999))
        ],
        row_result(
            "column_values_to_not_be_null", ORDERS, "status is not null", domain="o_orderkey < 0", rule_id="nothing"
        ),
    ),
)

# -- row conditions -------------------------------------------------------

add(
    "rowcond_between",
    ORDERS,
    [
        (
            "column_values_to_be_between",
            dict(
                column="price", min_value=50000, row_condition='status IN ("F", "O")', condition_parser="spark"
            ),
        )
    ],
    row_result(
        "column_values_to_be_between", ORDERS, "price >= 50000", "price is null", domain="status in ('F', 'O')"
    ),
)
add(
    "rowcond_not_null",
    ORDERS,
    [
        (
            "column_values_to_not_be_null",
            dict(column="price", row_condition='status IN ("F", "O")', condition_parser="spark"),
        )
    ],
    row_result("column_values_to_not_be_null", ORDERS, "price is not null", domain="status in ('F', 'O')"),
)
add(
    "rowcond_index",
    ORDERS,
    [
        (
            "column_values_to_meet_date_condition",
            {**DATED, "row_condition": "o_orderkey > -1", "condition_parser": "pandas"},
        )
    ],
    row_result(
        "column_values_to_meet_date_condition", ORDERS, SINCE, "order_date is null", domain="o_orderkey > -1"
    ),
)

# The same rule under conditions as ``DataFrame.query`` takes them, and what they say in SQL.
PANDAS = [
    ("o_orderkey > 500 and status == 'F'", "o_orderkey > 500 and coalesce(status = 'F', false)"),
    ("status != 'O' & ~(price > 1e5)", "coalesce(status <> 'O', true) and not coalesce(price > 1e5, false)"),
    ("`status` in ['F', \"P\"] or price.isnull()", "coalesce(status in ('F', 'P'), false) or price is null"),
    ("status not in ('F',) and 1000 <= price < 200000", "coalesce(status <> 'F', true) and price >= 1000 and price < 200000"),
    ("price.notna() | priority.str.startswith('1-')", "price is not null or coalesce(starts_with(priority, '1-'), false)"),
    ("not (price * 2 + 1 > 100000 and o_orderkey % 2 == 0)", "not (coalesce(price * 2 + 1 > 100000, false) and o_orderkey % 2 = 0)"),
    ("status == ['F', 'O'] and price.between(1000, 150000)", "coalesce(status in ('F', 'O'), false) and price between 1000 and 150000"),
    ("priority.str.contains('URG|LOW') and status.isin(['X', None])", "coalesce(regexp_matches(priority, 'URG|LOW'), false) and (status = 'X' or status is null)"),
]
add(
    "rowcond_pandas",
    ORDERS,
    [
        (
            "column_values_to_meet_date_condition",
            {**DATED, "row_condition": given, "condition_parser": "pandas", "rule_id": f"p{i}"},
        )
        for i, (given, _) in enumerate(PANDAS)
    ],
    union(
        *[
            row_result(
                "column_values_to_meet_date_condition",
                ORDERS,
                SINCE,
                "order_date is null",
                domain=f"coalesce({sql}, false)",
                rule_id=f"p{i}",
            )
            for i, (_, sql) in enumerate(PANDAS)
        ]
    ),
)

# -- two and more columns -------------------------------------------------

PAIR = dict(column_A="receipt_date", column_B="ship_date")
BOTH_DATES = "receipt_date is not null and ship_date is not null"
DAYS = f"({day('receipt_date')}) - ({day('ship_date')})"
add(
    "dq_days_diff",
    LINES,
    [
        ("column_pair_days_diff_to_meet_condition", {**PAIR, "operator": ">=", "days": 0}),
        ("column_pair_days_diff_to_meet_condition", {**PAIR, "operator": "==", "days": -2, "rule_id": "two_before"}),
    ],
    union(
        row_result("column_pair_days_diff_to_meet_condition", LINES, f"{DAYS} >= 0", domain=BOTH_DATES),
        row_result(
            "column_pair_days_diff_to_meet_condition", LINES, f"{DAYS} = -2", domain=BOTH_DATES, rule_id="two_before"
        ),
    ),
)
COUNTED = dict(column_A="quantity", column_B="counted")
BOTH_COUNTS = "quantity is not null and counted is not null"
EQUAL = "quantity = try_cast(counted as double)"
add(
    "dq_pair_compare",
    LINES,
    [("column_pair_values_to_meet_compare_condition", {**COUNTED, "operator": ">="})],
    row_result(
        "column_pair_values_to_meet_compare_condition",
        LINES,
        "quantity >= try_cast(counted as double)",
        domain=BOTH_COUNTS,
    ),
)
add(
    "dq_pair_compare_nfn",
    LINES,
    [("column_pair_values_to_meet_compare_condition_nfn", {**COUNTED, "operator": ">="})],
    row_result(
        "column_pair_values_to_meet_compare_condition_nfn", LINES, "quantity >= try_cast(counted as double)"
    ),
)
add(
    "dq_pair_equal",
    LINES,
    [("column_pair_values_to_be_equal", COUNTED)],
    row_result(
        "column_pair_values_to_be_equal", LINES, EQUAL, domain="quantity is not null or counted is not null"
    ),
)
add(
    "ignore_pair_modes",
    LINES,
    [
        ("column_pair_values_to_be_equal", {**COUNTED, "ignore_row_if": mode, "rule_id": mode})
        for mode in ("both_values_are_missing", "either_value_is_missing", "neither")
    ],
    union(
        *[
            row_result("column_pair_values_to_be_equal", LINES, EQUAL, domain=domain, rule_id=mode)
            for mode, domain in (
                ("both_values_are_missing", "quantity is not null or counted is not null"),
                ("either_value_is_missing", BOTH_COUNTS),
                ("neither", "true"),
            )
        ]
    ),
)
SUMMED = dict(column_list=["quantity", "discount", "l_linenumber"], value=30)
ANY = "quantity is not null or discount is not null or l_linenumber is not null"
ALL = "quantity is not null and discount is not null and l_linenumber is not null"
SUM = "quantity + discount + l_linenumber = 30"
add(
    "dq_multi_sum",
    LINES,
    [("multicolumn_sum_to_equal", SUMMED)],
    row_result("multicolumn_sum_to_equal", LINES, SUM, domain=ANY),
)
add(
    "ignore_multi_modes",
    LINES,
    [
        ("multicolumn_sum_to_equal", {**SUMMED, "ignore_row_if": mode, "rule_id": mode})
        for mode in ("all_values_are_missing", "any_value_is_missing", "never")
    ],
    union(
        *[
            row_result("multicolumn_sum_to_equal", LINES, SUM, domain=domain, rule_id=mode)
            for mode, domain in (
                ("all_values_are_missing", ANY),
                ("any_value_is_missing", ALL),
                ("never", "true"),
            )
        ]
    ),
)
NET = dict(column_list=["l_extendedprice", "discount", "net_price"], expr="{0}*(1-{1})")
NETS = "l_extendedprice is not null and discount is not null and net_price is not null"
NEAR = "abs(l_extendedprice * (1 - discount) - net_price) < 0.01"
add(
    "dq_arithmetic",
    LINES,
    [
        ("columns_arithmetic_to_equals_result_column", NET),
        (
            "columns_arithmetic_to_equals_result_column",
            dict(
                column_list=["quantity", "discount", "l_linenumber", "net_price"],
                expr="({0}+{2})/({1}*100)-{2}",
                tolerance=50000,
                rule_id="division",
            ),
        ),
    ],
    union(
        row_result("columns_arithmetic_to_equals_result_column", LINES, NEAR, domain=NETS),
        row_result(
            "columns_arithmetic_to_equals_result_column",
            LINES,
            "discount <> 0 and"
            " abs((quantity + l_linenumber) / nullif(discount * 100, 0) - l_linenumber - net_price) < 50000",
            domain="quantity is not null and discount is not null and net_price is not null",
            rule_id="division",
        ),
    ),
)
add(
    "dq_arithmetic_nfn",
    LINES,
    [("columns_arithmetic_to_equals_result_column_nfn", NET)],
    row_result("columns_arithmetic_to_equals_result_column_nfn", LINES, NEAR),
)
add(
    "dq_arithmetic_v1",
    LINES,
    [
        (
            "columns_arithmetic_to_equals_result_column_v1",
            dict(
                left_column="l_extendedprice",
                right_column="discount",
                result_column="net_price",
                operator="*",
                tolerance=20000,
                column_list=["l_extendedprice", "discount", "net_price"],
            ),
        )
    ],
    row_result(
        "columns_arithmetic_to_equals_result_column_v1",
        LINES,
        "abs(l_extendedprice * discount - net_price) < 20000",
        domain=NETS,
    ),
)

# -- rules of one's own ---------------------------------------------------


@column_rule("expect_column_values_to_be_whole", nulls="skip")
def whole(field):
    return F.floor(field.col) == field.col


@pair_rule("expect_column_pair_to_differ", ignore_row_if="neither", by=0)
def differ(a, b, by):
    return f"abs({a} - {b}) > {by}"


@multi_rule("expect_columns_to_be_filled", ignore_row_if="never")
def filled(fields):
    return " AND ".join(f"{f} IS NOT NULL" for f in fields)


@table_rule("expect_distinct_share_to_be_below", share=1.0)
def distinct_share(df, column, share):
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("element_count"), F.count(column).alias("distinct")
    )
    observed = (F.col("distinct") / F.col("element_count")).alias("observed_value")
    return sizes.select("element_count", observed, (observed < F.lit(share)).alias("success"))


RULES["expect_columns_to_be_filled"].derive("expect_columns_to_be_filled_if_any", ignore_row_if="all_values_are_missing")

add(
    "plugin_rules",
    LINES,
    [
        ("column_values_to_be_whole", dict(column="quantity")),
        ("column_pair_to_differ", dict(column_A="quantity", column_B="l_linenumber", by=3)),
        ("columns_to_be_filled", dict(column_list=["quantity", "discount"])),
        ("columns_to_be_filled_if_any", dict(column_list=["quantity", "discount"])),
        ("distinct_share_to_be_below", dict(column="l_partkey", share=0.5)),
    ],
    union(
        row_result("column_values_to_be_whole", LINES, "floor(quantity) = quantity", "quantity is null"),
        row_result("column_pair_to_differ", LINES, "abs(quantity - l_linenumber) > 3", **ID2),
        row_result("columns_to_be_filled", LINES, "quantity is not null and discount is not null", **ID3),
        row_result(
            "columns_to_be_filled_if_any",
            LINES,
            "quantity is not null and discount is not null",
            domain="quantity is not null or discount is not null",
            rule_id="rule_004",
        ),
        """
select 'rule_005' as rule_id, 'expect_distinct_share_to_be_below' as expectation_type,
       count(distinct l_partkey)::double / count(*) < 0.5 as success, count(*) as element_count,
       null::bigint as missing_count, null::bigint as unexpected_count, null::double as unexpected_percent,
       round(count(distinct l_partkey)::double / count(*), 6) as observed_value
from lineitem""",
    ),
)
