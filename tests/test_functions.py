import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.arithmetic import arithmetic
from assayer.functions.conditions import as_date, as_double, member
from assayer.functions.pandastext import pandas_condition
from assayer.functions.sqltext import Field, ident, literal, quote
from assayer.functions.timeformats import is_parseable, matches_strftime

TEXTS = [
    "2024-02-29",
    "2023-02-29",
    "2024-2-9",
    "2024-13-01",
    "2024-01-32",
    "20240131",
    "20240230",
    "31.12.2024",
    "31.11.2024",
    "12/31/2024",
    "2/30/2024",
    "31 Dec 2024",
    "31 nov 2024",
    "May 5, 2024",
    "February 30, 2024",
    "2024-02-29 23:59:59",
    "2024-02-29 24:00:00",
    "23:15",
    "24:15",
    "29/02/24",
    "29/02/23",
    "02-29",
    "02-28",
    "2024-02-29\n",
    "abc",
    "",
    "11:30 pm",
    "13:30 pm",
]


def ask(spark, texts, sql):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(F.coalesce(F.expr(sql), F.lit(False))).collect()]


@pytest.mark.parametrize(
    "pattern",
    ["%Y-%m-%d", "%Y%m%d", "%d.%m.%Y", "%m/%d/%Y", "%d %b %Y", "%B %d, %Y", "%Y-%m-%d %H:%M:%S", "%H:%M"]
    + ["%d/%m/%y", "%m-%d", "%I:%M %p", "%Y-%m"],
)
def test_strftime_agrees_with_python(spark, pattern):
    def python(text):
        try:
            dt.datetime.strptime(text, pattern)
            return True
        except ValueError:
            return False

    assert ask(spark, TEXTS, matches_strftime("t", pattern)) == [python(t) for t in TEXTS]


def test_unknown_directive():
    with pytest.raises(ValueError, match="%Q"):
        matches_strftime("t", "%Y %Q")


def test_parseable(spark):
    layouts = ["%Y%m%d", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%d.%m.%Y", "%Y/%m/%d %H:%M"]
    layouts += ["%m/%d/%Y %H:%M:%S", "%Y%m%d%H%M%S", "%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%b %d %Y"]
    good = [dt.datetime(2024, 2, 29, 13, 5, 7).strftime(layout) for layout in layouts]
    good += ["2024-02-29", "2024-02", "2024", "2024-02-29T13:05:07Z", "2024-02-29 13:05:07.123"]
    bad = ["abc", "2024-02-30", "30.02.2024", "", "2024-13-01", "19-96x"]
    assert ask(spark, good, is_parseable("t")) == [True] * len(good)
    assert ask(spark, bad, is_parseable("t")) == [False] * len(bad)


def test_dates_are_strict(spark):
    texts = ["2024-02-29", "2024-2-29", "2024-02-29 ", " 2024-02-29", "2024-02-29T00:00:00", "2024-02", "2024-02-29\n"]
    sql = f"({as_date(Field('t', T.StringType()))}) IS NOT NULL"
    assert ask(spark, texts, sql) == [True] + [False] * 6


def test_numbers(spark):
    texts = ["190.", "1e3", "-4", "abc", "", " "]
    sql = f"{as_double(Field('t', T.StringType()))} IS NOT NULL"
    assert ask(spark, texts, sql) == [True, True, True, False, False, False]


def test_quoting(spark):
    odd = "it's a \\ `test` \"x\""
    df = spark.createDataFrame([(odd,)], T.StructType([T.StructField("a`b c", T.StringType())]))
    assert df.filter(f"{ident('a`b c')} = {quote(odd)}").count() == 1
    assert df.filter(member(Field("a`b c", T.StringType()), [odd, None])).count() == 1


@pytest.mark.parametrize("value", [5, -3, 2.5, True, "x'y", dt.date(2024, 1, 2), 2**70])
def test_literals(spark, value):
    assert spark.range(1).select(F.expr(literal(value))).collect()[0][0] == value


@pytest.mark.parametrize(
    "template, expected",
    [("{0}+{1}", 9.0), ("({0}+{1})*{2}-{3}", 13.0), ("-{0}/{1}", -1.25), ("{0}*(1-{1})", -15.0), ("{0}/({1}-4)", None)],
)
def test_arithmetic(spark, template, expected):
    row = spark.range(1).select(F.expr(arithmetic(template, ["5D", "4D", "2D", "5D"]))).collect()[0]
    assert row[0] == expected


@pytest.mark.parametrize("template", ["__import__('os')", "{0}**2", "{0}.x", "{0}+{9}", "{0}+", "f({0})", "{0} if {1} else 1"])
def test_arithmetic_refuses(template):
    with pytest.raises(ValueError):
        arithmetic(template, ["a", "b"])


# Read by dateutil, or not.
WRITTEN = [
    "08-Sep-2024", "Sep 8", "September 2024", "Sunday, September 8, 2024", "8 Sept 2024", "9/8/24", "10:30 PM",
    "20240908T101112", "Mon Sep  9 10:11:12 2024", "2024-09-08", "2024-09-08T10:11:12Z", "2024/9/8", "8.9.2024",
    "Sep 8, 2024 10:30", "8th of September 2024", "20240908", "2024-09", "Feb 29, 2024", "29/02/2024", "31/12/1999",
    "12/31/1999 23:59:59", "2024 Sep 8", "10:11", "Sep", "Friday", "2024-09-08 10:11:12.123 +02:00", "1 May 99",
    "30 Feb 2024", "31 Sep 2024", "2024-13-01", "abc", "2024-02-30", "32/01/2024", "25:00", "10:61", "Feb 29, 2023",
    "31/11/2024", "Septober 8", "13:00 PM", "20241301", "n/a", "12.5.x",
]


@pytest.mark.parametrize("text", WRITTEN)
def test_written_dates_as_dateutil_reads_them(spark, text):
    from dateutil import parser

    try:
        parser.parse(text)
        good = True
    except (ValueError, OverflowError):
        good = False
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(f"{is_parseable('t')} as good").first().good == good


@pytest.mark.parametrize("pattern,good,bad", [
    ("%A, %d %B %Y", "Sunday, 08 September 2024", "Someday, 08 September 2024"),
    ("%a %j %Y", "Sun 252 2024", "Sun 367 2024"),
    ("%Y-%m-%d %T", "2024-09-08 10:11:12", "2024-09-31 10:11:12"),
])
def test_more_directives(spark, pattern, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "t string")
    assert [r[0] for r in df.selectExpr(matches_strftime("t", pattern)).collect()] == [True, False]


@pytest.mark.parametrize(
    "text,kept",
    [
        ("index > -1", [1, 2, 3, 4]),
        ("x > 1", [2]),
        ("x != 2", [1, 3, 4]),
        ("not x > 1 and index < 4", [1, 3]),
        ("0.5 < x <= 2 | t == 'it\\'s `x` & y'", [1, 2, 3]),
        ("`odd name` in [1, 2.0] & t.notnull()", [1]),
        ("t not in ['a']", [2, 3, 4]),
        ("flag", [1]),
        ("~flag", [2, 3, 4]),
        ("x * 2 - 1 == 1 or x / 0 > 1 or -index % 3 == 1", [1, 2]),
        ("x.isin([None, 1]) and not t.str.endswith('y')", [1, 4]),
    ],
)
def test_conditions_for_pandas(spark, text, kept):
    df = spark.createDataFrame(
        [(1, 1.0, "a", 1, True), (2, 2.0, None, 2, False), (3, float("nan"), "it's `x` & y", 3, None), (4, None, "b", None, None)],
        "index int, x double, t string, `odd name` int, flag boolean",
    )
    assert sorted(r["index"] for r in df.filter(pandas_condition(text, df.schema)).collect()) == kept
    import pandas as pd

    plain = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)
    if not any(x in text for x in ("flag", "/ 0", "endswith")):  # pandas itself stumbles over those with None
        assert sorted(plain.query(text.replace("\n", " "), engine="python")["index"]) == kept


@pytest.mark.parametrize("text", ["__import__('os')", "x.sum() > 1", "x > @y", "nowhere > 1", "x", "x + 1", "[1] < x", "x if t else t"])
def test_conditions_for_pandas_that_are_refused(spark, text):
    schema = spark.range(1).selectExpr("1.5D as x", "'a' as t").schema
    if text == "x":
        assert pandas_condition(text, schema) == "coalesce(nanvl(`x`, NULL), false)"
        return
    with pytest.raises((ValueError, KeyError, SyntaxError)):
        pandas_condition(text, schema)
