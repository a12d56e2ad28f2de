"""Rules on the table as a whole: its schema, its counts, a column statistic."""

from __future__ import annotations

from pyspark.sql import types as T

from ..functions.conditions import as_double
from ..functions.sqltext import Field
from .registry import RuleType, register

# Accepted type names besides Spark's own (``bigint``, ``LongType``).
# Whole numbers read from text become ``int`` or ``bigint`` by size, so both count as int64.
TYPE_NAMES = {
    "int64": (T.IntegerType, T.LongType),
    "int32": (T.IntegerType,),
    "int": (T.IntegerType, T.LongType),
    "float64": (T.DoubleType,),
    "float32": (T.FloatType,),
    "float": (T.FloatType, T.DoubleType),
    "object": (T.StringType,),
    "str": (T.StringType,),
    "bool": (T.BooleanType,),
    "datetime64": (T.TimestampType, T.TimestampNTZType),
    "datetime64[ns]": (T.TimestampType, T.TimestampNTZType),
}


def is_of_type(dtype: T.DataType, name: str) -> bool:
    return (
        isinstance(dtype, TYPE_NAMES.get(name, ()))
        or dtype.simpleString() == name.lower()
        or type(dtype).__name__ == name
    )


def exists(schema: T.StructType, kwargs: dict) -> tuple[bool, float | None]:
    return kwargs["column"] in schema.fieldNames(), None


def of_type(schema: T.StructType, kwargs: dict) -> tuple[bool, float | None]:
    return is_of_type(schema[kwargs["column"]].dataType, kwargs["type_"]), None


def column_count(schema: T.StructType, kwargs: dict) -> tuple[bool, float | None]:
    n = len(schema.fields)
    low, high = kwargs["min_value"], kwargs["max_value"]
    return (low is None or n >= low) and (high is None or n <= high), float(n)


def row_count(field: None, domain: str | None) -> str:
    return f"count_if({domain})" if domain else "count(1)"


def mean(field: Field, domain: str | None) -> str:
    kept = f"NOT ({field.missing})" + (f" AND ({domain})" if domain else "")
    return f"avg(CASE WHEN {kept} THEN {as_double(field)} END)"


register(RuleType("expect_column_to_exist", "schema", exists))
register(RuleType("expect_column_values_to_be_of_type", "schema", of_type))
register(RuleType("expect_table_column_count_to_be_between", "schema", column_count, dict(min_value=None, max_value=None)))
register(RuleType("expect_table_row_count_to_be_between", "aggregate", row_count, dict(min_value=None, max_value=None)))
register(RuleType("expect_column_mean_to_be_between", "aggregate", mean, dict(min_value=None, max_value=None)))
