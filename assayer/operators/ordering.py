"""Rows whose value falls below the value before them, by one exchange into ranges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import ident


def falling_rows(
    df: DataFrame, value: Column, missing: Column, order_by: str, keys: list[str], ranges: int | None = None
) -> DataFrame:
    """Rows whose value is below the previous one, as ``value`` and the keys.

    Rows are taken in the order of ``order_by``, nulls first, equal ones by
    value; missing values are left out.  Spark deals the rows out into ranges
    of about equal size when the plan runs, as many as it has shuffle
    partitions (or ``ranges``), and sorts each.  The value is part of the
    range, and so are the keys and the number of the task a row comes from, so
    that rows of one order key, even of one value, need not stay together:
    where they are cut apart changes nothing.

    A task reads its range once, and compares each row with the one before.
    It gives the rows that fall, and one row with the range's first row and
    last value; those, one for each range, meet in a window.
    """
    _check(df.schema[order_by].dataType)
    key_columns = [f"key_{i}" for i in range(len(keys))]
    rows = df.filter(~missing).select(
        F.col(ident(order_by)).alias("ordinal"),
        value.alias("low"),
        *[F.col(ident(k)).alias(c) for k, c in zip(keys, key_columns)],
    )
    orderable = [c for c in key_columns if not isinstance(rows.schema[c].dataType, (T.MapType, T.VariantType))]
    place = ["ordinal", "low", *orderable]
    numbered = rows.withColumn("task", F.spark_partition_id())
    dealt = numbered.repartitionByRange(*([ranges] if ranges else []), *place, "task").sortWithinPartitions(*place)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        number = TaskContext.get().partitionId()

        def told(batch: pa.RecordBatch, end, is_end: bool) -> pa.RecordBatch:
            n = batch.num_rows
            about = [pa.array([number] * n, pa.int32()), pa.array([is_end] * n, pa.bool_())]
            ends = pa.array([end] * n, batch.schema.field("low").type)
            return pa.RecordBatch.from_arrays([*about, ends, *batch.columns], ["range", "is_end", "end", *batch.schema.names])

        for batch in batches:
            if not batch.num_rows:
                continue
            low = batch.column(0)
            before = pa.concat_arrays([pa.array([low[0] if last is None else last], low.type), low.slice(0, len(low) - 1)])
            yield told(batch.filter(pc.less(low, before)), None, False)
            first, last = first or batch.slice(0, 1), low[len(low) - 1]
        if first:
            yield told(first, last, True)

    given = dealt.select("low", *key_columns)
    fields = [T.StructField("range", T.IntegerType()), T.StructField("is_end", T.BooleanType())]
    fields.append(T.StructField("end", given.schema["low"].dataType))
    found = given.mapInArrow(compare, T.StructType([*fields, *given.schema.fields]))
    # The ends share a lane, one row for each range; falls stay in lanes of their ranges.
    lane = F.when(F.col("is_end"), -1).otherwise(F.col("range"))
    before = F.lag("end").over(Window.partitionBy("lane").orderBy("range"))
    falls = found.withColumn("lane", lane).withColumn("before", before).filter(~F.col("is_end") | (F.col("low") < F.col("before")))
    return falls.select(F.col("low").alias("value"), *[F.col(c).alias(k) for c, k in zip(key_columns, keys)])


def _check(dtype: T.DataType) -> None:
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType)):
        raise ValueError(f"order_by must be a number, date or timestamp, not {dtype.simpleString()}")
