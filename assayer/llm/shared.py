"""What the operators share: code for the workers, cutting of lineage, distributed running sums."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.sources import shared_folder

BUCKETS = 4096
_SHIPPED: set[str] = set()
_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "assayer_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)  # Spark serves it to the executors


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, without their lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return found.select(*columns) if columns else found


def order_key(column: str) -> Column:
    """A text that orders rows as if at random, alike in each run."""
    return F.md5(F.coalesce(F.col(column).cast("string"), F.lit("null")))


def running_before(df: DataFrame, by: list[str], key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same ``by`` that come before in the order of (key, order).

    ``key`` is a hexadecimal digest (see order_key).  Its first digits deal
    each group into 4,096 buckets, so that a group with a third of all rows is
    not one task; the buckets' sums, at most 4,096 rows a group, say where
    each bucket begins.
    """
    dealt = df.withColumns({"_bucket": F.substring(key, 1, 3), "_value": value})
    inside = Window.partitionBy(*by, "_bucket").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("_running", F.sum("_value").over(inside))
    sums = dealt.groupBy(*by, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_bucket").alias("_start_bucket"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    same = F.col("_bucket") == F.col("_start_bucket")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    found = dealt.join(starts, same)
    return found.withColumn(name, F.col("_start") + F.col("_running") - F.col("_value")).drop(
        "_bucket", "_value", "_running", "_start", "_start_bucket", *[f"_by_{c}" for c in by]
    )
