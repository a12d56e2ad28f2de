"""A Parquet dataset that grows by snapshots, one partition each.

For tables with updates, schema changes and several writers use a table format
through its catalog (CatalogSettings); this is plain Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, snapshot_id: int) -> None:
    """Append rows as a snapshot of their own; one that exists already is an error."""
    df.write.mode("error").parquet(f"{path}/snapshot_id={snapshot_id}")


def read_as_of(spark: SparkSession, path: str, snapshot_id: int | None = None) -> DataFrame:
    """The rows of a snapshot and all before it; of all snapshots if none is named.  Only those partitions are read."""
    stored = spark.read.parquet(path)
    if snapshot_id is not None:
        stored = stored.filter(F.col("snapshot_id") <= snapshot_id)
    return stored.drop("snapshot_id")


def snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per snapshot: its id and the rows it added.  No column is read, the counts are in the files' footers."""
    return spark.read.parquet(path).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("added"))


def previous_snapshot(spark: SparkSession, path: str) -> int | None:
    """The id of the snapshot before the last; None if there is none.  It is known from the folders' names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{path}/snapshot_id=*")
    folders = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    ids = sorted(int(f.getPath().getName().removeprefix("snapshot_id=")) for f in folders or [])
    return ids[-2] if len(ids) > 1 else None
