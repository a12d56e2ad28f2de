"""Validation results and offending rows in storage, one partition per run."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .session import remove_folder

# The signs that Spark escapes in the folder names of partitions.
RESERVED = "\"#%'*/:=?\\{[]^"

RESULTS_SCHEMA = (
    "suite string, position int, rule_id string, expectation_type string, column_list array<string>, "
    "kwargs map<string,string>, meta map<string,string>, success boolean, element_count bigint, "
    "missing_count bigint, missing_percent double, unexpected_count bigint, unexpected_percent double, "
    "unexpected_percent_total double, unexpected_percent_nonmissing double, observed_value double, "
    "partial_unexpected_list array<string>, partial_unexpected_index_list array<map<string,string>>, "
    "partial_unexpected_counts array<struct<value:string,count:bigint>>, unexpected_index_query string, "
    "raised_exception boolean, exception_message string, exception_traceback string, run_time timestamp, run_id string"
)


RUNS = "_runs"  # the index of a results dataset; Spark's readers of the dataset pass names with _ over
RUNS_SCHEMA = "suite string, run_time timestamp, run_id string"


def write_results(results: DataFrame, path: str) -> None:
    """Store a run in a JSON dataset, below ``run_id=<run>``, in the place of what that run has there.

    Spark puts the run's files in place when all are written, and the run's
    row in the index comes last: a run that the index names is there as a whole.
    """
    seen = Observation()
    runs = F.collect_set(F.struct("suite", "run_time", F.col("run_id").cast("string").alias("run_id")))
    # A few rows, one per rule: one file is enough.
    single = results.repartition(1).observe(seen, runs.alias("runs"))
    _replace_runs(single).option("ignoreNullFields", False).json(path)
    known = results.sparkSession.createDataFrame([tuple(r) for r in seen.get["runs"]], RUNS_SCHEMA)
    _replace_runs(known.repartition(1)).json(f"{path}/{RUNS}")


def _replace_runs(rows: DataFrame) -> DataFrameWriter:
    """A writer that replaces the partitions of the runs it writes and no others."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")


def read_results(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """All stored runs, or one; only that run's folder is then read."""
    stored = spark.read.schema(RESULTS_SCHEMA).json(path)
    return stored if run_id is None else stored.filter(stored.run_id == run_id)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index of a results dataset: ``suite``, ``run_time`` and ``run_id`` of each run."""
    return spark.read.schema(RUNS_SCHEMA).json(f"{path}/{RUNS}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The results of the last run of each suite; of runs at one time, that with the greatest id.

    The index says which runs these are, one row for each suite; only their
    folders are read, however many runs there are.
    """
    newest = read_runs(spark, path).groupBy("suite").agg(F.max(F.struct("run_time", "run_id")).alias("newest"))
    last = [(r["suite"], r["newest"]["run_id"]) for r in newest.collect()]
    stored = read_results(spark, path).filter(F.col("run_id").isin(sorted({run for _, run in last})))
    return stored.filter(reduce(or_, [(F.col("suite") == s) & (F.col("run_id") == r) for s, r in last], F.lit(False)))


def write_violations(violations: DataFrame, path: str, run_id: str | None = None) -> None:
    """Store a run's offending rows, all of them, in a Parquet dataset below ``run_id=<run>``.

    They take the place of the rows the run has there.  If none are left, only
    ``run_id`` can say which run's rows are to go; name it where a run may be
    repeated on other data.
    """
    seen = Observation()
    _replace_runs(violations.observe(seen, F.count(F.lit(1)).alias("n"))).parquet(path)
    if run_id is not None and seen.get["n"] == 0:
        remove_folder(violations.sparkSession, f"{path}/run_id={_folder(run_id)}")


def _folder(value: str) -> str:
    """A value as Spark writes it in a partition's folder name."""
    return "".join(f"%{ord(c):02X}" if c in RESERVED or ord(c) < 32 or ord(c) == 127 else c for c in value)


def read_violations(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The stored offending rows of all runs, or of one; only that run's folder is then read."""
    stored = spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))
    return stored if run_id is None else stored.filter(F.col("run_id") == run_id)


def stored_report(results: DataFrame, violations: DataFrame) -> DataFrame:
    """The report of one stored run, from its results and offending rows; the table itself is not needed.

    As in ``Validation.report``: every offending row with a pass flag of its
    business rule, and one row without a value for each clean check.
    """
    head = ["rule_id", "expectation_type", "column"]
    checks = results.select(
        "rule_id",
        F.coalesce(F.col("meta")["Rule"], F.col("rule_id")).alias("rule"),
        "expectation_type",
        F.array_join("column_list", ", ").alias("column"),
        (F.col("unexpected_count").isNotNull() | F.col("success")).alias("fine"),
    )
    dirty = violations.select(*head).distinct().withColumn("dirty", F.lit(True))
    flags = checks.join(dirty, head, "left").withColumn("clean", F.col("fine") & F.col("dirty").isNull())
    flags = flags.withColumn("pass", F.every("clean").over(Window.partitionBy("rule")))
    marks = flags.select(*head, "pass")
    # One row per rule, so the flags are a small side by their nature.
    hit = violations.drop("run_id").join(F.broadcast(marks), head)
    clean = flags.filter("clean").select(*head, "rule", "pass")
    return hit.unionByName(clean, allowMissingColumns=True)
