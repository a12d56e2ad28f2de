"""Shuffle rules with frequent values: split forms against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from assayer.operators import duplicates
from assayer.functions.sqltext import Field
from assayer.operators.duplicates import Unique, duplicate_counts, duplicate_rows
from assayer.operators.ordering import falling_rows


def unique(df, *columns):
    return [Unique(i, Field(c, df.schema[c].dataType)) for i, c in enumerate(columns)]


def test_repeated_values(spark):
    chance = random.Random(1)
    values = [7 if i % 3 == 0 else chance.choice([None, *range(400)]) for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int").repartition(5)
    rows = duplicate_rows(df, unique(df, "v"), ["i"]).collect()
    given = [v for v in values if v is not None]
    wanted = sorted(i for i, v in enumerate(values) if v is not None and given.count(v) > 1)
    assert sorted(r.i for r in rows) == wanted
    assert all(str(values[r.i]) == r.value for r in rows)
    counts = duplicate_counts(df, unique(df, "v")).collect()[0]
    assert tuple(counts) == (0, 3000, values.count(None), len(wanted))


def test_repeated_values_without_keys(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "PIECE_ROWS", 10)
    values = [1] * 35 + [2] * 10 + [3] * 11 + [4, None, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    rows = duplicate_rows(df, unique(df, "v"), []).collect()
    assert sorted(r.value for r in rows) == ["1"] * 35 + ["2"] * 10 + ["3"] * 11


def test_frequent_values_are_split(spark):
    """A value with most rows is split over tasks when its rows are fetched; so are many frequent ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    df = spark.range(0, 400_000, 1, 8).selectExpr("id as i", "if(id % 3 = 0, 7, id % 1500) as v")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = duplicate_rows(df, unique(df, "v"), ["i"])
        assert rows.count() == 400_000
        placed = rows.select("value", F.spark_partition_id().alias("task")).toPandas()
        assert placed[placed.value == "7"].task.nunique() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_force(rows):
    steps = sorted(((k is not None, k or 0, v, i) for i, k, v in rows if v is not None), key=lambda s: s[:3])
    return sorted((b[2], b[1] if b[0] else None) for a, b in zip(steps, steps[1:]) if b[2] < a[2])


@pytest.mark.parametrize("buckets", [1, 2, 7, 64, 400])
@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "nulls"])
def test_falls(spark, kind, buckets):
    chance = random.Random(buckets)
    keys = {
        "spread": lambda i: chance.randrange(10**6),
        "hot": lambda i: 500 if i % 3 == 0 else chance.randrange(1000),
        "constant": lambda i: 4,
        "nulls": lambda i: None if i % 3 == 0 else chance.randrange(50),
    }[kind]
    rows = [(i, keys(i), chance.choice([None, *range(30)])) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, k int, v int").repartition(4)
    falls = falling_rows(df, F.col("v"), F.col("v").isNull(), "k", ["i", "k"], ranges=buckets).collect()
    assert sorted((f.value, f.k) for f in falls) == brute_force(rows)


def test_falls_of_a_hot_key_are_shared_by_tasks(spark):
    """Half of the rows have one order key and value; they are read by several tasks, with or without keys."""
    df = spark.range(0, 40_000, 1, 8).selectExpr("id", "if(id % 2 = 0, 7, id % 1000) as k", "if(id % 2 = 0, 5, id % 3) as v")
    want = brute_force([(r.id, r.k, r.v) for r in df.collect()])
    value = F.col("v")
    for keys in (["id", "k"], ["k"], []):
        falls = falling_rows(df, value, value.isNull(), "k", keys, ranges=16)
        assert sorted(r.value for r in falls.collect()) == [v for v, _ in want]
    dealt = df.select("k", "v", F.spark_partition_id().alias("task")).repartitionByRange(16, "k", "v", "task")
    sizes = dealt.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(sizes) > 8 and sizes.max() < 8_000


def test_order_rule_starts_no_job_before_it_is_read(spark):
    df = spark.range(100).selectExpr("id as k", "id % 7 as v")
    context = spark.sparkContext
    context.setJobGroup("falls", "falls")
    falls = falling_rows(df, F.col("v"), F.col("v").isNull(), "k", ["k"])
    assert not context.statusTracker().getJobIdsForGroup("falls")
    assert falls.count() == 14
    context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("kind", ["date", "timestamp", "double", "bigint"])
def test_order_key_types(spark, kind):
    base = 2**53 if kind == "bigint" else 0
    cast = {
        "date": "date_add(DATE'2024-01-01', CAST(id AS INT))",
        "timestamp": "timestamp_micros(id)",
        "double": "CAST(id AS DOUBLE) / 3",
        "bigint": f"{base} + id",
    }[kind]
    df = spark.range(100).selectExpr(f"{cast} AS k", "CASE WHEN id % 10 = 0 THEN 0 ELSE id END AS v", "id AS i")
    falls = falling_rows(df, F.col("v"), F.col("v").isNull(), "k", ["i"], ranges=16).collect()
    assert sorted(f.i for f in falls) == list(range(10, 100, 10))


def test_text_order_key_is_refused(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="order_by"):
        falling_rows(df, F.col("v"), F.col("v").isNull(), "k", [])
