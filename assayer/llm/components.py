"""Connected components by alternating stars, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators.joins import lookup_join

from .shared import cut


def _largest_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    found = lookup_join(both.filter("b > a"), least, "a", "n")
    return found.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _smallest_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    found = lookup_join(down, least, "a", "n")
    moved = found.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    ``edges`` has two columns of one orderable type, in any direction, with
    repeats and loops allowed; rows with a null are no edges.  Each round is
    two joins on a node with one row per node on the other side, which
    adaptive execution splits when a node is hot; nothing is collected but two
    numbers.  The rounds needed grow with the logarithm of the longest chain.
    """
    first, second = edges.columns
    edges = edges.select(F.col(first).alias("a"), F.col(second).alias("b")).dropna().filter("a != b").distinct()
    edges = cut(edges)
    before = _state(edges)
    for _ in range(rounds if before[0] else 0):
        edges = cut(_smallest_star(_largest_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components not found in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
