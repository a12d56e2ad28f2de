"""Joins with one row per key on one side, for keys of any frequency on the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(rows: DataFrame, found: DataFrame, key: str, found_key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``found`` on ``key = found_key``, such that the rows of a frequent key can be split.

    Adaptive execution splits a large partition of a join only if both sides
    come straight from shuffles that the join asked for.  A side that has just
    been aggregated by the key comes from the aggregation's shuffle instead.
    The key's hash as a second key makes the join ask for its own; the side
    with one row per key is the small one to move.  Rows without a key don't
    meet any, so with ``how="left"`` leave them out and add them back.
    """
    same = (F.col(key) == F.col(found_key)) & (F.xxhash64(key) == F.xxhash64(found_key))
    return rows.join(found, same, how)
