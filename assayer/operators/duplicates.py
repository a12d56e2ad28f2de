"""Repeated values: how many rows hold one, and which rows they are, for any number of rules at once.

Each row of the table gives one item for each rule: the rule's number and the
value, in a column for the value's type.  The items of all rules share one
scan and one exchange, in which the counts are combined first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import Field, Predicate, as_column, ident
from .joins import lookup_join

# Without keys, a value is written out by tasks of so many rows each.
PIECE_ROWS = 1_000_000


@dataclass(frozen=True)
class Unique:
    """A rule that a column's values be unique among the rows of its domain."""

    position: int
    field: Field
    domain: Predicate | None = None


def comparable(dtype: T.DataType) -> bool:
    """Whether values of this type can be told apart in an exchange."""
    if isinstance(dtype, T.ArrayType):
        return comparable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(comparable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _slots(rules: list[Unique]) -> dict[str, str]:
    """A column for each type among the rules' values."""
    kinds = dict.fromkeys(rule.field.dtype.simpleString() for rule in rules)
    return {kind: f"value_{i}" for i, kind in enumerate(kinds)}


def _items(df: DataFrame, rules: list[Unique], keys: list[str], given_only: bool) -> DataFrame:
    """``position``, the value's slots and the keys; a missing value is null in all slots, or gives no item."""
    slots = _slots(rules)
    quoted = [F.col(ident(k)).alias(f"key_{i}") for i, k in enumerate(keys)]

    def item(rule: Unique) -> tuple[Column | None, list[Column]]:
        own = rule.field.dtype.simpleString()
        missing = F.expr(rule.field.missing)
        value = rule.field.col if given_only else F.when(~missing, rule.field.col)
        columns = [F.lit(rule.position).alias("position")]
        columns += [(value if kind == own else F.lit(None).cast(kind)).alias(name) for kind, name in slots.items()]
        kept = [] if rule.domain is None else [F.coalesce(as_column(rule.domain), F.lit(False))]
        kept += [~missing] if given_only else []
        return (kept[0] & kept[1] if len(kept) == 2 else kept[0] if kept else None), columns

    if len(rules) == 1:  # a plain filter, which can reach the scan
        kept, columns = item(rules[0])
        return (df if kept is None else df.filter(kept)).select(*columns, *quoted)
    made = [F.struct(*columns) if kept is None else F.when(kept, F.struct(*columns)) for kept, columns in map(item, rules)]
    listed = df.select(*quoted, F.explode(F.array(*made)).alias("item")).filter("item is not null")
    return listed.select("item.*", *[f"key_{i}" for i in range(len(keys))])


def duplicate_counts(df: DataFrame, rules: list[Unique]) -> DataFrame:
    """One row per rule: position, element_count, missing_count, unexpected_count.

    The shuffle carries one row per rule, distinct value and map task, since
    the counts are combined before it; a frequent value is no burden.
    """
    slots = list(_slots(rules).values())
    sizes = _items(df, rules, [], given_only=False).groupBy("position", *slots).agg(F.count(F.lit(1)).alias("n"))
    given = F.coalesce(*[F.when(F.col(s).isNotNull(), True) for s in slots], F.lit(False))
    counts = sizes.groupBy("position").agg(
        F.sum("n").alias("element_count"),
        F.sum(F.when(~given, F.col("n")).otherwise(0)).alias("missing_count"),
        F.sum(F.when(given & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("unexpected_count"),
    )
    # One row per rule from here; a rule none of whose rows are there has one too.
    names = ("element_count", "missing_count", "unexpected_count")
    met = counts.agg(F.map_from_entries(F.collect_list(F.struct("position", F.struct(*names).alias("seen")))).alias("met"))
    rows = []
    for rule in rules:
        values = [f"'{n}', coalesce(met[{rule.position}].{n}, 0L)" for n in names]
        rows.append(f"named_struct('position', {rule.position}, {', '.join(values)})")
    return met.select(F.expr(f"inline(array({', '.join(rows)}))"))


def duplicate_rows(df: DataFrame, rules: list[Unique], keys: list[str]) -> DataFrame:
    """The rows that hold a repeated value: ``position``, ``value`` as text and the keys, for each rule.

    A semi join brings the repeated values back to their rows.  Each value is
    one row on its right side, however often it occurs, so where the rows of
    frequent values make a partition large, adaptive execution splits it and
    pairs each part with that side; no list of frequent values is needed.
    """
    slots = list(_slots(rules).values())
    items = _items(df, rules, keys, given_only=True)
    sizes = items.groupBy("position", *slots).agg(F.count(F.lit(1)).alias("n"))
    repeated = sizes.filter("n > 1")
    if keys:
        item = F.struct("position", *slots)
        found = repeated.select(item.alias("repeated"))
        rows = items.select(item.alias("item"), *[f"key_{i}" for i in range(len(keys))])
        rows = lookup_join(rows, found, "item", "repeated", "left_semi").select("item.*", "*")
    else:
        rows = _repeat(repeated, slots)
    value = F.coalesce(*[F.col(s).cast("string") for s in slots])
    return rows.select("position", value.alias("value"), *[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)])


def _repeat(repeated: DataFrame, slots: list[str]) -> DataFrame:
    """Each value as often as it occurs; without keys the rows need not be fetched.

    A frequent value is written out by many tasks, PIECE_ROWS rows each.
    """
    pieces = repeated.withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {PIECE_ROWS})")))
    spread = pieces.repartition("position", *slots, "piece")
    size = f"least({PIECE_ROWS}L, n - piece * {PIECE_ROWS})"
    return spread.select("position", *slots, F.explode(F.expr(f"sequence(1L, {size})")).alias("i"))
