"""The bounded lists of a result: the first offending rows of each rule, and its most frequent values.

Both come from one pass over the offending rows.  A task keeps, for each rule,
the first rows by key seen so far and the counts of the values, and hands on
only these: as many rows as a list is long, and one row per value.  Spark has
no aggregate function that keeps the least k rows, so the tasks work on Arrow
batches; what they hand on is combined by one exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Arrow can sort and group as Spark does.
ATOMIC = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.StringType,
    T.BinaryType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
# Values of so many rows are put together to counts, which are handed on if half as many are left.
HELD = 20_000

FLAGS, POSITION, COUNT, TIE = "__flags", "__position", "__count", "__tie"
FIRST, FREQUENT = 0, 1


def condensed(flagged: DataFrame, rules: Mapping[int, list[str]], keys: list[str], limit: int, counting: bool) -> DataFrame:
    """From rows with the numbers of the rules that list them: what the lists need of them.

    ``flagged`` has the keys, the columns of the rules, and in FLAGS an array
    of rule numbers, never empty.  The result has the same columns without
    FLAGS and with POSITION, COUNT and TIE: rows without a count are the first
    ones of their task, by the keys and then by TIE, a hash of the row; rows
    with a count have a rule's columns, and say how often they are listed.
    """
    columns = [c for c in flagged.columns if c != FLAGS]
    number = {c: f"c{i}" for i, c in enumerate(columns)}
    order = [(number[k], "ascending") for k in keys] + [("tie", "ascending")]
    own = {position: [number[c] for c in dict.fromkeys(used)] for position, used in rules.items()}
    tie = F.xxhash64(*[F.col(_quoted(c)) for c in columns])
    given = flagged.select(*[F.col(_quoted(c)).alias(n) for c, n in number.items()], tie.alias("tie"), FLAGS)
    listing = bool(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, list[pa.Table]] = {}
        counts: dict[int, list[pa.Table]] = {}
        names, types = None, None

        def least(table: pa.Table) -> pa.Table:
            options = pc.SortOptions(sort_keys=order, null_placement="at_end")
            return table.take(pc.sort_indices(table, options=options)[:limit])

        def summed(tables: list[pa.Table], position: int) -> pa.Table:
            grouped = pa.concat_tables(tables).group_by(own[position]).aggregate([("n", "sum")])
            return grouped.rename_columns([*own[position], "n"])

        def told(position: int, table: pa.Table, n: pa.ChunkedArray | None) -> Iterator[pa.RecordBatch]:
            rows = table.num_rows
            made = [table.column(c) if c in table.column_names else pa.nulls(rows, t) for c, t in zip(names, types)]
            made += [pa.array(np.full(rows, position, np.int32)), pa.nulls(rows, pa.int64()) if n is None else n]
            yield from pa.table(made, names=[*names, "position", "n"]).to_batches()

        for batch in batches:
            flags = batch.column(FLAGS)
            table = pa.Table.from_batches([batch]).drop_columns([FLAGS])
            names, types = table.column_names, table.schema.types
            listed = flags.flatten().to_numpy(zero_copy_only=False)
            parents = pc.list_parent_indices(flags).to_numpy(zero_copy_only=False)
            if listing:
                options = pc.SortOptions(sort_keys=order, null_placement="at_end")
                place = np.empty(batch.num_rows, np.int64)
                place[pc.sort_indices(table, options=options).to_numpy()] = np.arange(batch.num_rows)
            for position in np.unique(listed).tolist():
                rows = parents[listed == position]
                if listing:
                    chosen = rows[np.argsort(place[rows])[:limit]]
                    held = first.setdefault(position, [])
                    held.append(table.take(chosen))
                    if sum(t.num_rows for t in held) > 20 * limit:
                        first[position] = [least(pa.concat_tables(held))]
                if counting:
                    held = counts.setdefault(position, [])
                    values = table.select(own[position]).take(rows)
                    held.append(values.append_column("n", pa.array(np.ones(len(rows), np.int64))))
                    if sum(t.num_rows for t in held) > HELD:
                        counts[position] = [summed(held, position)]
                        if counts[position][0].num_rows > HELD // 2:
                            yield from told(position, counts[position][0], counts.pop(position)[0].column("n"))
        for position, held in first.items():
            yield from told(position, least(pa.concat_tables(held)), None)
        for position, held in counts.items():
            table = summed(held, position)
            yield from told(position, table, table.column("n"))

    schema = T.StructType([f for f in given.schema.fields if f.name != FLAGS])
    schema = schema.add("position", T.IntegerType()).add("n", T.LongType())
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    back = [F.col(n).alias(c) for c, n in number.items()]
    made = given.mapInArrow(work, schema)
    return made.select(*back, F.col("position").alias(POSITION), F.col("n").alias(COUNT), F.col("tie").alias(TIE))


def bounded(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """One row per rule, ``position``, with the lists ``first`` (value and keys as text) and ``frequent`` (value and count).

    ``rows`` have position, value, count, tie and the keys, as ``condensed``
    gives them.  Without keys the first rows are those with the least values.
    """
    names = [f"key_{i}" for i in range(len(keys))]
    kept = [f"if({COUNT} IS NULL, {c}, NULL) AS {n}" for c, n in zip([TIE, *map(_quoted, keys)], ["tie", *names])]
    kind = f"if({COUNT} IS NULL, {FIRST}, {FREQUENT}) AS kind"
    given = rows.selectExpr("position", "value", kind, f"coalesce({COUNT}, 1L) AS n", *kept)
    met = given.groupBy("position", "kind", "value", "tie", *names).agg(F.expr("sum(n) AS n"))
    if not keys:
        met = met.withColumn("kind", F.expr(f"explode(array({FIRST}, {FREQUENT}))"))
    order = [f"if(kind = {FREQUENT}, -n, NULL)", *names, "tie", "value"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    ranked = met.selectExpr("*", f"row_number() OVER (PARTITION BY position, kind ORDER BY {order}) AS rank")
    row = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in names)
    row = f"named_struct('rank', rank, 'value', value, 'n', n{', ' + row if row else ''})"
    lists = ranked.filter(f"rank <= {limit}").groupBy("position").agg(
        *[F.expr(f"array_sort(collect_list(if(kind = {k}, {row}, NULL))) AS {c}") for k, c in ((FIRST, "first"), (FREQUENT, "frequent"))]
    )
    shown = ", ".join(f"'{c}', r.{c}" for c in ("value", *names))
    copies = f"transform(first, r -> array_repeat(named_struct({shown}), int(least(r.n, {limit}))))"
    return lists.selectExpr(
        "position",
        f"slice(flatten({copies}), 1, {limit}) AS first",
        "transform(frequent, r -> named_struct('value', r.value, 'count', r.n)) AS frequent",
    )


def is_atomic(dtype: T.DataType) -> bool:
    return isinstance(dtype, ATOMIC)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
