"""Product codes of vectors with exact arithmetic.

A vector's components become integers and are cut into equal parts; each part
is coded by its nearest entry in a codebook of its own.  The codebooks are
refined by rounds over all vectors: tasks add up the parts of each entry, and
only these sums, one row for each entry and task, are shuffled.

The nearest entry is the first that makes |entry|^2 - 2 part.entry least.  The
dot products are matrix products in float64, which are exact as long as no sum
reaches 2^53.  So integers are broken into limbs narrow enough, each pair of
limbs is multiplied by BLAS, and the products are put together in int64.  What
int64 cannot hold is worked out in Python's integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.joins import lookup_join

from .shared import cut, ship

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Bits that sums in float64 and in int64 hold exactly.
FLOAT_BITS, LONG_BITS = 53, 62
#: Cells of a table of distances that are worked out at once.
CELLS = 4_000_000


def integers(vector: Column) -> Column:
    """floor(256 * x) of each component; null if the vector is null, or a component null, not finite or beyond a long."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float(2**63), F.lit(False)))
    return F.when(fits, scaled)


def _bits(values: np.ndarray) -> int:
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0)))).bit_length()


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float matrices f with values = sum of f[i] * 2^(bits * i); all but the last are from 0 to below 2^bits."""
    found = []
    while _bits(values) > bits:
        found.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*found, values.astype(np.float64)]


def dots(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The dot products of each row with each entry, exactly; int64, or Python's integers where they may not fit."""
    width = max(1, rows.shape[1]).bit_length()
    bits = (FLOAT_BITS - width) // 2
    fits = _bits(rows) + _bits(entries) + width <= LONG_BITS
    found = np.zeros((len(rows), len(entries)), np.int64 if fits else object)
    for i, a in enumerate(limbs(rows, bits)):
        for j, b in enumerate(limbs(entries, bits)):
            product = (a @ b.T).astype(np.int64)
            found += (product if fits else product.astype(object)) * (1 << bits * (i + j))
    return found


def _squares(values: np.ndarray) -> np.ndarray:
    fits = 2 * _bits(values) + max(1, values.shape[1]).bit_length() <= LONG_BITS
    own = values if fits else values.astype(object)
    return (own * own).sum(axis=1) if values.shape[1] else np.zeros(len(values), np.int64)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row, and its squared distance."""
    norms = _squares(entries)
    chosen, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, CELLS // max(1, len(entries)))
    for some in (rows[i : i + step] for i in range(0, len(rows), step)):
        product = dots(some, entries)
        wide = product.dtype == object or norms.dtype == object or max(_bits(some), _bits(entries)) > LONG_BITS // 2 - 4
        score = norms.astype(object) - 2 * product.astype(object) if wide else norms - 2 * product
        best = score.argmin(axis=1)
        own = score[np.arange(len(some)), best]
        chosen.append(best.astype(np.int64))
        far.append(own + _squares(some))
    return np.concatenate(chosen), np.concatenate(far)


def _parts(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """The rows of a batch by their number of components, and their parts."""
    vectors = batch.column(batch.num_columns - 1)
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.r_[0, np.cumsum(lengths)][:-1]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        matrix = values[starts[rows][:, None] + np.arange(length)]
        yield rows, np.split(matrix, parts, axis=1)


def _refined(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks with each entry replaced by the floor of its parts' mean; unused entries stay."""
    n_parts, width = len(books), books[0].shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books]
        used = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for _, own in _parts(batch, n_parts):
                for part, rows in enumerate(own):
                    chosen, _ = nearest(rows, books[part])
                    total = np.zeros(books[part].shape, np.int64)
                    small = _bits(rows) + len(rows).bit_length() <= LONG_BITS
                    total = total if small else total.astype(object)
                    np.add.at(total, chosen, rows if small else rows.astype(object))
                    sums[part] += total.astype(object)
                    used[part] += np.bincount(chosen, minlength=len(books[part]))
        found = [(p, e) for p in range(n_parts) for e in np.flatnonzero(used[p]).tolist()]
        text = [[str(x) for x in sums[p][e]] for p, e in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in found], pa.int32()),
                pa.array([e for _, e in found], pa.int32()),
                pa.array([int(used[p][e]) for p, e in found], pa.int64()),
                pa.array(text, pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums"],
        )

    made = vectors.mapInArrow(work, "part int, entry int, n bigint, sums array<string>")
    columns = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    books = [b.copy() for b in books]
    # One row for each entry of each part.
    for row in made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect():
        books[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return books


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The entries of each part, from the ``vectors`` (id, values) of integers.

    They start as the parts of the vectors with the smallest ids, those
    without an id last, of equal ids those with the smaller values.
    """
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "values").limit(entries).collect()
    if not first:
        return []
    matrix = np.array([r["values"] for r in first], np.int64)
    books = np.split(matrix, parts, axis=1)
    for _ in range(rounds):
        books = _refined(vectors.select("values"), books)
    return books


def fingerprint(books: list[np.ndarray]) -> str:
    """SHA-256 of all integers in decimals, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that is kept.

    Dropped are null vectors, those with a null or non-finite component, or
    one that as an integer does not fit a long.  All kept vectors must have
    one length, which ``parts`` divides; otherwise a ValueError says so.
    Repeated rows are coded each.  An error beyond a long is null, and so is
    the error of a label that has one, or whose sum is beyond a long.
    """
    spark = df.sparkSession
    ship(spark)
    given = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{label_column}`").cast("string").alias("label"),
        integers(F.col(f"`{vector_column}`")).alias("values"),
    ).filter("values is not null")
    lengths = [r["n"] for r in given.select(F.size("values").alias("n")).distinct().limit(2).collect()]
    if len(lengths) > 1 or any(n % parts or not n for n in lengths):
        raise ValueError(f"vectors must have one length, a multiple of {parts}, not {lengths}")
    books = codebooks(given.select("id", "values"), parts, entries, rounds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), np.uint8)
            errors = np.zeros(batch.num_rows, object)
            for rows, own in _parts(batch, parts):
                for part, values in enumerate(own):
                    codes[rows, part], far = nearest(values, books[part])
                    errors[rows] += far.astype(object)
            text = [bytes(row).hex() for row in codes]
            held = [int(e) if e < 2**63 else None for e in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(held, pa.int64())],
                ["id", "label", "code", "error"],
            )

    kind = given.schema["id"].dataType.simpleString()
    coded = cut(given.mapInArrow(work, f"id {kind}, label string, code string, error bigint"))
    coded = coded.withColumn("_label", F.struct("label"))
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy("_label").agg(total.alias("sum")).select(
        F.col("_label").alias("_same"), F.expr("try_cast(sum as bigint)").alias("label_error")
    )
    return lookup_join(coded, sums, "_label", "_same").select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    """The same in SQL: the rounds as one query each, parts of four components as the given vectors have them."""
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(f"""
near{k} AS (
    SELECT c.vec_id, c.label, c.part, c.v, min_by(b.entry, (far(c.v, b.v), b.entry)) AS entry, min(far(c.v, b.v)) AS far
    FROM cuts c JOIN book{k} b ON c.part = b.part GROUP BY c.vec_id, c.label, c.part, c.v
)""")
        if k < ROUNDS:
            rounds.append(f"""
mean{k} AS (
    SELECT part, entry, list(m ORDER BY place) AS v FROM (
        SELECT part, entry, place, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM (
            SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{k}
        ) GROUP BY part, entry, place
    ) GROUP BY part, entry
),
book{k + 1} AS (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON b.part = m.part AND b.entry = m.entry
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cuts AS (
    SELECT vec_id, label, p AS part, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v
    FROM kept, range({PARTS}) r(p)
),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS (SELECT c.part, f.entry, c.v FROM first f JOIN cuts c ON f.vec_id = c.vec_id),{",".join(rounds)},
coded AS (
    SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY vec_id, label
),
books AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, books
""".replace("far(c.v, b.v)", "list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT")


SQL = _sql()
