"""Near copies by SimHash: candidates from the pigeonring principle, components from joins.

A text's fingerprint has 64 bits.  Two fingerprints link at ``LIMIT`` or fewer
differing bits.  They are cut into 8 segments of 8 bits on a ring.  By the
pigeonring principle, if the bits differ in at most 3 places, then from some
segment on, every chain of k consecutive segments differs in at most
floor(3 k / 8) places: nothing in the first two, at most one bit in the first
five.  So the first two segments are equal, and of the next three two are:
three keys of 32 bits for each of the 8 starts find all pairs, and the budgets
of the whole chain prune what a key finds before the full check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import cut, ship

SEGMENTS, BITS, LIMIT = 8, 8, 3
SHINGLE, SEED = 3, 42
BUDGETS = [LIMIT * k // SEGMENTS for k in range(1, SEGMENTS + 1)]
KEYS = [(start, chosen) for start in range(SEGMENTS) for chosen in combinations((2, 3, 4), 2)]
#: Rows of one key that are compared at once; a key with more is cut into blocks.
GROUP = 1024
#: Up to this size all pairs of a group are compared at once; above it, a group is reduced to its components.
SMALL = 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's word shingles; 0 if it has no words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # a very long text takes no more memory than a long one
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter((fingerprint(texts[i].as_py()) for i in range(len(texts))), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return given.mapInArrow(work, f"id {given.schema['id'].dataType.simpleString()}, fp bigint")


def _segment(fp: Column, index: int) -> Column:
    return F.shiftrightunsigned(fp, BITS * (index % SEGMENTS)).bitwiseAND(255)


def _keyed(distinct: DataFrame) -> DataFrame:
    """(key, fp): 24 rows of each fingerprint; the key holds its number and four segments' bits."""
    keys = []
    for number, (start, chosen) in enumerate(KEYS):
        key = F.lit(number).cast("bigint")
        for step in (0, 1, *chosen):
            key = F.shiftleft(key, BITS).bitwiseOR(_segment(F.col("fp"), start + step))
        keys.append(key)
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _together(keyed: DataFrame) -> DataFrame:
    """(key, part, fp) of the keys with several rows, at most about 2 * GROUP rows in a part.

    A crowded key is cut into blocks, and each pair of its blocks is a part of
    its own: any two of its rows meet in some part, and no task gets them all.
    """
    counted = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    counted = counted.withColumn("blocks", F.ceil(F.col("n") / GROUP)).withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("blocks"))
    )
    parts = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda other: F.least("block", other) * F.col("blocks") + F.greatest("block", other),
    )
    return counted.select("key", F.explode(parts).alias("part"), "fp")


def near(distinct: DataFrame) -> DataFrame:
    """(a, b): links between the fingerprints in column ``fp``, enough of them to connect all that is linked."""
    ship(distinct.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)])
            last = (held[:, :2] != held[-1, :2]).any(axis=1).nonzero()[0] if len(held) else held[:, 0]
            ready = last[-1] + 1 if len(last) else 0
            yield links(held[:ready])
            held = held[ready:]
        yield links(held)

    def links(rows: np.ndarray) -> pa.RecordBatch:
        a, b = _pairs_in(rows[:, 0], rows[:, 1], np.ascontiguousarray(rows[:, 2]).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    parts = _together(_keyed(distinct)).repartition("key", "part").sortWithinPartitions("key", "part", "fp")
    return parts.mapInArrow(work, "a bigint, b bigint").distinct()


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id reachable by links.

    A null text has no words and fingerprint 0; equal fingerprints are linked,
    repeated rows too.  Rows without an id take part; their component is the
    smallest id reachable, null if none of those has one.
    """
    marked = cut(fingerprints(docs, id_column, text_column))
    distinct = marked.groupBy("fp").agg(F.min("id").alias("least"))
    found = components(near(distinct.select("fp")))
    placed = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component"))
    return marked.join(placed.join(names, "root").select("fp", "component"), "fp")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id.

    Groups are of rows, not of ids: rows of one id whose texts are not linked
    stay apart, and a row without an id is kept only where its group has no
    id.  Rows that tie in their id are told apart by a digest of the whole
    row; of rows that are equal in all columns one is kept.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]))
    digest = F.unhex(F.sha2(whole, 256))
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), digest.alias("digest"))
    found = groups(docs.select(name.alias("name"), "text"), "name", "text")
    first = found.filter("id = component").groupBy(F.col("id.digest").alias("_kept")).agg(F.count(F.lit(1)).alias("n"))
    first = cut(first)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), digest.alias("_digest"))
    same = F.col("_digest") == F.col("_kept")
    once = packed.join(first.filter("n = 1"), same, "left_semi").select("_row")
    # Equal rows are combined before they are shuffled, so that a row copied very often is no burden.
    equal = packed.join(first.filter("n > 1"), same, "left_semi").groupBy("_digest").agg(F.any_value("_row").alias("_row"))
    return once.union(equal.select("_row")).select("_row.*")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _pairs_in(keys: np.ndarray, parts: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked among rows of equal key and part; the rows are sorted."""
    if len(keys) < 2:
        return fps[:0], fps[:0]
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])])
    sizes = np.diff(np.r_[starts, len(keys)])
    left, right = [], []
    small = sizes <= SMALL
    inside = np.repeat(small, sizes)
    rows = np.flatnonzero(inside)
    for step in range(1, int(sizes[small].max(initial=1))):
        rows = rows[rows + step < len(keys)]
        rows = rows[(keys[rows] == keys[rows + step]) & (parts[rows] == parts[rows + step])]
        if not len(rows):
            break
        linked = rows[_linked(keys[rows], fps[rows], fps[rows + step])]
        left.append(fps[linked])
        right.append(fps[linked + step])
    for start, size in zip(starts[~small], sizes[~small]):
        group = fps[start : start + size]
        labels = _labels(group)
        moved = labels != np.arange(size)
        left.append(group[moved])
        right.append(group[labels[moved]])
    if not left:
        return fps[:0], fps[:0]
    return np.concatenate(left), np.concatenate(right)


def _linked(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs that share a key link: the chain's budgets first, then the full distance."""
    starts = np.array([start for start, _ in KEYS], np.uint64)[((keys >> 32) & 0xFF).astype(np.int64)]
    differ = a ^ b
    turn = starts * np.uint64(BITS)
    ring = (differ >> turn) | np.where(turn > 0, differ << (np.uint64(64) - turn) % np.uint64(64), np.uint64(0))
    kept = np.ones(len(a), bool)
    for k, budget in enumerate(BUDGETS[:-1], 1):
        chain = np.bitwise_count(ring & np.uint64((1 << BITS * k) - 1))
        kept &= chain <= budget
    kept[kept] = np.bitwise_count(differ[kept]) <= LIMIT
    return kept


def _labels(group: np.ndarray) -> np.ndarray:
    """For each row the smallest row it is connected with inside the group."""
    labels = np.arange(len(group))
    near = [np.flatnonzero(np.bitwise_count(group ^ fp) <= LIMIT) for fp in group]
    while True:
        least = np.array([labels[row].min() for row in near])
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least
