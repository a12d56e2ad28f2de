"""Lines that many documents share: each stays in one of them.

A line's key is the line without white space at its ends, A-Z in lower case.
A key of at least ``LEAST`` characters that at least ``SHARED`` documents hold
is dropped from all of them but the one with the largest id.

Only hashes of 128 bits are shuffled, with the document's id and the line's
places.  They are range-partitioned and sorted by hash, then by document from
the largest id down, then by place.  As the id is part of the range, a line
that a third of all documents share lies in many partitions.  Tasks stream
them: in a run of equal hashes the first document keeps its lines, and the
later ones lose theirs if the run has enough documents.  A run that touches an
end of the streamed batch may go on elsewhere; its rows wait for the few ends
to be put together.  What comes out is a bitmap for each document that loses
lines, never a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.joins import lookup_join

from .shared import cut, ship

LEAST, SHARED = 20, 3
#: What a streamed row says: it is dropped, it waits for its run's ends, it is the document of such an end.
DROPPED, WAITING, END = 0, 1, 2


def key(line: bytes) -> bytes:
    """A line's key, from UTF-8 to UTF-8."""
    return line.strip().lower()  # of bytes: white space and letters of ASCII only


def hashes(text: bytes | None, least: int = LEAST) -> dict[bytes, list[int]]:
    """The places of each key that is long enough, by the key's hash."""
    from xxhash import xxh3_128_digest

    found: dict[bytes, list[int]] = {}
    for place, line in enumerate((text or b"").split(b"\n")):
        own = key(line)
        if len(own) >= least and (own.isascii() or len(own.decode("utf-8", "replace")) >= least):
            found.setdefault(xxh3_128_digest(own), []).append(place)
    return found


def row_key(text: Column) -> Column:
    """What tells apart the rows of one id: rows that are alike in both lose the same lines."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashed(docs: DataFrame, id_column: str, text_column: str, least: int) -> DataFrame:
    """(high, low, id, row, places): one row for each document and key in it."""
    ship(docs.sparkSession)
    text = F.col(f"`{text_column}`")
    given = docs.select(F.col(f"`{id_column}`").alias("id"), row_key(text).alias("row"), text.cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners, places, ends = [], [], [], [0]
            for at, text in enumerate(batch.column(2)):
                for digest, own in hashes(text.as_py(), least).items():
                    digests.append(digest)
                    owners.append(at)
                    places.extend(own)
                    ends.append(len(places))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.array(owners, pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))
            columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(rows), batch.column(1).take(rows)]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["high", "low", "id", "row", "places"])

    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(work, f"high bigint, low bigint, id {kind}, row bigint, places array<int>")


def _streamed(hashed: DataFrame, shared: int) -> DataFrame:
    """The rows of ``hashed`` that are dropped or wait, and the documents of unfinished runs, told apart by ``kind``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            high, low = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ids = batch.column(2).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
            changed = starts | np.r_[True, ids[1:] != ids[:-1]]
            run = np.cumsum(starts) - 1
            seen = np.cumsum(changed)
            order = seen - seen[np.flatnonzero(starts)][run]  # the document's number within its run
            documents = np.zeros(run[-1] + 1, np.int64)
            np.maximum.at(documents, run, order + 1)
            touches = (run == 0) | (run == run[-1])
            chosen = [
                ~touches & (order > 0) & (documents[run] >= shared),
                touches,
                touches & changed & (order < shared),
            ]
            for kind, rows in enumerate(chosen):
                if rows.any():
                    part = batch.filter(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.num_rows, kind, np.int32)), *part.columns], ["kind", *part.schema.names]
                    )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hashed.schema)
    return hashed.mapInArrow(work, f"kind int, {schema}")


def _bitmap(places: pd.Series) -> pd.Series:
    """Compressed bits, 1 for a line that stays; lines after the last bit stay."""

    def packed(own) -> bytes:
        bits = np.ones(max(own) // 8 * 8 + 8, np.uint8)
        bits[np.asarray(own)] = 0
        return zlib.compress(np.packbits(bits, bitorder="little").tobytes())

    return places.map(packed)


def kept_lines(text: str, bitmap: bytes) -> str:
    """The text without the lines that its bitmap drops."""
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[: len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    return "\n".join(line for place, line in enumerate(lines) if place not in gone)


def bitmaps(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, shared: int = SHARED
) -> DataFrame:
    """(id, row, n_dropped, bitmap): the documents that lose lines; all others keep theirs.

    Rows of one id are one document: a line that only they hold is no shared
    line.  Each row has its own lines dropped; ``row`` tells rows with other
    texts apart, and rows alike in id and text have one bitmap.  The rows
    without an id are one document, smaller than all others.  A null text is
    one empty line.
    """
    hashed = cut(_hashed(docs, id_column, text_column, least))
    order = ["high", "low", F.col("id").desc_nulls_last(), "row", F.col("places")[0]]
    flagged = cut(_streamed(hashed.repartitionByRange(*order).sortWithinPartitions(*order), shared))

    ends = flagged.filter(f"kind = {END}").select(F.struct("high", "low").alias("run"), F.struct("id").alias("document"))
    runs = ends.groupBy("run").agg(F.max("document").alias("first"), F.count_distinct("document").alias("documents"))
    runs = runs.filter(F.col("documents") >= shared).select(F.col("run").alias("_run"), "first")
    waiting = flagged.filter(f"kind = {WAITING}").withColumn("run", F.struct("high", "low"))
    later = lookup_join(waiting, runs, "run", "_run").filter(F.struct("id") != F.col("first"))

    dropped = flagged.filter(f"kind = {DROPPED}").select("id", "row", "places").union(later.select("id", "row", "places"))
    # Rows alike in id and text have come with the same places.
    places = dropped.groupBy("id", "row").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    pack = F.pandas_udf(_bitmap, "binary")
    return places.select("id", "row", F.size("places").cast("long").alias("n_dropped"), pack("places").alias("bitmap"))


def with_bitmaps(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows: their columns as ``_row``, and ``n_dropped`` (0 if nothing) and ``bitmap`` (null if nothing)."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.struct(F.col(f"`{id_column}`").alias("id"), row_key(F.col(f"`{text_column}`")).alias("row")).alias("_document"),
    )
    known = found.select(F.struct("id", "row").alias("_found"), "n_dropped", "bitmap")
    joined = lookup_join(packed, known, "_document", "_found", "left")
    return joined.select("_row", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "bitmap")


def remaining(text: Column, bitmap: Column) -> Column:
    """The text that stays; only texts that lose lines go through Python."""
    keep = F.pandas_udf(
        lambda texts, maps: pd.Series([None if b is None else kept_lines(t or "", b) for t, b in zip(texts, maps)]), "string"
    )
    return F.when(bitmap.isNull(), F.coalesce(text, F.lit(""))).otherwise(keep(F.when(bitmap.isNotNull(), text), bitmap))


def without_shared_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """All rows with all columns, their text without the shared lines; a null text stays null."""
    joined = with_bitmaps(docs, bitmaps(docs, id_column, text_column, **options), id_column, text_column)
    text = F.col(f"_row.`{text_column}`")
    stays = F.when(text.isNotNull(), remaining(text, F.col("bitmap")))
    return joined.select(*[(stays if c == text_column else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row; see ``bitmaps``."""
    joined = with_bitmaps(docs, bitmaps(docs, id_column, text_column), id_column, text_column)
    text = F.col(f"_row.`{text_column}`")
    return joined.select(
        F.col(f"_row.`{id_column}`").alias("doc_id"),
        F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(remaining(text, F.col("bitmap")), 256).alias("kept_sha256"),
    )


SQL = """
WITH given AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM given
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
