"""CSV in and out, on any path Spark can read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import ident

CSV = {"header": True, "escape": '"'}
TEXT = "every column as text"
#: Blocks whose states are given to each task: about 100 MB, or 128 TB of input in blocks of the usual size.
MOST_BLOCKS = 1_000_000
# A record within a block, and the pieces of one that lies in several, in the order in which a block has them.
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; types are inferred unless a schema is given.

    Inference reads the data once more, so give a schema for large inputs.
    ``multi_line`` allows line breaks in quoted values; large files are still
    read by many tasks, see ``records``.
    """
    reader = spark.read.options(**CSV)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return _parsed(spark, path, reader, schema) if multi_line else reader.csv(path)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; every column stays text."""
    reader = spark.read.options(**CSV)
    return _parsed(spark, path, reader, TEXT) if multi_line else reader.csv(path)


def _parsed(spark: SparkSession, path: str, reader: DataFrameReader, schema: T.StructType | str | None) -> DataFrame:
    """A CSV whose values may have line breaks, from its records."""
    found = records(spark, path)
    if found is None:
        return reader.option("multiLine", True).csv(path)
    # The header alone is read for the names; of a schema that is inferred only the types are new.
    names = spark.read.options(**CSV).option("multiLine", True).csv(path).columns
    if schema is None:
        lines = found.rdd.map(lambda row: row[0])
        inferred = spark.read.options(**CSV).option("header", False).option("inferSchema", True).csv(lines).schema
        kinds = [f.dataType for f in inferred.fields] + [T.StringType()] * len(names)
        schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    elif schema is TEXT:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parsed = F.from_csv("record", F.lit(_ddl(schema)), {k: str(v) for k, v in CSV.items() if k != "header"})
    return found.select(parsed.alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def records(spark: SparkSession, path: str, most_blocks: int = MOST_BLOCKS) -> DataFrame | None:
    """The records of CSV files, without headers and blank lines, as ``record``; line breaks in quotes are part of one.

    Files are read in blocks, as text.  A line break ends a record if the
    quotes before it in the file are even in number.  So the first pass counts
    each block's quotes, and their sum over the blocks before says whether a
    block begins inside a value.  The second pass puts lines together to
    records, block by block; the few records that lie in several blocks are
    put together from their pieces.  Quotes inside values must be doubled, as
    ``write_csv`` and the standard have it.

    None is returned for more than ``most_blocks`` blocks, whose states would
    be too much to give to each task.
    """
    # Only \n ends a line here, so that the lines joined by it are the text as it was.
    text = spark.read.option("lineSep", "\n").text(path)
    block = ["file", "start"]
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy(*block).agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = odd.select(*block, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    states = states.limit(most_blocks + 1).collect()  # one row for each block
    if len(states) > most_blocks:
        return None
    inside = {(s["file"], s["start"]) for s in states if s["inside"]}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        place, held, opened, is_head, is_first = None, [], False, False, False

        def told(kind: int) -> None:
            nonlocal held, is_first
            record = "\n".join(held)
            # The first record of a file is its header; kept where it goes on in the next block, to be dropped there.
            if kind != WHOLE or not is_first and record.strip():
                made.append((*place, kind, record.removesuffix("\r") if kind == WHOLE else record, is_first))
            held, is_first = [], False

        def ready() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(zip(*made) if made else [()] * 5, kinds)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "record", "is_header"])

        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != place:
                    if held:
                        told(MIDDLE if is_head else TAIL)
                    place, is_first = (file, start), start == 0
                    opened = is_head = place in inside
                held.append(line)
                opened ^= line.count('"') % 2 == 1
                if not opened:
                    told(HEAD if is_head else WHOLE)
                    is_head = False
            yield ready()
        if held:
            told(MIDDLE if is_head else TAIL)
        yield ready()

    found = lines.mapInArrow(work, "file string, start bigint, kind int, record string, is_header boolean")
    # A record begins with a block's tail; the blocks that lie within it and the head that ends it follow.
    pieces = found.filter(F.col("kind") != WHOLE)
    along = Window.partitionBy("file").orderBy("start", "kind")
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(along))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "record", "is_header"))).alias("parts")
    )
    whole = joined.filter(~F.col("parts")[0]["is_header"]).select(
        F.rtrim(F.array_join(F.transform("parts", lambda p: p["record"]), "\n"), F.lit("\r")).alias("record")
    )
    return found.filter(F.col("kind") == WHOLE).select("record").union(whole)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task, replacing what is there.

    Quotes inside values are doubled, as the readers above expect, and spaces are kept.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
