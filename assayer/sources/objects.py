"""Listing of stored objects."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from .session import shared_folder

LISTING = "key string, length bigint, modified timestamp"
S3A = "spark.hadoop.fs.s3a."
# Deeper than any path a store allows; links that lead in a circle end here.
MAX_DEPTH = 512


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", pattern: str = ".*", recursive: bool = False
) -> DataFrame:
    """Objects below ``root`` as ``key`` (relative to it), ``length`` and ``modified``.

    Keys start with ``prefix`` and contain a match of ``pattern``; without
    ``recursive`` only those with no further slash after the prefix are given.
    No key is hidden, whatever its first character, and a prefix that is
    nowhere gives no rows.  Only folders that may hold the prefix are listed.

    Tasks list the folders, level by level: each level's folders are dealt out
    anew, and what they hold, objects and further folders, goes to a
    checkpoint.  The driver sees only whether there are folders left.  That
    works for local paths and S3, which tasks can reach by themselves.  Stores
    that only Hadoop's drivers reach are listed by the driver.
    """
    base = root.rstrip("/")
    folder = prefix.rpartition("/")[0]
    store = _store(spark, base)
    if store is None:
        return _listed_by_driver(spark, base, folder, prefix, pattern, recursive)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    level = spark.createDataFrame([(folder,)], "key string")
    levels = []
    while len(levels) < MAX_DEPTH:
        listed = level.mapInArrow(_lister(store, prefix, pattern), f"{LISTING}, is_folder boolean").checkpoint()
        levels.append(listed)
        level = listed.filter("is_folder").select("key").repartition("key")
        if not recursive or not listed.filter("is_folder").take(1):
            return reduce(DataFrame.union, levels).filter("not is_folder").drop("is_folder")
    raise ValueError(f"folders below {root!r} are more than {MAX_DEPTH} deep")


def _store(spark: SparkSession, base: str) -> dict | None:
    """What a task needs to open the store: its kind and settings, and the path in it; None if it cannot."""
    scheme, _, rest = base.rpartition("://") if "://" in base else ("", "", base)
    if not scheme and base.startswith("file:"):
        return {"kind": "local", "path": base.removeprefix("file:")}
    if scheme == "file" or (not scheme and _default_scheme(spark) == "file"):
        return {"kind": "local", "path": os.path.abspath(rest)}
    if scheme in ("s3", "s3a") and hasattr(fs, "S3FileSystem"):
        names = {"access_key": "access.key", "secret_key": "secret.key", "endpoint_override": "endpoint"}
        given = {k: spark.conf.get(S3A + v, None) for k, v in names.items()}
        return {"kind": "s3", "path": rest, "settings": {k: v for k, v in given.items() if v}}
    return None


def _default_scheme(spark: SparkSession) -> str:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.FileSystem.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()


def _lister(store: dict, prefix: str, pattern: str):
    """For tasks: what lies directly below folders, objects that are wanted and folders that begin with the prefix."""
    wanted = re.compile(pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, base = store["kind"], store["path"].rstrip("/")
        files = fs.LocalFileSystem() if kind == "local" else fs.S3FileSystem(**store["settings"])
        for batch in batches:
            for key in batch.column(0).to_pylist():
                selector = fs.FileSelector(f"{base}/{key}".rstrip("/"), allow_not_found=True)
                rows = []
                for entry in files.get_file_info(selector):
                    own = entry.path.removeprefix(base).lstrip("/")
                    is_folder = entry.type == fs.FileType.Directory
                    if own.startswith(prefix) and (is_folder or wanted.search(own)):
                        rows.append((own, entry.size, entry.mtime, is_folder))
                columns = list(zip(*rows)) or [(), (), (), ()]
                types = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["key", "length", "modified", "is_folder"]
                )

    return work


def _listed_by_driver(
    spark: SparkSession, base: str, folder: str, prefix: str, pattern: str, recursive: bool
) -> DataFrame:
    """The same through Hadoop's file systems; what matches is kept on the driver."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    start = hadoop.Path(f"{base}/{folder}" if folder else base)
    store = start.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    bare = store.makeQualified(hadoop.Path(base)).toUri().getPath().rstrip("/") + "/"
    wanted = re.compile(pattern)
    found = []
    if store.exists(start):
        entries = store.listFiles(start, recursive)
        while entries.hasNext():
            entry = entries.next()
            key = entry.getPath().toUri().getPath().removeprefix(bare)
            if key.startswith(prefix) and wanted.search(key) and (recursive or "/" not in key[len(prefix) :]):
                modified = datetime.fromtimestamp(entry.getModificationTime() / 1000, timezone.utc)
                found.append((key, entry.getLen(), modified))
    return spark.createDataFrame(found, LISTING)
