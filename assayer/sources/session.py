"""Session settings: object store, table-format catalog, shared scratch folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ObjectStore:
    """Where ``s3a://bucket/key`` paths lead."""

    endpoint: str
    access_key: str
    secret_key: str
    path_style: bool = True
    ssl: bool = False

    def settings(self) -> dict[str, str]:
        return {
            "spark.hadoop.fs.s3a.endpoint": self.endpoint,
            "spark.hadoop.fs.s3a.access.key": self.access_key,
            "spark.hadoop.fs.s3a.secret.key": self.secret_key,
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.path.style.access": str(self.path_style).lower(),
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(self.ssl).lower(),
        }


@dataclass(frozen=True)
class CatalogSettings:
    """A table-format catalog whose jars the cluster provides.

    ``options`` are passed on below ``spark.sql.catalog.<name>.``, such as
    ``type``, ``uri``, ``warehouse`` or ``io-impl``.
    """

    name: str
    implementation: str
    extensions: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        prefix = f"spark.sql.catalog.{self.name}"
        given = {prefix: self.implementation, **{f"{prefix}.{k}": v for k, v in self.options.items()}}
        if self.extensions:
            given["spark.sql.extensions"] = self.extensions
        return given


# Adaptive execution coalesces small shuffles and splits large ones.  A suite's
# aggregation has a column per count, and Spark leaves whole-stage code
# generation at 100 columns, so the bound is raised.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    name: str,
    store: ObjectStore | None = None,
    catalog: CatalogSettings | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """The session of a job; the master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    settings = dict(DEFAULTS)
    for part in (store, catalog):
        settings |= part.settings() if part else {}
    for key, value in (settings | (extra or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where it names none, a
    session on one machine takes a folder in its warehouse; on a cluster that
    is an error, since executors don't see each other's disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one; whoever asks for it removes it after use."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop, wherever it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
