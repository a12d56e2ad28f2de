"""Queries over files and snapshots made from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.sources import (
    list_objects,
    previous_snapshot,
    read_as_of,
    read_csv,
    read_csv_text,
    snapshot_log,
    write_csv,
    write_snapshot,
)

from .suites import query as _query
from .tables import given, scratch, table, table_sql
from . import suites

QUERIES = suites.QUERIES
ORACLES = suites.ORACLES

ORDERS = table_sql("dirty_orders")
SUMMARY_SQL = (
    "select status, count(*) as n, cast(sum(o_orderkey) as bigint) as key_sum,"
    " count(price) as priced, round(sum(price), 2) as total, count(order_date) as dated"
    f" from {ORDERS} t group by status"
)


def _summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
        F.count("price").alias("priced"),
        F.round(F.sum(F.col("price").cast("double")), 2).alias("total"),
        F.count("order_date").alias("dated"),
    )


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "orders-csv")
    orders = table(spark, sf_dir, "dirty_orders").select("o_orderkey", "status", "price", "order_date")
    write_csv(orders, path)
    return path


@_query("src_csv_inferred", SUMMARY_SQL)
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(read_csv(spark, _orders_csv(spark, sf_dir)))


@_query("src_csv_schema", SUMMARY_SQL)
def src_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "o_orderkey bigint, status string, price double, order_date string"
    return _summary(read_csv(spark, _orders_csv(spark, sf_dir), schema))


@_query("src_csv_string", SUMMARY_SQL)
def src_csv_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(read_csv_text(spark, _orders_csv(spark, sf_dir)))


@_query(
    "src_csv_multiline",
    "select doc_id, lang, length(text) as chars, md5(text) as digest from documents",
)
def src_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "documents-csv")
    write_csv(given(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    documents = read_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)
    return documents.select(
        "doc_id", "lang", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest")
    )


@_query("sink_csv_roundtrip", f"select o_orderkey, status, price, order_date from {ORDERS} t")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "o_orderkey bigint, status string, price double, order_date string"
    return read_csv(spark, _orders_csv(spark, sf_dir), schema)


@_query("list_objects", "select distinct 'parts/o_orderstatus=' || o_orderstatus as folder, true as filled from orders")
def list_stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "objects")
    given(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(f"{root}/parts")
    found = list_objects(spark, root, prefix="parts/o_order", pattern=r"part-.*\.parquet$", recursive=True)
    folder = F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("folder")
    return found.groupBy(folder).agg(F.every(F.col("length") > 0).alias("filled"))


def _mixed_objects(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for each region, partition folders for the nations, and names that begin with _ and dot."""
    root = scratch(spark, "objects")
    nations = given(spark, sf_dir, "nation").select("n_regionkey", "n_name", F.col("n_name").alias("value"))
    nations.write.partitionBy("n_regionkey", "n_name").text(f"{root}/in")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    regions = [r.r_name for r in given(spark, sf_dir, "region").select("r_name").collect()]
    for name in [form.format(r) for r in regions for form in ("{}.csv", "_{}", ".{}", "a+ {}")]:
        store.create(hadoop.Path(f"{root}/in/{name}")).close()
    return root


@_query(
    "list_objects_flat",
    "select 'in/' || replace(form, '#', r_name) as key from region, (values ('#.csv'), ('_#'), ('.#'), ('a+ #')) x(form)"
    " union all select 'in/_SUCCESS'",
)
def list_objects_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files beside partition folders, one level, none hidden; checksums of the local file system left out."""
    found = list_objects(spark, _mixed_objects(spark, sf_dir), prefix="in/")
    return found.filter(~F.col("key").endswith(".crc")).select("key")


PREFIXES = ["in/n_regionkey=1/", "in/n_regionkey=2/n_name=I", "in/n_regionkey=9", "nowhere/x", "in/n_regionkey=3/n_name=😀"]


@_query(
    "list_objects_absent",
    "select prefix, 'in/n_regionkey=' || n_regionkey || '/n_name=' || n_name as folder from nation,"
    f" (values {', '.join(f'({chr(39)}{p}{chr(39)})' for p in PREFIXES)}) x(prefix)"
    " where starts_with('in/n_regionkey=' || n_regionkey || '/n_name=' || n_name || '/', prefix)",
)
def list_objects_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of objects under several prefixes; some are nowhere and give none."""
    root = _mixed_objects(spark, sf_dir)
    found = [
        list_objects(spark, root, prefix=p, pattern=r"/part-[^/]*\.txt$", recursive=True).withColumn("prefix", F.lit(p))
        for p in PREFIXES
    ]
    folder = F.regexp_extract("key", "^(.*)/[^/]*$", 1)
    return reduce(DataFrame.unionByName, found).select("prefix", F.url_decode(folder).alias("folder")).distinct()


# -- snapshots ------------------------------------------------------------

STORED = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
# Every order is in one of the parts, whatever its key.
PART = "coalesce(abs(o_orderkey) % 3, 0)"
STATE = "count(*) as n, cast(sum(o_orderkey) as bigint) as key_sum, round(sum(o_totalprice), 2) as total"
STATES = f"select o_orderstatus, {STATE} from orders"


def _orders_in_three(spark: SparkSession, sf_dir: str) -> str:
    """All orders, dealt by key to snapshots 1 to 3."""
    orders = given(spark, sf_dir, "orders").select(*STORED)
    path = scratch(spark, "snapshots")
    for part in range(3):
        write_snapshot(orders.filter(f"{PART} = {part}"), path, part + 1)
    return path


def _states(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_orderkey").alias("key_sum"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@_query("snap_append", f"select {STATE} from orders")
def snap_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_as_of(spark, _orders_in_three(spark, sf_dir))
    return _states(stored.withColumn("o_orderstatus", F.lit("all"))).drop("o_orderstatus")


@_query("snap_current", f"{STATES} group by o_orderstatus")
def snap_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(read_as_of(spark, _orders_in_three(spark, sf_dir)))


@_query("snap_log", f"select cast({PART} + 1 as int) as snapshot_id, count(*) as added from orders group by 1")
def snap_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_log(spark, _orders_in_three(spark, sf_dir))


@_query("snap_previous", f"{STATES} where {PART} < 2 group by o_orderstatus")
def snap_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_in_three(spark, sf_dir)
    return _states(read_as_of(spark, path, previous_snapshot(spark, path)))


@_query("snap_as_of", f"{STATES} where {PART} = 0 group by o_orderstatus")
def snap_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time travel in SQL: the view holds the first snapshot."""
    read_as_of(spark, _orders_in_three(spark, sf_dir), 1).createOrReplaceTempView("orders_then")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey) AS key_sum, round(sum(o_totalprice), 2) AS total"
        " FROM orders_then GROUP BY o_orderstatus"
    )


@_query(
    "snap_replace",
    "select 'before' as state, count(*) as n, count(distinct o_orderstatus) as kinds from orders"
    " union all select 'after', count(*), count(distinct c_mktsegment) from customer",
)
def snap_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create or replace: other rows and columns under a new path; the old dataset stays readable."""
    before, after = _orders_in_three(spark, sf_dir), scratch(spark, "snapshots")
    write_snapshot(given(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), after, 1)

    def size(state: str, rows: DataFrame, column: str) -> DataFrame:
        # Two steps instead of count(distinct): the groups are few.
        kinds = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return kinds.agg(F.sum("n").alias("n"), F.count(column).alias("kinds")).select(
            F.lit(state).alias("state"), "n", "kinds"
        )

    return size("before", read_as_of(spark, before), "o_orderstatus").unionByName(
        size("after", read_as_of(spark, after), "c_mktsegment")
    )


@_query(
    "snap_update",
    f"""
select 'after' as state, o_orderstatus, {STATE} from (
    select o_orderkey, case when o_orderstatus = 'P' then 'pending' else o_orderstatus end as o_orderstatus,
           case when o_orderstatus = 'P' then o_totalprice * 2 else o_totalprice end as o_totalprice from orders) o
group by o_orderstatus
union all
select 'before', o_orderstatus, {STATE} from orders group by o_orderstatus""",
)
def snap_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update, as plain Parquet has it: all rows written anew with the change; the old dataset stays readable."""
    before, after = _orders_in_three(spark, sf_dir), scratch(spark, "snapshots")
    pending = F.col("o_orderstatus") == "P"
    changed = read_as_of(spark, before).withColumns(
        {
            "o_orderstatus": F.when(pending, "pending").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(pending, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")),
        }
    )
    write_snapshot(changed, after, 1)
    old = _states(read_as_of(spark, before)).withColumn("state", F.lit("before"))
    return _states(read_as_of(spark, after)).withColumn("state", F.lit("after")).unionByName(old)


@_query("scan_named", f"{STATES} group by o_orderstatus")
def scan_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read by its name."""
    given(spark, sf_dir, "orders").createOrReplaceTempView("named_orders")
    return _states(spark.table("named_orders"))


@_query(
    "inline_rows",
    "select label, count(*) as n from orders join (values ('F', 'filled'), ('O', 'open'), ('P', 'part')) x(code, label)"
    " on o_orderstatus = code group by label",
)
def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows given in the query itself, joined to a table."""
    labels = spark.sql("SELECT * FROM VALUES ('F', 'filled'), ('O', 'open'), ('P', 'part') AS x(code, label)")
    orders = given(spark, sf_dir, "orders").select("o_orderstatus")
    return orders.join(labels, F.col("o_orderstatus") == F.col("code")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
