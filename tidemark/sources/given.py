"""The given test tables read as the canonical inputs: snapshots, usage, calls, ceases, requests.

Orders play the customer's contacts and cancellations, shipments the usage,
events the request log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.contract import ENTITY

# the given orders lie in 1995-2001, so the split cuts do too
TRAIN_END = "1999-01-01"
VALIDATION_END = "2000-07-01"

LINES_IN_TASK = 1_000_000       # of the line items, in the joins and aggregates that take most memory


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once, not for every scan."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text_date(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def raw_customer_info(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot per customer and month with an order."""
    orders = table(spark, folder, "orders")
    monthly = (orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("m"))
               .agg(F.min("o_orderpriority").alias("prio"),
                    F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("dd"),
                    F.count_if(F.col("o_orderstatus") == "P").cast("int").alias("dd60"),
                    F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
                    F.min(F.col("o_orderdate").cast("date")).alias("first")))
    first = F.min("first").over(Window.partitionBy("o_custkey"))
    region = (table(spark, folder, "nation")
              .join(table(spark, folder, "region"),
                    F.col("n_regionkey") == F.col("r_regionkey")))
    customer = (table(spark, folder, "customer")
                .join(region, F.col("c_nationkey") == F.col("n_nationkey")))
    segment = F.col("c_mktsegment")
    return (monthly.withColumn("tenure_days", F.datediff("m", first))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_custkey").cast("string").alias(ENTITY),
                    _text_date("m").alias("datevalue"),
                    F.concat(F.lit("0"), "prio").alias("contract_status"),
                    F.col("dd").alias("contract_dd_cancels"),
                    F.col("dd60").alias("dd_cancel_60_day"),
                    F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 10.0) - 300.0)
                    .cast("double").alias("ooc_days"),
                    F.when(segment == "AUTOMOBILE", "FTTP").when(segment == "BUILDING", "FTTC")
                    .when(segment == "FURNITURE", "MPF").when(segment == "MACHINERY", "WLR")
                    .otherwise("Unknown").alias("technology"),
                    F.floor(F.col("hi") / 5000.0).cast("int").alias("speed"),
                    (F.col("lo") * 0.00017321).alias("line_speed"),
                    F.col("r_name").alias("sales_channel"),
                    F.col("n_name").alias("crm_package_name"),
                    "tenure_days"))


def spread(df: DataFrame, parts: int, *keys: str | Column) -> DataFrame:
    """Rows by key in ``parts`` tasks, where that is more than the cores; fewer are left to the session."""
    return df.repartition(parts, *keys) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def usage_tasks(spark: SparkSession, folder: str) -> int:
    """How many tasks the usage takes at ``LINES_IN_TASK`` each."""
    return -(-table(spark, folder, "lineitem").count() // LINES_IN_TASK)


def raw_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Usage per customer and shipping day, numbers as text, some of it unreadable.

    Hardly two lines share a customer and day, so a task's aggregates grow with its lines: it gets
    no more than ``LINES_IN_TASK`` of them on average, however large the table.
    """
    parts = usage_tasks(spark, folder)
    lines = spread(table(spark, folder, "lineitem"), parts, "l_orderkey").join(
        spread(table(spark, folder, "orders"), parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    daily = (spread(lines.withColumn("d", F.col("l_shipdate").cast("date")), parts, "o_custkey", "d")
             .groupBy("o_custkey", "d")
             .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
                  F.sum(F.floor("l_extendedprice")).cast("bigint").alias("x")))
    return daily.select(
        F.col("o_custkey").cast("string").alias(ENTITY), _text_date("d").alias("calendar_date"),
        F.when(F.col("q") % 47 == 0, "n/a")
        .otherwise(F.concat((F.col("q") * 10).cast("string"), F.lit(".5")))
        .alias("usage_download_mbs"),
        F.col("x").cast("string").alias("usage_upload_mbs"))


def raw_calls(spark: SparkSession, folder: str) -> DataFrame:
    """One call per order; the priority gives the type, and one priority has none."""
    prio = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias(ENTITY),
        _text_date("o_orderdate").alias("event_date"),
        F.when(prio == "1-URGENT", "Loyalty").when(prio == "2-HIGH", "Complaints")
        .when(prio == "3-MEDIUM", "Tech").when(prio == "5-LOW", "Other").alias("call_type"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("talk_time_seconds"),
        (F.col("o_orderkey") % 600).cast("int").alias("hold_time_seconds"))


def cease_days(spark: SparkSession, folder: str) -> DataFrame:
    """Entity and date of cancellations only, when nothing else of them is needed."""
    return (table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
            .select(F.col("o_custkey").cast("string").alias(ENTITY),
                    F.col("o_orderdate").cast("date").alias("cease_placed_date")))


def raw_cease(spark: SparkSession, folder: str) -> DataFrame:
    """One cancellation per finished order; completed with its last finished shipment."""
    done = (table(spark, folder, "lineitem").where(F.col("l_linestatus") == "F")
            .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("done")))
    return (table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
            .join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(F.col("o_custkey").cast("string").alias(ENTITY),
                    _text_date("o_orderdate").alias("cease_placed_date"),
                    _text_date("done").alias("cease_completed_date"),
                    F.col("o_orderpriority").alias("reason_description_insight")))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as requests: the parity of k picks the endpoint, the value is the latency."""
    return as_request_log(table(spark, folder, "events"))


def as_request_log(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(k % 2 == 0, "/predict").otherwise("/predict/batch").alias("endpoint"),
        F.when((F.col("event_type") == "error") & (k < 30), "error").otherwise("success")
        .alias("status"),
        (F.col("value") / 50).alias("latency_seconds"), F.col("event_type").alias("tier"),
        F.col("user_id").cast("string").alias(ENTITY))
