"""Tables written in a layout and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.session import fresh_folder
from tidemark.sources import given, tables
from tidemark.workload.registry import query, rounded

_KEYS = ["o_custkey", "o_orderdate"]
_FILES = 64


def _orders(spark, d):
    return given.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"),
                                                  "o_totalprice")


def _written(spark, df):
    folder = fresh_folder(spark, "layout")
    df.write.parquet(folder)
    return spark.read.parquet(folder)


@query("tbl_z_order", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders")
def _(spark, d):
    """All rows of a table along a Z curve of two columns, read back."""
    return _written(spark, tables.z_order(_orders(spark, d), _KEYS, _FILES))


@query("tbl_z_order_skipping")
def _(spark, d):
    """Share of files that a lookup by each key alone must open: sorted by both keys, and along the curve."""
    orders, out = _orders(spark, d), None
    for layout, laid in (("sorted", tables.cluster_layout(orders, _KEYS, _FILES)),
                         ("z_order", tables.z_order(orders, _KEYS, _FILES))):
        table = _written(spark, laid)
        for column in _KEYS:
            line = tables.opened_share(table, column).select(
                F.lit(layout).alias("layout"), F.lit(column).alias("lookup"), "files", "share")
            out = line if out is None else out.unionByName(line)
    return rounded(out, 4, "share")
