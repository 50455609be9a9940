"""Series drawn from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesflow.config import PLAIN, Layout
from seriesflow.operators.prepare import prepare_series
from seriesflow.sources.series import load_monthly, load_series

# Monthly sums have at most one row per key and calendar month, so the length
# of a series is bounded whatever the size of the table.
MONTHLY = PLAIN
# A whole event table as one series: cut into blocks small enough that the
# test tables have several of them.
ONE_LONG_SERIES = Layout("auto", block_rows=4096)
# Users' series stay whole, the large one is cut into several blocks.
ONE_HOT_SERIES = Layout("auto", block_rows=1000)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def monthly_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per priority and month."""
    return load_monthly(
        table(spark, folder, "orders"),
        F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_totalprice"),
    )


def monthly_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Shipped quantity per return flag, line status and month."""
    return load_monthly(
        table(spark, folder, "lineitem"),
        F.concat("l_returnflag", "l_linestatus"), F.col("l_shipdate"), F.col("l_quantity"),
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event values per user."""
    return load_series(
        table(spark, folder, "events"),
        F.col("user_id"), F.col("ts"), F.col("value"), F.col("event_id"),
    )


def all_events(spark: SparkSession, folder: str) -> DataFrame:
    """All event values as one series."""
    return load_series(
        table(spark, folder, "events"),
        F.lit("all"), F.col("ts"), F.col("value"), F.col("event_id"),
    )


def skewed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event values per user, with a third of all rows under one key."""
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1).cast("bigint"))
    return load_series(
        table(spark, folder, "events"),
        key.otherwise(F.col("user_id")), F.col("ts"), F.col("value"), F.col("event_id"),
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as texts, some of them unreadable; one row per order."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    month = (
        F.when(key % 97 == 0, F.lit("bad"))
        .when(key % 101 == 0, F.concat(F.substring(day, 1, 4), F.lit("-13")))
        .otherwise(F.substring(day, 1, 7))
    )
    value = (
        F.when(key % 89 == 0, F.lit("n/a"))
        .when(key % 83 == 0, F.lit(None).cast("string"))
        .when(key % 79 == 0, F.lit("NaN"))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        key.alias("order_key"), month.alias("month"), value.alias("amount"),
    )


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The same orders, typed."""
    return prepare_series(
        raw_orders(spark, folder),
        F.col("priority"), F.col("month"), F.col("amount"), F.col("order_key"),
    )
