"""Query registry: a Spark callable per name and, where SQL can say it, its equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Pseudo coordinates derived from each row, written the same way on both sides.
def _geo(df: DataFrame, key: str, balance: str) -> DataFrame:
    return df.withColumn("lat", F.lit(-38.5) + (F.col(balance) + 1000) / 11000).withColumn(
        "lon", F.lit(144.3) + F.pmod(F.col(key) * 7919, F.lit(100003)) / F.lit(100003.0) * 1.4
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(table(spark, sf_dir, "customer"), "c_custkey", "c_acctbal")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(table(spark, sf_dir, "supplier"), "s_suppkey", "s_acctbal")


def _geo_sql(name: str, key: str, balance: str) -> str:
    return (
        f"SELECT *, -38.5e0 + ({balance} + 1000) / 11000 AS lat, "
        f"144.3e0 + (({key} * 7919) % 100003) / 100003e0 * 1.4e0 AS lon FROM {name}"
    )


CUSTOMERS = _geo_sql("customer", "c_custkey", "c_acctbal")
SUPPLIERS = _geo_sql("supplier", "s_suppkey", "s_acctbal")


def haversine_sql(a: str, b: str) -> str:
    return (
        f"2 * 6371.0088e0 * asin(least(1e0, sqrt(sin(radians({b}.lat - {a}.lat) / 2) * sin(radians({b}.lat - {a}.lat) / 2) "
        f"+ cos(radians({a}.lat)) * cos(radians({b}.lat)) * sin(radians({b}.lon - {a}.lon) / 2) * sin(radians({b}.lon - {a}.lon) / 2))))"
    )


# Advertised-price text of an order, one shape per order priority.
def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    text = F.format_number(price, 2)
    first = F.substring("o_orderpriority", 1, 1)
    shown = (
        F.when(first == "1", F.concat(F.lit("$"), text, F.lit(" pw")))
        .when(first == "2", F.concat(F.lit("$ "), text, F.lit(" Per Month")))
        .when(first == "3", F.concat(F.lit("From $"), text, F.lit(" per week / $"), text, F.lit(" pm")))
        .when(first == "4", F.format_string("%.2f", price))
        .otherwise(F.lit("Contact agent"))
    )
    return table(spark, sf_dir, "orders").withColumn("price_text", shown)


WEEKLY = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN round(o_totalprice, 2) WHEN '2' THEN round(o_totalprice, 2) / 4 "
    "WHEN '3' THEN round(o_totalprice, 2) WHEN '4' THEN round(o_totalprice, 2) END"
)


def cents(name: str):
    """Whole cents: sums of these are exact in doubles, whatever the order of addition."""
    return F.round(F.col(name) * 100)
