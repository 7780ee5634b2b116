"""Scans of the parquet tables, and the market-shaped views of them that the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: symbol, session, open, close, volume; first and last line of the day give open and close.

    A line's place and its price in cents are one number, which a hash aggregate can hold (a struct would have to be sorted).
    """
    line = scan(spark, sf_dir, "lineitem")
    order = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("decimal(20,0)") * F.lit(10**12).cast("decimal(13,0)") + F.round(F.col("l_extendedprice") * 100).cast("decimal(12,0)")
    return line.groupBy(F.concat("l_returnflag", "l_linestatus").alias("symbol"), F.to_date("l_shipdate").alias("session")).agg(
        F.min_by("l_extendedprice", order).alias("open"), F.max_by("l_extendedprice", order).alias("close"), F.sum("l_quantity").alias("volume")
    )


BARS_SQL = """bars AS (SELECT l_returnflag || l_linestatus AS symbol, l_shipdate::DATE AS session,
    arg_min(l_extendedprice, (l_orderkey * 100 + l_linenumber, l_extendedprice)) AS open, arg_max(l_extendedprice, (l_orderkey * 100 + l_linenumber, l_extendedprice)) AS close,
    sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded signals: record_id, family, direction, generated_at, symbol, universe version."""
    o = scan(spark, sf_dir, "orders")
    flags, status = F.array(*map(F.lit, "ANR")), F.array(F.lit("F"), F.lit("O"))
    symbol = F.concat(F.get(flags, F.col("o_orderkey") % 3), F.get(status, F.floor(F.col("o_orderkey") / 3) % 2))
    direction = F.when(F.col("o_orderstatus") == "F", "long").when(F.col("o_orderstatus") == "O", "short").otherwise("none")
    return o.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderpriority").alias("family"), direction.alias("direction"), F.to_date("o_orderdate").alias("generated_on"), symbol.alias("symbol"), F.col("o_totalprice").alias("strength"))


SIGNALS_SQL = """signals AS (SELECT o_orderkey AS record_id, o_orderpriority AS family,
    CASE o_orderstatus WHEN 'F' THEN 'long' WHEN 'O' THEN 'short' ELSE 'none' END AS direction, o_orderdate::DATE AS generated_on,
    (['A', 'N', 'R'])[(o_orderkey % 3) + 1] || (['F', 'O'])[((o_orderkey // 3) % 2) + 1] AS symbol, o_totalprice AS strength FROM orders)"""
