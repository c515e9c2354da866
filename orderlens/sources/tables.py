"""Order-level transactions built from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSACTION_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "category",
    "order_value",
    "contribution_margin",
    "used_discount",
    "acquisition_channel",
    "region",
)
MARGIN_RATE = "0.15"
DISCOUNT_FLOOR = 0.05


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """Zero-padded text id; keys longer than ``width`` keep all their digits."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def order_totals(lineitem: DataFrame) -> DataFrame:
    """One row per order: exact money totals and the lead line.

    The lead line has the largest price; part, line number and supplier settle ties.
    All aggregates combine on the map side, so one huge order is no hot group.
    """
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    lead = F.min(
        F.struct(
            (-F.col("l_extendedprice")).alias("negative_price"),
            "l_partkey",
            "l_linenumber",
            "l_suppkey",
            "l_discount",
        )
    )
    return lineitem.groupBy("l_orderkey").agg(
        F.round(F.sum(price * (F.lit(1).cast("decimal(1,0)") - discount)), 2)
        .cast("double")
        .alias("order_value"),
        F.round(F.sum(price * (F.lit(MARGIN_RATE).cast("decimal(4,2)") - discount)), 2)
        .cast("double")
        .alias("contribution_margin"),
        lead.alias("lead"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Contract-shaped transactions plus ``order_key``, the numeric order key.

    No join carries a broadcast hint: the planner reads the table sizes, and adaptive
    execution splits the partition of a customer or part that dominates.
    """
    totals = order_totals(read_table(spark, folder, "lineitem"))
    part = read_table(spark, folder, "part").select("p_partkey", "p_type")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region").select("r_regionkey", "r_name")
    customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(part, F.col("lead.l_partkey") == F.col("p_partkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("order_key"),
            padded_id("O", F.col("o_orderkey"), 10).alias("order_id"),
            padded_id("C", F.col("o_custkey"), 8).alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("p_type").alias("category"),
            "order_value",
            "contribution_margin",
            (F.col("lead.l_discount") >= DISCOUNT_FLOOR).cast("int").alias("used_discount"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            F.col("r_name").alias("region"),
        )
    )
