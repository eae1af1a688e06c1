"""Typed reading of receipt lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.schema import TRANSACTIONS
from tillsight.sources.storage import in_effect


def load_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Receipt lines with the declared types.

    Files must hold the declared columns, in their order, and no others; Parquet files must hold them
    with the declared types. Anything else raises at once. A malformed CSV line fails the job. Of a table
    that ``write_table`` wrote, the version in effect is read.
    """
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        _require(path, header, TRANSACTIONS.fieldNames())
        reader = spark.read.schema(TRANSACTIONS).option("enforceSchema", False)
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    if fmt == "parquet":
        path = in_effect(spark, path)
        # the schemas of all files, so that one file that differs is found too
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        _require(path, *([f"{f.name} {f.dataType.simpleString()}" for f in s] for s in (found, TRANSACTIONS)))
        return spark.read.schema(TRANSACTIONS).parquet(path)
    raise ValueError(f"unknown format {fmt!r}")


def _require(path: str, found: list[str], declared: list[str]) -> None:
    if found != declared:
        wrong = [f"{a} instead of {b}" for a, b in zip(found, declared) if a != b]
        wrong += [f"missing {b}" for b in declared[len(found) :]]
        wrong += [f"not declared: {a}" for a in found[len(declared) :]]
        raise ValueError(f"{path} does not hold receipt lines: {', '.join(wrong)}")


def transactions_from_orders(
    lineitem: DataFrame, orders: DataFrame, partitions: int | None = None
) -> DataFrame:
    """Receipt lines out of an order / order-line pair, by the fixed rules of FIXTURES.md.

    Whole-number arithmetic only, so any engine gives the same values. With ``partitions``, both sides are dealt by
    order to so many, and what is grouped by basket afterwards moves no line again.
    """
    line = lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("ordered"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("share"),
    )
    order = orders.select(
        "o_orderkey",
        "o_custkey",
        F.expr("datediff(o_orderdate, DATE'1995-01-01') * 711 div 2405 + 1").alias("day"),
    )
    quantity = F.when((F.col("o_orderkey") % 97 == 0) | (F.col("k") % 179 == 0), 0).otherwise(
        F.col("ordered")
    )
    sales = F.when((F.col("quantity") == 0) & (F.col("k") % 358 != 0), 0).otherwise(
        F.col("price") - F.col("disc")
    )
    retail = F.when(F.col("k") % 997 == 0, F.col("disc")).otherwise(-F.col("disc"))
    coupon = F.when(F.col("k") % 17 == 0, -50 * (1 + F.col("k") % 4)).otherwise(0)
    match = (
        F.when(F.col("k") % 2023 == 0, -300)
        .when(F.col("k") % 34 == 0, -25 * (1 + F.col("k") % 4))
        .otherwise(0)
    )

    def money(cents):
        return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(
            "decimal(12,2)"
        )

    if partitions:
        line, order = line.repartition(partitions, "l_orderkey"), order.repartition(partitions, "o_orderkey")
    # what follows from other columns is computed after the join, and not moved
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(
        {
            "k": F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey") * 3,
            "disc": F.expr("(price * share + 50) div 100"),
        }
    )
    return joined.withColumn("quantity", quantity).select(
        F.col("o_custkey").cast("int").alias("household_key"),
        F.col("o_orderkey").alias("basket_id"),
        F.col("day").cast("smallint").alias("day"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        money(sales).alias("sales_value"),
        (F.col("o_orderkey") % 25).cast("int").alias("store_id"),
        money(retail).alias("retail_disc"),
        F.expr("((o_orderkey * 37 % 24) * 100 + o_orderkey * 53 % 60)")
        .cast("smallint")
        .alias("trans_time"),
        F.expr("(day + 1) div 7 + 1").cast("smallint").alias("week_no"),
        money(coupon).alias("coupon_disc"),
        money(match).alias("coupon_match_disc"),
    )
