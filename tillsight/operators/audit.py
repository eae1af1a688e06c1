"""Audit of receipt lines.

Distinct counts over the big table are taken from a first aggregate at basket grain, or as one
distinct column on its own, so no plan multiplies the receipt lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import (
    as_cents,
    count_where,
    exact_average,
    half_up_quotient,
    percent,
    scaled,
)
from tillsight.functions.ordering import count_quantiles
from tillsight.schema import TRANSACTIONS
from tillsight.sources.storage import materialize

LISTED = [
    "household_key",
    "basket_id",
    "day",
    "product_id",
    "quantity",
    "sales_value",
    "retail_disc",
    "coupon_disc",
    "coupon_match_disc",
    "store_id",
]
DISCOUNTS = ["retail_disc", "coupon_disc", "coupon_match_disc"]


def _listed(df: DataFrame, *order) -> DataFrame:
    """All rows in order. A row number ends the sort key, so that very many copies of one row can
    still be sorted by several tasks."""
    return (
        df.withColumn("_row", F.monotonically_increasing_id()).orderBy(*order, "_row").drop("_row")
    )


def dataset_overview(tx: DataFrame) -> DataFrame:
    per_basket = tx.groupBy("household_key", "basket_id", "store_id").agg(
        F.count("*").alias("n"),
        F.min("day").alias("d0"),
        F.max("day").alias("d1"),
        F.min("week_no").alias("w0"),
        F.max("week_no").alias("w1"),
    )
    totals = per_basket.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("transaction_rows"),
        F.countDistinct("household_key").alias("households"),
        F.countDistinct("basket_id").alias("baskets"),
        F.countDistinct("store_id").alias("stores"),
        F.min("d0").alias("first_day"),
        F.max("d1").alias("last_day"),
        F.min("w0").alias("first_week"),
        F.max("w1").alias("last_week"),
    )
    products = tx.agg(F.countDistinct("product_id").alias("products"))
    return totals.crossJoin(F.broadcast(products)).select(
        "transaction_rows", "households", "baskets", "products", "stores",
        "first_day", "last_day", "first_week", "last_week",
    )


def null_counts(tx: DataFrame) -> DataFrame:
    return tx.agg(
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in TRANSACTIONS.fieldNames()]
    )


def weekly_coverage(tx: DataFrame) -> DataFrame:
    per_basket = tx.groupBy("week_no", "day", "basket_id", "household_key").agg(
        F.count("*").alias("n")
    )
    return (
        per_basket.groupBy("week_no")
        .agg(
            F.min("day").alias("minimum_day"),
            F.max("day").alias("maximum_day"),
            F.countDistinct("day").alias("observed_days"),
            F.sum("n").alias("product_lines"),
            F.countDistinct("basket_id").alias("baskets"),
            F.countDistinct("household_key").alias("households"),
        )
        .orderBy("week_no")
    )


def day_week_violations(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("day")
        .agg(F.countDistinct("week_no").alias("week_count"))
        .filter(F.col("week_count") > 1)
    )


def boundary_weeks(tx: DataFrame, low: int = 76, high: int = 81) -> DataFrame:
    return (
        tx.filter(F.col("week_no").between(low, high))
        .groupBy("week_no")
        .agg(
            F.min("day").alias("minimum_day"),
            F.max("day").alias("maximum_day"),
            F.countDistinct("day").alias("observed_days"),
        )
        .orderBy("week_no")
    )


def basket_attribute_consistency(tx: DataFrame) -> DataFrame:
    """A basket has more than one value exactly when its smallest and largest differ."""
    attributes = {
        "household_key": "multi_household_baskets",
        "day": "multi_day_baskets",
        "week_no": "multi_week_baskets",
        "store_id": "multi_store_baskets",
        "trans_time": "multi_trans_time_baskets",
    }
    spread = [
        e
        for c in attributes
        for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))
    ]
    return (
        tx.groupBy("basket_id")
        .agg(*spread)
        .agg(
            F.count("*").alias("baskets_checked"),
            *[
                count_where(F.col(f"{c}_min") != F.col(f"{c}_max")).alias(name)
                for c, name in attributes.items()
            ],
        )
    )


def baskets_with_repeated_product(tx: DataFrame) -> DataFrame:
    """A basket repeats when a product has two lines in it, or when a line has no product."""
    return (
        tx.groupBy("basket_id", "product_id")
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") > 1) | F.col("product_id").isNull())
        .groupBy("basket_id")
        .agg(F.lit(1).alias("one"))
        .agg(F.count("*").alias("baskets_with_repeated_product"))
    )


def _summed(condition, n: str = "n"):
    return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0)).cast("bigint")


def basket_size_distribution(tx: DataFrame) -> DataFrame:
    sizes = tx.groupBy("basket_id").agg(F.count("*").alias("value"))
    counts = materialize(sizes.groupBy("value").agg(F.count("*").alias("n")), "basket_sizes")
    spread = count_quantiles(
        counts,
        {"median_product_lines": 0.50, "p90_product_lines": 0.90, "p99_product_lines": 0.99},
    )
    totals = counts.agg(
        F.min("value").alias("min_product_lines"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("avg_product_lines"),
        F.max("value").alias("max_product_lines"),
    )
    return totals.crossJoin(F.broadcast(spread)).select(
        "min_product_lines", "avg_product_lines", *spread.columns, "max_product_lines"
    )


def exact_duplicates(tx: DataFrame) -> DataFrame:
    """One scan and one exchange: equal lines combine on the map side."""
    return (
        tx.groupBy(*TRANSACTIONS.fieldNames())
        .agg(F.count("*").alias("identical_rows"))
        .filter(F.col("identical_rows") > 1)
        .agg(
            F.count("*").alias("duplicated_patterns"),
            F.coalesce(F.sum(F.col("identical_rows") - 1), F.lit(0)).alias("extra_rows"),
        )
    )


def quantity_profile(tx: DataFrame) -> DataFrame:
    """From the counts of each quantity, one scan of the lines."""
    sales, value, n = F.col("sales_value"), F.col("value"), F.col("n")
    counts = materialize(
        tx.groupBy(F.col("quantity").alias("value")).agg(
            F.count("*").alias("n"),
            count_where(sales < 0).alias("negative_sales"),
            count_where(sales == 0).alias("zero_sales"),
        ),
        "quantities",
    )
    spread = count_quantiles(counts, {"median_quantity": 0.50, "p99_quantity": 0.99})
    total = F.sum(value.cast("bigint") * n)
    totals = counts.agg(
        _summed(value < 0).alias("negative_quantity_rows"),
        _summed(value == 0).alias("zero_quantity_rows"),
        _summed(value > 0).alias("positive_quantity"),
        _summed(value > 100).alias("quantity_over_100"),
        _summed(F.lit(True), "negative_sales").alias("negative_sales_rows"),
        _summed(F.lit(True), "zero_sales").alias("zero_sales_rows"),
        F.min(value).alias("minimum_quantity"),
        scaled(half_up_quotient(total, F.sum(F.when(value.isNotNull(), n)), 2), 2, 14).alias(
            "average_quantity"
        ),
        F.max(value).alias("maximum_quantity"),
    )
    return totals.crossJoin(F.broadcast(spread)).select(
        *totals.columns[:-1], *spread.columns, "maximum_quantity"
    )


def sales_profile(tx: DataFrame) -> DataFrame:
    """From the counts of each amount, one scan of the lines."""
    value, n = F.col("value"), F.col("n")
    counts = materialize(
        tx.groupBy(F.col("sales_value").alias("value")).agg(F.count("*").alias("n")), "amounts"
    )
    spread = count_quantiles(counts, {"p01_sales": 0.01, "median_sales": 0.50, "p99_sales": 0.99})
    totals = counts.agg(
        _summed(value < 0).alias("negative_sales"),
        _summed(value == 0).alias("zero_sales"),
        _summed(value > 0).alias("positive_sales"),
        F.min(value).alias("min_sales"),
        exact_average(
            F.sum(as_cents(value) * n), F.sum(F.when(value.isNotNull(), n)), 2, 14
        ).alias("average_sales"),
        F.max(value).alias("max_sales"),
    )
    return totals.crossJoin(F.broadcast(spread)).select(
        *totals.columns[:-1], *spread.columns, "max_sales"
    )


def zero_quantity_summary(tx: DataFrame) -> DataFrame:
    sales = F.col("sales_value")
    return tx.filter(F.col("quantity") == 0).agg(
        F.count("*").alias("zero_quantity_rows"),
        F.countDistinct("basket_id").alias("affected_baskets"),
        F.countDistinct("household_key").alias("affected_households"),
        F.countDistinct("product_id").alias("affected_products"),
        count_where(sales < 0).alias("negative_sales"),
        count_where(sales == 0).alias("zero_sales"),
        count_where(sales > 0).alias("positive_sales"),
        F.min(sales).alias("min_sales"),
        F.max(sales).alias("max_sales"),
    )


def zero_quantity_discount_mix(tx: DataFrame) -> DataFrame:
    retail, coupon, match = (F.col(c) for c in DISCOUNTS)
    return tx.filter(F.col("quantity") == 0).agg(
        F.count("*").alias("zero_quantity_rows"),
        count_where(retail != 0).alias("retail_discount_rows"),
        count_where(coupon != 0).alias("coupon_discount_rows"),
        count_where(match != 0).alias("coupon_match_rows"),
        count_where((retail == 0) & (coupon == 0) & (match == 0)).alias("no_discount_rows"),
    )


def zero_quantity_positive_sales(tx: DataFrame) -> DataFrame:
    lines = tx.filter((F.col("quantity") == 0) & (F.col("sales_value") > 0)).select(*LISTED)
    return _listed(lines, F.desc("sales_value"), "basket_id", "product_id")


def _zero_quantity_only(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("basket_id")
        .agg(F.max("quantity").alias("most"))
        .filter(F.col("most") == 0)
        .select("basket_id")
    )


def zero_quantity_only_baskets(tx: DataFrame) -> DataFrame:
    return _zero_quantity_only(tx).agg(F.count("*").alias("zero_quantity_only_baskets"))


def zero_quantity_only_profile(tx: DataFrame) -> DataFrame:
    """Lines with a positive quantity cannot be in such a basket, so they are cut before the join."""
    sales = F.col("sales_value")
    lines = tx.filter((F.col("quantity") <= 0) | F.col("quantity").isNull())
    return lines.join(_zero_quantity_only(tx), "basket_id", "left_semi").agg(
        F.countDistinct("basket_id").alias("baskets"),
        F.countDistinct("household_key").alias("households"),
        F.count("*").alias("zero_quantity_rows"),
        count_where(sales == 0).alias("zero_sales_rows"),
        count_where(sales > 0).alias("positive_sales_rows"),
        F.countDistinct(F.when(sales > 0, F.col("basket_id"))).alias("baskets_with_positive_sales"),
        F.sum(sales).cast("decimal(38,2)").alias("total_sales"),
    )


def discount_incidence(tx: DataFrame) -> DataFrame:
    return tx.agg(
        count_where(F.col("retail_disc") != 0).alias("retail_disc_rows"),
        count_where(F.col("coupon_disc") != 0).alias("manufacturer_coupon_disc_rows"),
        count_where(F.col("coupon_match_disc") != 0).alias("retail_coupon_match_disc_rows"),
    )


def discount_sign_audit(tx: DataFrame) -> DataFrame:
    """All three discount columns in one scan: one row of totals, turned into three."""
    entries = []
    totals = []
    for c in DISCOUNTS:
        value = F.col(c)
        named = {
            "negative_rows": count_where(value < 0),
            "zero_rows": count_where(value == 0),
            "positive_rows": count_where(value > 0),
            "minimum_value": F.min(value),
            "maximum_value": F.max(value),
        }
        totals += [e.alias(f"{c}_{name}") for name, e in named.items()]
        entries.append(
            F.struct(
                F.lit(c).alias("discount_type"),
                *[F.col(f"{c}_{name}").alias(name) for name in named],
            )
        )
    return tx.agg(*totals).select(F.inline(F.array(*entries)))


def positive_retail_discounts(tx: DataFrame) -> DataFrame:
    lines = tx.filter(F.col("retail_disc") > 0).select(*LISTED)
    return _listed(lines, F.desc("retail_disc"), "basket_id", "product_id")


def _lines_of_positive_retail_baskets(tx: DataFrame) -> DataFrame:
    affected = tx.filter(F.col("retail_disc") > 0).select("basket_id")
    return tx.join(affected, "basket_id", "left_semi")


def baskets_with_positive_retail(tx: DataFrame) -> DataFrame:
    lines = _lines_of_positive_retail_baskets(tx).select(*TRANSACTIONS.fieldNames())
    return _listed(lines, "basket_id", "product_id")


def positive_retail_basket_summary(tx: DataFrame) -> DataFrame:
    return (
        _lines_of_positive_retail_baskets(tx)
        .groupBy("basket_id")
        .agg(
            F.count("*").alias("total_rows"),
            count_where(F.col("quantity") > 0).alias("positive_quantity_rows"),
            count_where(F.col("quantity") == 0).alias("zero_quantity_rows"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("sales_value").cast("decimal(38,2)").alias("basket_sales"),
        )
        .orderBy("basket_id")
    )


def discount_relationships(tx: DataFrame) -> DataFrame:
    retail, coupon, match = (F.col(c) for c in DISCOUNTS)
    return tx.agg(
        count_where((retail != 0) | (coupon != 0) | (match != 0)).alias(
            "product_lines_with_any_discount"
        ),
        count_where((match != 0) & (coupon == 0)).alias("match_without_manufacturer_coupon"),
        count_where(F.abs(match) > F.abs(coupon)).alias("match_greater_than_manufacturer_coupon"),
    )


def coupon_match_exceptions(tx: DataFrame) -> DataFrame:
    larger = F.abs(F.round("coupon_match_disc", 2)) > F.abs(F.round("coupon_disc", 2))
    return _listed(tx.filter(larger), "basket_id", "product_id")


def trans_time_range(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("trans_time").alias("min_trans_time"),
        F.max("trans_time").alias("max_trans_time"),
        count_where(F.col("trans_time").isNull()).alias("null_trans_times"),
        F.countDistinct("trans_time").alias("distinct_trans_times"),
    )


def not_a_clock_time() -> Column:
    time = F.col("trans_time")
    return (time < 0) | (time > 2359) | (time % 100 > 59)


def invalid_hhmm(tx: DataFrame) -> DataFrame:
    return tx.agg(count_where(not_a_clock_time()).alias("invalid_hhmm_values"))


def multi_time_baskets(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("basket_id")
        .agg(F.min("trans_time").alias("t0"), F.max("trans_time").alias("t1"))
        .agg(count_where(F.col("t0") != F.col("t1")).alias("baskets_with_multiple_trans_times"))
    )


def baskets_without_time(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("basket_id")
        .agg(F.count("trans_time").alias("times"))
        .agg(count_where(F.col("times") == 0).alias("baskets_without_trans_time"))
    )


def extreme_lines(tx: DataFrame, n: int = 100) -> DataFrame:
    quantity, sales = F.col("quantity"), F.col("sales_value")
    return (
        tx.filter((quantity <= 0) | (sales <= 0) | (quantity > 100) | (sales > 1000))
        .orderBy(
            F.desc_nulls_first(F.abs(sales)),
            F.desc_nulls_first(F.abs(quantity)),
            *TRANSACTIONS.fieldNames(),
        )
        .limit(n)
    )


def unusual_value_rates(tx: DataFrame) -> DataFrame:
    conditions = {
        "zero_quantity": F.col("quantity") == 0,
        "quantity_over_100": F.col("quantity") > 100,
        "zero_sales": F.col("sales_value") == 0,
        "sales_over_1000": F.col("sales_value") > 1000,
    }
    counted = tx.agg(
        F.count("*").alias("total_rows"),
        *[count_where(c).alias(f"{name}_rows") for name, c in conditions.items()],
    )
    pairs = []
    for name in conditions:
        rows = F.col(f"{name}_rows")
        pairs += [rows, percent(rows, F.col("total_rows"), 2).alias(f"{name}_pct")]
    return counted.select("total_rows", *pairs)
