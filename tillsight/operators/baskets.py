"""Time-split parameters and the basket fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import as_cents, count_where, exact_average, from_cents, percent
from tillsight.operators.checks import reconcile
from tillsight.schema import FACT_BASKET, PROJECT_PARAMETERS, Params

KEYS = ["household_key", "basket_id"]


def period_bounds(in_end: int = 78, ho_start: int = 79, ho_end: int = 102) -> dict[str, Column]:
    """Days that bound the periods, as aggregates of receipt lines."""
    week, day = F.col("week_no"), F.col("day")
    return {
        "in_sample_end_day": F.max(F.when(week == in_end, day)),
        "holdout_start_day": F.min(F.when(week == ho_start, day)),
        "holdout_end_day": F.max(F.when(week == ho_end, day)),
    }


def parameter_row(
    bounds: DataFrame, in_end: int = 78, ho_start: int = 79, ho_end: int = 102, weeks: int = 24
) -> DataFrame:
    """The parameter row from one row of :func:`period_bounds`."""
    fixed = {
        "parameter_id": 1,
        "in_sample_end_week": in_end,
        "holdout_start_week": ho_start,
        "holdout_end_week": ho_end,
        "holdout_weeks": weeks,
    }
    row = bounds.withColumns({name: F.lit(value) for name, value in fixed.items()})
    return row.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PROJECT_PARAMETERS]
    )


def project_parameters(
    tx: DataFrame, in_end: int = 78, ho_start: int = 79, ho_end: int = 102, weeks: int = 24
) -> DataFrame:
    """The parameter row: week bounds as given, day bounds as observed in those weeks."""
    days = period_bounds(in_end, ho_start, ho_end)
    bounds = tx.filter(F.col("week_no").isin(in_end, ho_start, ho_end)).agg(
        *[day.alias(name) for name, day in days.items()]
    )
    return parameter_row(bounds, in_end, ho_start, ho_end, weeks)


def read_params(parameters: DataFrame) -> Params:
    """The one parameter row on the driver."""
    return Params.from_row(parameters.filter(F.col("parameter_id") == 1).first())


def parameter_validation(parameters: DataFrame) -> DataFrame:
    c = {f: F.col(f).cast("int") for f in PROJECT_PARAMETERS.fieldNames()}
    return parameters.filter(F.col("parameter_id") == 1).select(
        *PROJECT_PARAMETERS.fieldNames(),
        (c["holdout_start_week"] - c["in_sample_end_week"] - 1).alias("unobserved_gap_weeks"),
        (c["holdout_start_day"] - c["in_sample_end_day"] - 1).alias("unobserved_gap_days"),
        (c["holdout_end_week"] - c["holdout_start_week"] + 1).alias("calculated_holdout_weeks"),
        (c["holdout_end_day"] - c["holdout_start_day"] + 1).alias("observed_holdout_days"),
        (c["holdout_end_day"] - c["in_sample_end_day"]).alias("prediction_horizon_days"),
    )


# Attributes that a basket has one value of, by their columns in the lines.
ONE_PER_BASKET = {"day": "day", "week": "week_no", "store": "store_id"}


def fact_basket(tx: DataFrame, audited: bool = False) -> DataFrame:
    """One row per household and basket, by two aggregations.

    With ``audited``, further columns ``several_day``, ``several_week`` and ``several_store`` tell
    whether the basket's lines differ there.


    The first is by product within the basket: the lines of a basket of any size spread over all
    tasks by product. The second counts the products and adds up the rest, and combines on the map
    side. Money is summed as whole cents: a long sum stays in the fast aggregation buffer.
    """
    products = tx.groupBy(*KEYS, "product_id").agg(
        F.min("day").alias("day"),
        F.min("week_no").alias("week"),
        F.min("store_id").alias("store"),
        F.min("trans_time").alias("time"),
        F.count("*").alias("lines"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum(as_cents(F.col("sales_value"))).alias("sales"),
        F.sum(as_cents(F.col("retail_disc"))).alias("retail"),
        F.sum(as_cents(F.col("coupon_disc"))).alias("coupon"),
        F.sum(as_cents(F.col("coupon_match_disc"))).alias("match"),
        F.bool_or(F.col("retail_disc") < 0).alias("with_retail"),
        F.bool_or(F.col("coupon_disc") < 0).alias("with_coupon"),
        F.bool_or(F.col("coupon_match_disc") < 0).alias("with_match"),
        F.bool_or(F.col("quantity") > 0).alias("bought"),
        *[F.max(column).alias(f"last_{c}") for c, column in ONE_PER_BASKET.items() if audited],
    )
    rows = products.groupBy(*KEYS).agg(
        F.min("day").alias("basket_day"),
        F.min("week").alias("basket_week"),
        F.min("store").alias("store_id"),
        F.min("time").alias("basket_trans_time"),
        F.sum("lines").alias("basket_product_lines_count"),
        F.count("product_id").alias("basket_unique_product_count"),
        F.sum("quantity").alias("basket_total_quantity"),
        F.sum("sales").alias("sales"),
        F.sum("retail").alias("retail"),
        F.sum("coupon").alias("coupon"),
        F.sum("match").alias("match"),
        F.bool_or("with_retail").alias("has_retail_discount"),
        F.bool_or("with_coupon").alias("has_manufacturer_coupon"),
        F.bool_or("with_match").alias("has_retail_coupon_match"),
        F.bool_or("bought").alias("is_valid_purchase_basket"),
        *[(F.min(c) != F.max(f"last_{c}")).alias(f"several_{c}") for c in ONE_PER_BASKET if audited],
    )
    money = {
        "basket_sales_value": F.col("sales"),
        "retail_discount_amount": -F.col("retail"),
        "manufacturer_coupon_amount": -F.col("coupon"),
        "retail_coupon_match_amount": -F.col("match"),
        "estimated_pre_retail_discount_value": F.col("sales") - F.col("retail") - F.col("match"),
    }
    return rows.select(
        *[
            (from_cents(money[f.name], 14) if f.name in money else F.col(f.name).cast(f.dataType)).alias(
                f.name
            )
            for f in FACT_BASKET
        ],
        *[f"several_{c}" for c in ONE_PER_BASKET if audited],
    )


def reconcile_basket_count(tx: DataFrame, fb: DataFrame) -> DataFrame:
    raw = tx.agg(F.countDistinct("basket_id").alias("raw_distinct_baskets"))
    fact = fb.agg(F.count("*").alias("fact_basket_rows"))
    return reconcile(raw, fact, {"difference": ("raw_distinct_baskets", "fact_basket_rows")})


def reconcile_line_count(tx: DataFrame, fb: DataFrame) -> DataFrame:
    raw = tx.agg(F.count("*").alias("raw_transaction_lines"))
    fact = fb.agg(F.sum("basket_product_lines_count").alias("fact_transaction_lines"))
    return reconcile(
        raw, fact, {"difference": ("raw_transaction_lines", "fact_transaction_lines")}
    )


def reconcile_measures(tx: DataFrame, fb: DataFrame) -> DataFrame:
    money = "decimal(38,2)"
    raw = tx.agg(
        F.sum("quantity").alias("raw_quantity"),
        F.sum("sales_value").cast(money).alias("raw_sales"),
        (-F.sum("retail_disc")).cast(money).alias("raw_retail_discount"),
        (-F.sum("coupon_disc")).cast(money).alias("raw_manufacturer_coupon"),
        (-F.sum("coupon_match_disc")).cast(money).alias("raw_retail_coupon_match"),
    )
    fact = fb.agg(
        F.sum("basket_total_quantity").alias("fact_quantity"),
        F.sum("basket_sales_value").cast(money).alias("fact_sales"),
        F.sum("retail_discount_amount").cast(money).alias("fact_retail_discount"),
        F.sum("manufacturer_coupon_amount").cast(money).alias("fact_manufacturer_coupon"),
        F.sum("retail_coupon_match_amount").cast(money).alias("fact_retail_coupon_match"),
    )
    measures = ["quantity", "sales", "retail_discount", "manufacturer_coupon", "retail_coupon_match"]
    return reconcile(raw, fact, {f"{m}_difference": (f"raw_{m}", f"fact_{m}") for m in measures})


def negative_discount_baskets(fb: DataFrame) -> DataFrame:
    return fb.agg(
        count_where(F.col("retail_discount_amount") < 0).alias("negative_retail_discount_amounts"),
        count_where(F.col("manufacturer_coupon_amount") < 0).alias(
            "negative_manufacturer_coupon_amounts"
        ),
        count_where(F.col("retail_coupon_match_amount") < 0).alias(
            "negative_retail_coupon_match_amounts"
        ),
    )


def valid_basket_summary(fb: DataFrame) -> DataFrame:
    return (
        fb.groupBy("is_valid_purchase_basket")
        .agg(
            F.count("*").alias("baskets"),
            F.sum("basket_sales_value").cast("decimal(38,2)").alias("recorded_sales"),
            F.sum("basket_total_quantity").alias("recorded_quantity"),
        )
        .orderBy(F.desc_nulls_first("is_valid_purchase_basket"))
    )


def invalid_basket_listing(fb: DataFrame, n: int = 100) -> DataFrame:
    return (
        fb.filter(~F.col("is_valid_purchase_basket"))
        .select(
            "household_key", "basket_id", "basket_day", "basket_week", "basket_trans_time",
            "basket_product_lines_count", "basket_unique_product_count", "basket_total_quantity",
            "basket_sales_value", "manufacturer_coupon_amount", "retail_discount_amount",
        )
        .orderBy(F.desc_nulls_first("basket_sales_value"), "basket_id", "household_key")
        .limit(n)
    )


def valid_in_sample(fb: DataFrame, params: Params) -> DataFrame:
    return fb.filter(
        (F.col("basket_day") <= params.in_sample_end_day) & F.col("is_valid_purchase_basket")
    )


def valid_in_holdout(fb: DataFrame, params: Params) -> DataFrame:
    inside = F.col("basket_day").between(params.holdout_start_day, params.holdout_end_day)
    return fb.filter(inside & F.col("is_valid_purchase_basket"))


def period_activity(fb: DataFrame, params: Params) -> DataFrame:
    """Baskets and sales per household and period first, so that active households are a count."""
    day = F.col("basket_day")
    period = (
        F.when(day <= params.in_sample_end_day, "In-sample")
        .when(day.between(params.holdout_start_day, params.holdout_end_day), "Holdout")
        .otherwise("Outside analysis")
    )
    return (
        fb.filter(F.col("is_valid_purchase_basket"))
        .groupBy(period.alias("period"), "household_key")
        .agg(
            F.count("*").alias("n"),
            F.sum(as_cents(F.col("basket_sales_value"))).alias("cents"),
            F.min(day).alias("first_day"),
        )
        .groupBy("period")
        .agg(
            F.sum("n").alias("purchase_baskets"),
            F.count("household_key").alias("active_households"),
            from_cents(F.sum("cents"), 18).alias("recorded_sales"),
            F.min("first_day").alias("first_day"),
        )
        .orderBy("first_day")
        .drop("first_day")
    )


def customer_overlap(fb: DataFrame, params: Params) -> DataFrame:
    """Membership in both periods from one pass over the baskets, without a join."""
    day = F.col("basket_day")
    known = F.col("household_key").isNotNull()
    inside, after = F.col("is_in_sample"), F.col("is_in_holdout")
    counted = (
        fb.filter(F.col("is_valid_purchase_basket") & known)
        .groupBy("household_key")
        .agg(
            F.bool_or(day <= params.in_sample_end_day).alias("is_in_sample"),
            F.bool_or(day.between(params.holdout_start_day, params.holdout_end_day)).alias(
                "is_in_holdout"
            ),
        )
        .filter(inside | after)
        .agg(
            F.count("*").alias("total_households_observed"),
            count_where(inside).alias("in_sample_households"),
            count_where(after).alias("holdout_households"),
            count_where(inside & after).alias("households_in_both_periods"),
            count_where(inside & ~after).alias("in_sample_only_households"),
            count_where(~inside & after).alias("holdout_only_households"),
        )
    )
    return counted.withColumn(
        "pct_in_sample_active_in_holdout",
        percent(F.col("households_in_both_periods"), F.col("in_sample_households"), 1),
    )


def estimated_customer_payment(tx: DataFrame) -> DataFrame:
    """What the customer paid, and unit values before and after retailer discounts."""
    sales, quantity = F.col("sales_value"), F.col("quantity")
    full = (sales - F.col("retail_disc") - F.col("coupon_match_disc")).cast("decimal(14,2)")

    def per_unit(amount):
        cents = as_cents(amount)
        return exact_average(F.when(quantity < 0, -cents).otherwise(cents), F.abs(quantity), 4, 18)

    return tx.select(
        *KEYS,
        "product_id",
        "quantity",
        "sales_value",
        (sales + F.col("coupon_disc")).cast("decimal(14,2)").alias("estimated_customer_payment"),
        full.alias("pre_retail_discount_value"),
        per_unit(full).alias("pre_discount_value_per_unit"),
        per_unit(sales).alias("discounted_value_per_unit"),
    )
