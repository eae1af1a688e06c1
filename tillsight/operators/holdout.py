"""Holdout outcomes and the model input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import (
    as_cents,
    bitmap,
    bitmap_bucket,
    bitmap_values,
    count_where,
    from_cents,
)
from tillsight.operators.baskets import valid_in_holdout
from tillsight.operators.checks import reconcile
from tillsight.schema import CUSTOMER_HOLDOUT, Params

# fixed values: the columns of the view, in its order
MODEL_INPUT = [
    "household_key",
    "frequency",
    "recency_days",
    "observation_days",
    "prediction_horizon_days",
    "actual_holdout_baskets",
    "actual_holdout_purchase_days",
    "actual_holdout_active_weeks",
    "actual_holdout_sales",
    "was_active_in_holdout",
    "in_sample_baskets",
    "active_weeks",
    "days_since_last_purchase",
    "historical_sales",
    "average_basket_value",
    "historical_quantity",
    "retail_discount_basket_rate",
    "retail_discount_per_basket",
    "total_retail_discount",
    "manufacturer_coupon_basket_rate",
    "total_manufacturer_coupon",
    "manufacturer_coupon_amount_per_redeeming_basket",
    "retail_coupon_match_basket_rate",
    "retail_coupon_match_per_basket",
    "total_retail_coupon_match",
    "estimated_pre_retail_discount_value",
]


def holdout_activity(fb: DataFrame, params: Params) -> DataFrame:
    """Outcomes of the households that bought in the holdout.

    Every basket gives two entries, one for the bitmap of days, with the basket's amounts, one for that of
    weeks. They are grouped by household and bucket, then the buckets are added up; both steps
    combine on the map side.
    """
    baskets = valid_in_holdout(fb, params)
    none = F.lit(0).cast("bigint")
    day = F.struct(
        F.lit("day").alias("kind"), F.col("basket_day").cast("bigint").alias("value"),
        F.lit(1).cast("bigint").alias("n"), as_cents(F.col("basket_sales_value")).alias("sales"),
    )
    week = F.struct(
        F.lit("week").alias("kind"), F.col("basket_week").cast("bigint").alias("value"),
        none.alias("n"), F.lit(None).cast("bigint").alias("sales"),
    )
    value = F.col("value")
    parts = (
        baskets.select("household_key", F.inline(F.array(day, week)))
        .groupBy("household_key", "kind", bitmap_bucket(value).alias("bucket"))
        .agg(bitmap(value).alias("bits"), F.sum("n").alias("n"), F.sum("sales").alias("sales"))
    )

    def distinct(kind: str):
        return bitmap_values(F.when(F.col("kind") == kind, F.col("bits"))).cast("int")

    return parts.groupBy("household_key").agg(
        F.sum("n").cast("int").alias("actual_holdout_baskets"),
        distinct("day").alias("actual_holdout_purchase_days"),
        distinct("week").alias("actual_holdout_active_weeks"),
        from_cents(F.sum("sales"), 16).alias("actual_holdout_sales"),
    )


def customer_holdout(cf: DataFrame, activity: DataFrame) -> DataFrame:
    """Every in-sample household; outcomes are zero where it did not buy again."""
    joined = cf.select("household_key").join(activity, "household_key", "left")
    filled = joined.select(
        "household_key",
        *[
            F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).cast(f.dataType).alias(f.name)
            for f in CUSTOMER_HOLDOUT
            if f.name.startswith("actual_")
        ],
    )
    return filled.withColumn("was_active_in_holdout", F.col("actual_holdout_baskets") > 0)


def holdout_structure_checks(ch: DataFrame) -> DataFrame:
    baskets = F.col("actual_holdout_baskets")
    days = F.col("actual_holdout_purchase_days")
    weeks = F.col("actual_holdout_active_weeks")
    sales = F.col("actual_holdout_sales")
    return ch.agg(
        F.count("*").alias("rows"),
        F.countDistinct("household_key").alias("unique_households"),
        count_where(F.col("household_key").isNull()).alias("null_household_keys"),
        count_where(baskets < 0).alias("negative_basket_counts"),
        count_where(days < 0).alias("negative_purchase_day_counts"),
        count_where(weeks < 0).alias("negative_active_week_counts"),
        count_where(sales < 0).alias("negative_sales_values"),
        count_where(days > baskets).alias("purchase_days_greater_than_baskets"),
        count_where(weeks > days).alias("active_weeks_greater_than_purchase_days"),
        count_where(F.col("was_active_in_holdout") != (baskets > 0)).alias(
            "inconsistent_active_flags"
        ),
        count_where((baskets == 0) & ((days != 0) | (weeks != 0) | (sales != 0))).alias(
            "inconsistent_zero_purchase_rows"
        ),
    )


def holdout_cohort(ch: DataFrame) -> DataFrame:
    return ch.agg(
        F.count("*").alias("holdout_rows"),
        count_where(F.col("actual_holdout_baskets") > 0).alias("purchasing_households"),
        count_where(F.col("actual_holdout_baskets") == 0).alias("zero_purchase_households"),
    )


def reconcile_holdout(ch: DataFrame, fb: DataFrame, cf: DataFrame, params: Params) -> DataFrame:
    """Baskets are summed per household before the join with the cohort, so no household's baskets
    travel one by one."""
    money = "decimal(38,2)"
    per_household = (
        valid_in_holdout(fb, params)
        .groupBy("household_key")
        .agg(F.count("*").alias("n"), F.sum("basket_sales_value").alias("sales"))
    )
    fact = per_household.join(cf.select("household_key"), "household_key", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_basket_holdout_baskets"),
        F.sum("sales").cast(money).alias("fact_basket_holdout_sales"),
    )
    table = ch.agg(
        F.sum("actual_holdout_baskets").alias("customer_holdout_baskets"),
        F.sum("actual_holdout_sales").cast(money).alias("customer_holdout_sales"),
    )
    return reconcile(
        fact,
        table,
        {
            "basket_difference": ("fact_basket_holdout_baskets", "customer_holdout_baskets"),
            "sales_difference": ("fact_basket_holdout_sales", "customer_holdout_sales"),
        },
    )


def holdout_only_households(fb: DataFrame, cf: DataFrame, params: Params) -> DataFrame:
    buyers = valid_in_holdout(fb, params).select("household_key").distinct()
    return buyers.join(cf.select("household_key"), "household_key", "left_anti").agg(
        F.count("*").alias("holdout_only_households")
    )


def bgnbd_model_input(cf: DataFrame, ch: DataFrame, params: Params) -> DataFrame:
    horizon = F.lit(params.prediction_horizon_days).cast("int")
    return (
        cf.filter(F.col("is_bgnbd_eligible"))
        .join(ch, "household_key")
        .withColumn("prediction_horizon_days", horizon)
        .select(*MODEL_INPUT)
    )


def model_input_checks(mi: DataFrame) -> DataFrame:
    return mi.agg(
        F.count("*").alias("model_rows"),
        F.countDistinct("household_key").alias("unique_households"),
        count_where(F.col("frequency").isNull()).alias("null_frequency"),
        count_where(F.col("recency_days").isNull()).alias("null_recency"),
        count_where(F.col("observation_days").isNull()).alias("null_observation_time"),
        count_where(F.col("prediction_horizon_days").isNull()).alias("null_prediction_horizon"),
        count_where(F.col("actual_holdout_baskets").isNull()).alias("null_holdout_baskets"),
        count_where(F.col("actual_holdout_baskets") < 0).alias("negative_holdout_baskets"),
    )


def horizon_uniqueness(mi: DataFrame) -> DataFrame:
    horizon = "prediction_horizon_days"
    return mi.agg(
        F.countDistinct(horizon).alias("distinct_horizons"),
        F.min(horizon).alias("min_horizon_days"),
        F.max(horizon).alias("max_horizon_days"),
    )


def model_input_sample(mi: DataFrame, n: int = 20) -> DataFrame:
    return (
        mi.select(
            "household_key", "frequency", "recency_days", "observation_days",
            "prediction_horizon_days", "actual_holdout_baskets", "in_sample_baskets",
            "historical_sales", "retail_discount_basket_rate", "manufacturer_coupon_basket_rate",
            "retail_coupon_match_basket_rate",
        )
        .orderBy("household_key")
        .limit(n)
    )
