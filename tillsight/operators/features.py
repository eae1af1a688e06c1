"""Purchase timing and the household feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import (
    as_cents,
    bitmap,
    bitmap_bucket,
    bitmap_values,
    count_where,
    exact_average,
    exact_ratio,
    from_cents,
    scaled,
)
from tillsight.functions.ordering import quantiles
from tillsight.operators.baskets import valid_in_sample
from tillsight.operators.checks import reconcile
from tillsight.schema import CUSTOMER_FEATURES, Params


def same_day_baskets(fb: DataFrame, params: Params) -> DataFrame:
    return (
        valid_in_sample(fb, params)
        .groupBy("household_key", "basket_day")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .agg(
            F.count("*").alias("household_days_with_multiple_baskets"),
            F.countDistinct("household_key").alias("households_with_same_day_multiple_baskets"),
            F.max("n").alias("max_baskets_same_day"),
        )
    )


def _tied_minutes(fb: DataFrame, params: Params) -> DataFrame:
    return (
        valid_in_sample(fb, params)
        .groupBy("household_key", "basket_day", "basket_trans_time")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def same_minute_baskets(fb: DataFrame, params: Params) -> DataFrame:
    return _tied_minutes(fb, params).agg(
        F.count("*").alias("duplicate_timestamp_groups"),
        F.countDistinct("household_key").alias("households_affected"),
        F.sum("n").alias("baskets_in_duplicate_timestamp_groups"),
        F.sum(F.col("n") - 1).alias("additional_baskets_due_to_timestamp_ties"),
        F.max("n").alias("max_baskets_at_same_timestamp"),
    )


def same_minute_listing(fb: DataFrame, params: Params, n: int = 100) -> DataFrame:
    """All baskets of the tied minutes, valid or not. A semi join, so that one very full minute is
    never held as one window group."""
    keys = ["household_key", "basket_day", "basket_trans_time"]
    order = [*keys, "basket_id"]
    return (
        fb.join(_tied_minutes(fb, params).select(*keys), keys, "left_semi")
        .select(*order, "store_id", "basket_sales_value", "basket_total_quantity")
        .orderBy(*order)
        .limit(n)
    )


def _time_units(day, time):
    """Time since the origin in millionths of a day, rounded once from whole minutes."""
    hour = F.call_function("div", time.cast("bigint"), F.lit(100).cast("bigint"))
    minutes = (day.cast("bigint") - 1) * 1440 + hour * 60 + time.cast("bigint") % 100
    rounded = F.call_function("div", minutes * 1_000_000 + 720, F.lit(1440).cast("bigint"))
    return rounded


def purchase_time_days(fb: DataFrame, params: Params) -> DataFrame:
    units = _time_units(F.col("basket_day"), F.col("basket_trans_time"))
    return valid_in_sample(fb, params).select(
        "household_key",
        "basket_id",
        "basket_day",
        "basket_trans_time",
        scaled(units, 6, 14).alias("purchase_time_days"),
    )


def customer_features(fb: DataFrame, params: Params) -> DataFrame:
    """Timing and profile features of each household.

    All sums are longs. The first aggregation is by household and bucket of its bitmap of weeks, which
    leaves a row for each 63 weeks; the second adds the buckets up. Both combine on the map side, so a
    household with very many baskets is a few rows before any shuffle, and weeks have no range.
    """
    baskets = valid_in_sample(fb, params)
    when = _time_units(F.col("basket_day"), F.col("basket_trans_time"))
    week = F.col("basket_week")

    def users(flag: str):
        return F.sum(F.col(flag).cast("bigint"))

    least, most = {"first": F.min(when)}, {"last": F.max(when)}
    sums = {
        "n": F.count("*"),
        "sales": F.sum(as_cents(F.col("basket_sales_value"))),
        "sales_n": F.count("basket_sales_value"),
        "historical_quantity": F.sum("basket_total_quantity"),
        "retail_users": users("has_retail_discount"),
        "retail_flags": F.count("has_retail_discount"),
        "retail": F.sum(as_cents(F.col("retail_discount_amount"))),
        "retail_n": F.count("retail_discount_amount"),
        "coupon_users": users("has_manufacturer_coupon"),
        "coupon_flags": F.count("has_manufacturer_coupon"),
        "coupon": F.sum(as_cents(F.col("manufacturer_coupon_amount"))),
        "match_users": users("has_retail_coupon_match"),
        "match_flags": F.count("has_retail_coupon_match"),
        "match": F.sum(as_cents(F.col("retail_coupon_match_amount"))),
        "match_n": F.count("retail_coupon_match_amount"),
        "pre": F.sum(as_cents(F.col("estimated_pre_retail_discount_value"))),
    }
    parts = baskets.groupBy("household_key", bitmap_bucket(week).alias("bucket")).agg(
        bitmap(week).alias("weeks"),
        *[f.alias(name) for name, f in {**least, **most, **sums}.items()],
    )
    grouped = parts.groupBy("household_key").agg(
        bitmap_values("weeks").alias("active_weeks"),
        *[F.min(name).alias(name) for name in least],
        *[F.max(name).alias(name) for name in most],
        *[F.sum(name).alias(name) for name in sums],
    )
    c = {name: F.col(name) for name in grouped.columns}
    end = F.lit(params.in_sample_end_day * 1_000_000).cast("bigint")
    values = {
        "household_key": c["household_key"],
        "in_sample_baskets": c["n"],
        "first_purchase_time_days": scaled(c["first"], 6, 14),
        "last_purchase_time_days": scaled(c["last"], 6, 14),
        "frequency": c["n"] - 1,
        "recency_days": scaled(c["last"] - c["first"], 6, 14),
        "observation_days": scaled(end - c["first"], 6, 14),
        "days_since_last_purchase": scaled(end - c["last"], 6, 14),
        "active_weeks": c["active_weeks"],
        "historical_sales": from_cents(c["sales"], 16),
        "average_basket_value": exact_average(c["sales"], c["sales_n"], 2, 14),
        "historical_quantity": c["historical_quantity"],
        "retail_discount_basket_rate": exact_ratio(c["retail_users"], c["retail_flags"], 6, 12),
        "retail_discount_per_basket": exact_average(c["retail"], c["retail_n"], 4, 14),
        "total_retail_discount": from_cents(c["retail"], 16),
        "manufacturer_coupon_basket_rate": exact_ratio(
            c["coupon_users"], c["coupon_flags"], 6, 12
        ),
        "total_manufacturer_coupon": from_cents(c["coupon"], 16),
        "manufacturer_coupon_amount_per_redeeming_basket": exact_average(
            c["coupon"], c["coupon_users"], 4, 14
        ),
        "retail_coupon_match_basket_rate": exact_ratio(c["match_users"], c["match_flags"], 6, 12),
        "retail_coupon_match_per_basket": exact_average(c["match"], c["match_n"], 4, 14),
        "total_retail_coupon_match": from_cents(c["match"], 16),
        "estimated_pre_retail_discount_value": from_cents(c["pre"], 16),
    }
    recency, observed = c["last"] - c["first"], end - c["first"]
    eligible = (
        (c["n"] >= 1)
        & (recency >= 0)
        & (observed > 0)
        & (recency <= observed)
        & (((c["n"] == 1) & (recency == 0)) | ((c["n"] > 1) & (recency > 0)))
    )
    values["is_bgnbd_eligible"] = eligible
    return grouped.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in CUSTOMER_FEATURES]
    )


def reconcile_features(fb: DataFrame, cf: DataFrame, params: Params) -> DataFrame:
    money = "decimal(38,2)"
    fact = valid_in_sample(fb, params).agg(
        F.countDistinct("household_key").alias("fact_households"),
        F.count("*").alias("fact_baskets"),
        F.sum("basket_sales_value").cast(money).alias("fact_sales"),
        F.sum("basket_total_quantity").alias("fact_quantity"),
    )
    customer = cf.agg(
        F.count("*").alias("customer_rows"),
        F.sum("in_sample_baskets").alias("customer_baskets"),
        F.sum("historical_sales").cast(money).alias("customer_sales"),
        F.sum("historical_quantity").alias("customer_quantity"),
    )
    return reconcile(
        fact,
        customer,
        {
            "household_difference": ("fact_households", "customer_rows"),
            "basket_difference": ("fact_baskets", "customer_baskets"),
            "sales_difference": ("fact_sales", "customer_sales"),
            "quantity_difference": ("fact_quantity", "customer_quantity"),
        },
    )


def bgnbd_relationship_checks(cf: DataFrame) -> DataFrame:
    n, x = F.col("in_sample_baskets"), F.col("frequency")
    recency, observed = F.col("recency_days"), F.col("observation_days")
    return cf.agg(
        F.count("*").alias("customers"),
        F.countDistinct("household_key").alias("unique_households"),
        count_where(n < 1).alias("no_in_sample_baskets"),
        count_where(x != n - 1).alias("invalid_frequency"),
        count_where(x < 0).alias("negative_frequency"),
        count_where(recency < 0).alias("negative_recency"),
        count_where(observed <= 0).alias("nonpositive_observation_time"),
        count_where(recency > observed).alias("recency_greater_than_observation"),
        count_where((x == 0) & (recency != 0)).alias("invalid_one_time_customers"),
        count_where((x > 0) & (recency <= 0)).alias("invalid_repeat_customers"),
        count_where(F.col("is_bgnbd_eligible")).alias("bgnbd_eligible_customers"),
    )


def one_time_purchasers(cf: DataFrame) -> DataFrame:
    return cf.filter(F.col("frequency") == 0).agg(
        F.count("*").alias("one_time_purchasers"),
        F.min("recency_days").alias("minimum_recency_days"),
        F.max("recency_days").alias("maximum_recency_days"),
        F.min("observation_days").alias("minimum_observation_days"),
        F.max("observation_days").alias("maximum_observation_days"),
    )


def _five_numbers(cf: DataFrame, quartiles: dict[str, bool]) -> DataFrame:
    """Minimum, quartiles (or only the median) and maximum per column, as one row."""
    columns = list(quartiles)
    spread = quantiles(cf, columns, [0.25, 0.50, 0.75])
    wide = spread.agg(
        *[F.first(F.when(F.col("metric") == c, F.col("q")), ignorenulls=True).alias(c) for c in columns]
    )
    ends = cf.agg(
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    )
    chosen = []
    for c, full in quartiles.items():
        chosen.append(F.col(f"min_{c}"))
        if full:
            chosen.append(F.col(c)[0].alias(f"q1_{c}"))
        chosen.append(F.col(c)[1].alias(f"median_{c}"))
        if full:
            chosen.append(F.col(c)[2].alias(f"q3_{c}"))
        chosen.append(F.col(f"max_{c}"))
    return ends.crossJoin(F.broadcast(wide)).select(*chosen)


def feature_distribution_short(cf: DataFrame) -> DataFrame:
    return _five_numbers(
        cf, {"frequency": True, "recency_days": False, "observation_days": False}
    )


def feature_distribution(cf: DataFrame) -> DataFrame:
    return _five_numbers(cf, {"frequency": True, "recency_days": True, "observation_days": True})


def recency_identity(cf: DataFrame) -> DataFrame:
    gap = F.col("days_since_last_purchase") - (F.col("observation_days") - F.col("recency_days"))
    return cf.agg(
        count_where(F.abs(gap) > F.lit("0.000001").cast("decimal(7,6)")).alias(
            "invalid_recency_identity"
        )
    )


def required_null_checks(cf: DataFrame) -> DataFrame:
    return cf.agg(
        count_where(F.col("frequency").isNull()).alias("null_frequency"),
        count_where(F.col("recency_days").isNull()).alias("null_recency"),
        count_where(F.col("observation_days").isNull()).alias("null_observation_time"),
    )


def rate_bounds(cf: DataFrame) -> DataFrame:
    return cf.agg(
        *[
            count_where(~F.col(f"{kind}_basket_rate").between(0, 1)).alias(f"invalid_{kind}_rates")
            for kind in ("retail_discount", "manufacturer_coupon", "retail_coupon_match")
        ]
    )


def coupon_average_consistency(cf: DataFrame) -> DataFrame:
    rate = F.col("manufacturer_coupon_basket_rate")
    average = F.col("manufacturer_coupon_amount_per_redeeming_basket")
    return cf.agg(
        count_where((rate == 0) & average.isNotNull()).alias("nonusers_with_coupon_average"),
        count_where((rate > 0) & average.isNull()).alias("users_without_coupon_average"),
    )


def negative_totals(cf: DataFrame) -> DataFrame:
    return cf.agg(
        count_where(F.col("total_retail_discount") < 0).alias(
            "customers_with_negative_retail_discount"
        ),
        count_where(F.col("total_manufacturer_coupon") < 0).alias(
            "customers_with_negative_manufacturer_coupon"
        ),
        count_where(F.col("total_retail_coupon_match") < 0).alias(
            "customers_with_negative_retail_coupon_match"
        ),
        count_where(F.col("estimated_pre_retail_discount_value") < 0).alias(
            "customers_with_negative_pre_discount_value"
        ),
    )


def top_by_baskets(cf: DataFrame, n: int = 20) -> DataFrame:
    return (
        cf.select(
            "household_key", "in_sample_baskets", "frequency", "recency_days", "observation_days",
            "days_since_last_purchase", "active_weeks", "historical_sales", "average_basket_value",
        )
        .orderBy(F.desc("in_sample_baskets"), "household_key")
        .limit(n)
    )


def top_by_sales(cf: DataFrame, n: int = 20) -> DataFrame:
    return (
        cf.select(
            "household_key", "in_sample_baskets", "historical_sales", "average_basket_value",
            "historical_quantity", "retail_discount_basket_rate",
            "manufacturer_coupon_basket_rate", "retail_coupon_match_basket_rate",
        )
        .orderBy(F.desc_nulls_first("historical_sales"), "household_key")
        .limit(n)
    )
