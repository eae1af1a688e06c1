"""Predicted activity within sales groups, and the two-by-two household profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import count_where, percent
from tillsight.functions.ordering import quantile_columns
from tillsight.operators.describe import QUINTILE
from tillsight.operators.evaluate import ACTUAL, MODELS

PREDICTED = MODELS["BG/NBD"]
SALES = "historical_sales"

# fixed values: group labels
HIGHER, LOWER = "Higher predicted baskets", "Lower predicted baskets"
VALUE_LEVELS = ["Higher historical value", "Lower historical value"]
ACTIVITY_LEVELS = ["Higher predicted activity", "Lower predicted activity"]
PROFILES = [
    "Higher sales / Higher activity",
    "Higher sales / Lower activity",
    "Lower sales / Higher activity",
    "Lower sales / Lower activity",
]
UNCLASSIFIED = "Unclassified"


def within_quintile_split(df: DataFrame) -> DataFrame:
    """Labels households at or above the median prediction of their own sales quintile."""
    median = "median_predicted_baskets_within_sales_quintile"
    medians = quantile_columns(df, {median: (PREDICTED, 0.5)}, QUINTILE)
    label = F.when(F.col(PREDICTED) >= F.col(median), HIGHER).otherwise(LOWER)
    # five rows
    return df.join(F.broadcast(medians), QUINTILE).withColumn("relative_predicted_baskets", label)


def quintile_split_counts(df: DataFrame) -> DataFrame:
    group = F.col("relative_predicted_baskets")
    return (
        df.groupBy(*QUINTILE)
        .agg(
            count_where(group == HIGHER).alias("higher_predicted_baskets"),
            count_where(group == LOWER).alias("lower_predicted_baskets"),
        )
        .orderBy(*QUINTILE)
    )


def within_quintile_summary(df: DataFrame) -> DataFrame:
    by = [*QUINTILE, "relative_predicted_baskets"]
    spread = quantile_columns(
        df,
        {
            "historical_sales_median": (SALES, 0.5),
            "predicted_baskets_median": (PREDICTED, 0.5),
            "actual_holdout_baskets_median": (ACTUAL, 0.5),
        },
        by,
    )
    totals = df.groupBy(*by).agg(
        F.count("*").alias("households"),
        (F.sum(SALES).cast("double") / F.count(SALES)).alias("historical_sales_mean"),
        F.avg(PREDICTED).alias("predicted_baskets_mean"),
        F.avg(ACTUAL).alias("actual_holdout_baskets_mean"),
        F.avg(F.col("was_active_in_holdout").cast("int")).alias("share_active_in_holdout"),
    )
    # two rows per quintile
    return totals.join(F.broadcast(spread), by).orderBy(*by)


def _two_groups(df: DataFrame) -> DataFrame:
    group = F.col("relative_predicted_baskets")
    return df.groupBy(*QUINTILE).agg(
        F.avg(F.when(group == LOWER, F.col(ACTUAL))).alias("lower_mean"),
        F.avg(F.when(group == HIGHER, F.col(ACTUAL))).alias("higher_mean"),
    )


def within_quintile_difference(df: DataFrame) -> DataFrame:
    """Mean actual baskets of both groups and their difference, to two decimals."""
    return (
        _two_groups(df)
        .select(
            *QUINTILE,
            F.round("lower_mean", 2).alias("mean_actual_lower_predicted"),
            F.round("higher_mean", 2).alias("mean_actual_higher_predicted"),
            F.round(F.col("higher_mean") - F.col("lower_mean"), 2).alias("difference"),
        )
        .orderBy(*QUINTILE)
    )


def within_quintile_uplift(df: DataFrame) -> DataFrame:
    difference = F.col("higher_mean") - F.col("lower_mean")
    return (
        _two_groups(df)
        .select(
            *QUINTILE,
            "higher_mean",
            "lower_mean",
            difference.alias("actual_basket_difference"),
            (F.try_divide(difference, F.col("lower_mean")) * 100).alias("actual_basket_uplift_pct"),
        )
        .orderBy(*QUINTILE)
    )


def single_quintile_ratio(df: DataFrame, quintile: str = "Q3") -> DataFrame:
    one = df.filter(F.col(QUINTILE[0]) == quintile)
    group = F.col("relative_predicted_baskets")
    medians = quantile_columns(one, {"m": (SALES, 0.5)}, ["relative_predicted_baskets"]).agg(
        F.max(F.when(group == LOWER, F.col("m"))).alias("lower_sales_median"),
        F.max(F.when(group == HIGHER, F.col("m"))).alias("higher_sales_median"),
    )
    means = _two_groups(one).select(
        *QUINTILE,
        F.col("lower_mean").alias("lower_actual_mean"),
        F.col("higher_mean").alias("higher_actual_mean"),
        (F.col("higher_mean") - F.col("lower_mean")).alias("difference"),
        F.try_divide("higher_mean", "lower_mean").alias("ratio"),
    )
    return means.crossJoin(F.broadcast(medians))


def profile_cutoffs(df: DataFrame) -> DataFrame:
    return quantile_columns(
        df, {"historical_sales_median": (SALES, 0.5), "predicted_baskets_median": (PREDICTED, 0.5)}
    )


def profile_levels(df: DataFrame, cutoffs: DataFrame | None = None) -> DataFrame:
    """Value and activity level by the two medians, the long profile label and its order, and the
    short profile label that the later steps group by."""
    cuts = (profile_cutoffs(df) if cutoffs is None else cutoffs).select(
        F.col("historical_sales_median").alias("_sales_cut"),
        F.col("predicted_baskets_median").alias("_activity_cut"),
    )
    sales, predicted = F.col(SALES).cast("double"), F.col(PREDICTED)
    high_value, low_value = sales >= F.col("_sales_cut"), sales < F.col("_sales_cut")
    active, passive = predicted >= F.col("_activity_cut"), predicted < F.col("_activity_cut")
    value = F.when(high_value, VALUE_LEVELS[0]).otherwise(VALUE_LEVELS[1])
    activity = F.when(active, ACTIVITY_LEVELS[0]).otherwise(ACTIVITY_LEVELS[1])
    order = F.when(high_value, 1).otherwise(3) + F.when(active, 0).otherwise(1)
    short = (
        F.when(high_value & active, PROFILES[0])
        .when(high_value & passive, PROFILES[1])
        .when(low_value & active, PROFILES[2])
        .when(low_value & passive, PROFILES[3])
        .otherwise(UNCLASSIFIED)
    )
    return (
        df.crossJoin(F.broadcast(cuts))  # one row
        .withColumns(
            {
                "historical_value_level": value,
                "future_activity_level": activity,
                "profile_order": order,
                "customer_profile": short,
            }
        )
        .withColumn(
            "profile_label",
            F.concat(F.col("historical_value_level"), F.lit(" / "), F.col("future_activity_level")),
        )
        .drop("_sales_cut", "_activity_cut")
    )


def profile_check(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("households"),
        count_where(F.col("customer_profile").isNull()).alias("without_profile"),
        count_where(F.col("customer_profile") == UNCLASSIFIED).alias("unclassified"),
    )


def assert_profiles(df: DataFrame, expected_rows: int | None = None) -> None:
    households, missing, _ = profile_check(df).first()
    if missing:
        raise ValueError(f"{missing} households without a profile")
    if expected_rows is not None and households != expected_rows:
        raise ValueError(f"{households} households instead of {expected_rows}")


def profile_crosstab(df: DataFrame) -> DataFrame:
    """Value level by activity level with row, column and grand totals."""
    cells = df.cube("historical_value_level", "future_activity_level").agg(
        F.count("*").alias("n"), F.grouping_id().alias("g")
    )
    level = F.when(F.col("g") >= 2, "All").otherwise(F.col("historical_value_level"))
    activity, any_activity = F.col("future_activity_level"), F.col("g") % 2 == 1
    n = F.col("n")
    return (
        cells.groupBy(level.alias("historical_value_level"))
        .agg(
            F.sum(F.when(~any_activity & (activity == ACTIVITY_LEVELS[0]), n).otherwise(0)).alias(
                "higher_predicted_activity"
            ),
            F.sum(F.when(~any_activity & (activity == ACTIVITY_LEVELS[1]), n).otherwise(0)).alias(
                "lower_predicted_activity"
            ),
            F.sum(F.when(any_activity, n).otherwise(0)).alias("all_levels"),
        )
        .orderBy(F.col("historical_value_level") == "All", "historical_value_level")
    )


def _sizes(df: DataFrame, *by: str) -> DataFrame:
    total = df.agg(F.count("*").alias("_total"))
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("households"))
        .crossJoin(F.broadcast(total))
        .withColumn("customer_share", F.col("households") / F.col("_total"))
        .withColumn("share_pct", percent(F.col("households"), F.col("_total"), 1))
        .drop("_total")
    )


def profile_sizes(df: DataFrame) -> DataFrame:
    return _sizes(df, "customer_profile").orderBy("customer_profile")


def level_sizes(df: DataFrame) -> DataFrame:
    levels = F.array("historical_value_level", "future_activity_level")
    return _sizes(df.select(F.explode(levels).alias("level")), "level").select("level", "households")


def profile_relevance(df: DataFrame) -> DataFrame:
    """Each profile's part of the households, the past sales and the predicted baskets."""
    by = ["customer_profile"]
    spread = quantile_columns(
        df,
        {
            "historical_sales_median": (SALES, 0.5),
            "predicted_future_baskets_median": (PREDICTED, 0.5),
        },
        by,
    )
    sums = df.groupBy(*by).agg(
        F.count("*").alias("households"),
        F.sum(SALES).cast("double").alias("historical_sales_total"),
        F.sum(PREDICTED).alias("predicted_future_baskets_total"),
    )
    totals = sums.agg(
        F.sum("households").alias("_n"),
        F.sum("historical_sales_total").alias("_sales"),
        F.sum("predicted_future_baskets_total").alias("_predicted"),
    )
    # one row per profile on either side
    return (
        sums.join(F.broadcast(spread), by)
        .crossJoin(F.broadcast(totals))
        .select(
            *by,
            "households",
            "historical_sales_total",
            "historical_sales_median",
            "predicted_future_baskets_total",
            "predicted_future_baskets_median",
            (F.col("households") / F.col("_n")).alias("customer_share"),
            F.try_divide("historical_sales_total", "_sales").alias("historical_sales_share"),
            F.try_divide("predicted_future_baskets_total", "_predicted").alias(
                "predicted_future_baskets_share"
            ),
        )
        .orderBy(*by)
    )


def profile_commercial_weight(df: DataFrame) -> DataFrame:
    return profile_relevance(df).select(
        "customer_profile", "households", "customer_share", "historical_sales_share",
        "predicted_future_baskets_share",
    )


def sales_within_groups(df: DataFrame) -> DataFrame:
    by = ["historical_value_level", "future_activity_level"]
    spread = quantile_columns(df, {"historical_sales_median": (SALES, 0.5)}, by)
    totals = df.groupBy(*by).agg(
        F.count("*").alias("households"),
        (F.sum(SALES).cast("double") / F.count(SALES)).alias("historical_sales_mean"),
    )
    return totals.join(F.broadcast(spread), by).orderBy(*by)
