"""How promotion use differs between the household profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.columns import count_where
from tillsight.functions.ordering import melt, quantile_columns
from tillsight.operators.profiles import ACTIVITY_LEVELS, VALUE_LEVELS

# fixed values: metric, label, priority, unit of a value, unit of a difference
CATALOG = [
    ("retail_discount_basket_rate", "Retail discount basket rate", "Primary", "%",
     "percentage points"),
    ("retail_discount_share_of_pre_discount_value", "Retail discount share of pre-discount value",
     "Primary", "%", "percentage points"),
    ("manufacturer_coupon_basket_rate", "Manufacturer coupon basket rate", "Primary", "%",
     "percentage points"),
    ("manufacturer_coupon_value_per_basket", "Manufacturer coupon value per basket", "Primary",
     "$ per basket", "$ per basket"),
    ("retail_coupon_match_basket_rate", "Retail coupon-match basket rate", "Secondary", "%",
     "percentage points"),
]
METRICS = [row[0] for row in CATALOG]
COUPON_METRICS = ["manufacturer_coupon_basket_rate", "manufacturer_coupon_value_per_basket"]


def promotion_metric_catalog(spark: SparkSession) -> DataFrame:
    """The five metrics; a support table."""
    names = ["metric_column", "metric", "priority", "value_unit", "difference_unit"]
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in CATALOG])
    return spark.range(1).select(F.inline(rows))


def metric_coverage(df: DataFrame) -> DataFrame:
    """The catalog beside the number of households that have a value for each metric."""
    held = (
        melt(df, METRICS).groupBy("metric").agg(F.count("value").alias("households_with_value"))
    ).withColumnRenamed("metric", "metric_column")
    catalog = promotion_metric_catalog(df.sparkSession)
    return catalog.join(F.broadcast(held), "metric_column")


def _overview(df: DataFrame, by: Sequence[str]) -> DataFrame:
    means = [F.avg(F.col(m).cast("double")).alias(m) for m in METRICS]
    return df.groupBy(*by).agg(F.count("*").alias("households"), *means).orderBy(*by)


def profile_promotion_overview(df: DataFrame) -> DataFrame:
    return _overview(df, ["customer_profile"])


def level_promotion_overview(df: DataFrame) -> DataFrame:
    """Ordered by value level, then activity level; both read Higher before Lower."""
    return _overview(df, ["historical_value_level", "future_activity_level"])


def promotion_benchmark(df: DataFrame) -> DataFrame:
    """Mean over all households of each metric, percent metrics times 100, to three decimals."""
    means = (
        melt(df, METRICS)
        .groupBy(F.col("metric").alias("metric_column"))
        .agg(F.avg("value").alias("mean"))
    )
    scale = F.when(F.col("value_unit") == "%", 100).otherwise(1)
    catalog = promotion_metric_catalog(df.sparkSession)
    return means.join(F.broadcast(catalog), "metric_column").select(
        "metric_column",
        "metric",
        F.round(F.col("mean") * scale, 3).alias("customer_base_mean"),
        F.col("value_unit").alias("unit"),
    )


def within_level_promotion_comparison(df: DataFrame) -> DataFrame:
    """Higher against lower predicted activity within each value level, metric by metric.

    One pass over (level, activity, metric) rows replaces a loop over levels and metrics.
    """
    level, activity = "historical_value_level", "future_activity_level"
    metrics = F.array(
        *[
            F.struct(F.lit(m).alias("metric_column"), F.col(m).cast("double").alias("value"))
            for m in METRICS
        ]
    )
    long = df.select(level, activity, F.inline(metrics))
    high, low = (F.col(activity) == name for name in ACTIVITY_LEVELS)
    value = F.col("value")
    stats = long.groupBy(level, "metric_column").agg(
        count_where(high).alias("higher_activity_households"),
        count_where(low).alias("lower_activity_households"),
        count_where(high & value.isNotNull()).alias("higher_activity_metric_n"),
        count_where(low & value.isNotNull()).alias("lower_activity_metric_n"),
        F.avg(F.when(high, value)).alias("higher_mean"),
        F.avg(F.when(low, value)).alias("lower_mean"),
    )
    medians = (
        quantile_columns(long, {"median": ("value", 0.5)}, [level, activity, "metric_column"])
        .groupBy(level, "metric_column")
        .agg(
            F.max(F.when(high, F.col("median"))).alias("higher_median"),
            F.max(F.when(low, F.col("median"))).alias("lower_median"),
        )
    )
    scale = F.when(F.col("value_unit") == "%", 100.0).otherwise(1.0)
    catalog = promotion_metric_catalog(df.sparkSession)
    # ten rows
    return (
        stats.join(F.broadcast(medians), [level, "metric_column"])
        .join(F.broadcast(catalog), "metric_column")
        .select(
            level,
            "metric_column",
            "metric",
            "priority",
            "higher_activity_households",
            "lower_activity_households",
            "higher_activity_metric_n",
            "lower_activity_metric_n",
            (F.col("higher_mean") * scale).alias("higher_activity_mean"),
            (F.col("lower_mean") * scale).alias("lower_activity_mean"),
            (F.col("higher_mean") * scale - F.col("lower_mean") * scale).alias(
                "difference_high_minus_low"
            ),
            (F.col("higher_median") * scale).alias("higher_activity_median"),
            (F.col("lower_median") * scale).alias("lower_activity_median"),
            "value_unit",
            "difference_unit",
        )
        .orderBy(level, "priority", "metric_column")
    )


_GROUPS = ["higher_activity_households", "lower_activity_households"]
_MEANS = ["higher_activity_mean", "lower_activity_mean", "difference_high_minus_low"]
_UNITS = ["value_unit", "difference_unit"]


def priority_comparison(comparison: DataFrame, priority: str) -> DataFrame:
    return comparison.filter(F.col("priority") == priority).select(
        "historical_value_level", "metric", *_GROUPS, *_MEANS, *_UNITS
    )


def level_comparison(comparison: DataFrame, higher: bool) -> DataFrame:
    wanted = VALUE_LEVELS[0] if higher else VALUE_LEVELS[1]
    return comparison.filter(F.col("historical_value_level") == wanted).select(
        "metric", "priority", *_MEANS, *_UNITS
    )


def coupon_distribution_check(comparison: DataFrame) -> DataFrame:
    """Means beside medians of the coupon metrics."""
    return comparison.filter(F.col("metric_column").isin(COUPON_METRICS)).select(
        "historical_value_level", "metric", "higher_activity_mean", "higher_activity_median",
        "lower_activity_mean", "lower_activity_median", "difference_high_minus_low", "value_unit",
    )
