"""Validation and description of the model input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import count_where, percent
from tillsight.functions.ordering import (
    global_place,
    joined_back,
    melt,
    ordered,
    quantile_bucket,
    quantile_columns,
    quantiles,
    spearman_pairs,
)
from tillsight.operators.holdout import MODEL_INPUT

REQUIRED = [
    "frequency",
    "recency_days",
    "observation_days",
    "prediction_horizon_days",
    "actual_holdout_baskets",
]
# fixed values
QUINTILE_LABELS = ["Q1 - Lowest", "Q2", "Q3", "Q4", "Q5 - Highest"]
PROMOTION_FLAGS = {
    "Retail loyalty-card discount": "retail_discount_basket_rate",
    "Manufacturer coupon": "manufacturer_coupon_basket_rate",
    "Retail coupon match": "retail_coupon_match_basket_rate",
}


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; a value that is not a number fails the job."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def numeric_columns() -> list[str]:
    return [c for c in MODEL_INPUT if c not in ("household_key", "was_active_in_holdout")]


def cohort_counts(mi: DataFrame) -> DataFrame:
    return mi.agg(
        F.count("*").alias("rows"), F.countDistinct("household_key").alias("unique_households")
    )


def assert_cohort(mi: DataFrame, expected_rows: int | None = None) -> None:
    """Raises unless the key is unique and, where given, the row count is the expected one."""
    rows, unique = cohort_counts(mi).first()
    if rows != unique:
        raise ValueError(f"household_key is not unique: {rows} rows, {unique} keys")
    if expected_rows is not None and rows != expected_rows:
        raise ValueError(f"{rows} households instead of {expected_rows}")


def model_null_counts(mi: DataFrame) -> DataFrame:
    return mi.agg(*[count_where(F.col(c).isNull()).alias(c) for c in REQUIRED])


def relationships() -> dict[str, Column]:
    """Conditions that no purchase history fulfils."""
    x, recency, observed = F.col("frequency"), F.col("recency_days"), F.col("observation_days")
    return {
        "negative_frequency": x < 0,
        "frequency_not_baskets_minus_one": x != F.col("in_sample_baskets") - 1,
        "negative_recency": recency < 0,
        "nonpositive_observation": observed <= 0,
        "recency_above_observation": recency > observed,
        "one_time_with_recency": (x == 0) & (recency != 0),
        "repeat_without_recency": (x > 0) & (recency <= 0),
    }


def relationship_violations(mi: DataFrame) -> DataFrame:
    return mi.agg(*[count_where(broken).alias(name) for name, broken in relationships().items()])


def assert_relationships(mi: DataFrame) -> None:
    broken = {k: v for k, v in relationship_violations(mi).first().asDict().items() if v}
    if broken:
        raise ValueError(f"purchase-history relationships broken: {broken}")


def recency_allclose(mi: DataFrame, atol: float = 1e-5, rtol: float = 1e-7) -> DataFrame:
    a = F.col("days_since_last_purchase").cast("double")
    b = F.col("observation_days").cast("double") - F.col("recency_days").cast("double")
    return mi.agg(count_where(F.abs(a - b) > atol + rtol * F.abs(b)).alias("not_close"))


def describe(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Count, mean, sample deviation, minimum, percentiles and maximum: one row per column."""
    value = F.col("value")
    moments = (
        melt(df, columns)
        .groupBy("metric")
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )
    spread = quantiles(df, columns, probs)
    points = [F.col("q")[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)]
    # one row per column on both sides
    return moments.join(F.broadcast(spread), "metric", "left").select(
        "metric", "count", "mean", "std", "min", *points, "max"
    )


def _bins(long: DataFrame, bins: Mapping[str, int]) -> DataFrame:
    """Equal-width bins of rows (metric, value), empty ones included; the last bin is closed."""
    bounds = (
        long.groupBy("metric")
        .agg(F.min("value").alias("a"), F.max("value").alias("b"))
        .filter(F.col("a").isNotNull())
        .select(
            "metric",
            F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("low"),
            F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("high"),
            F.create_map(*[F.lit(e) for pair in bins.items() for e in pair])[F.col("metric")].alias(
                "bins"
            ),
        )
    )
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    place = F.least(F.floor(share * F.col("bins")).cast("int") + 1, F.col("bins"))
    counted = (
        long.filter(F.col("value").isNotNull())
        .join(F.broadcast(bounds), "metric")
        .groupBy("metric", place.alias("bin"))
        .agg(F.count("*").alias("households"))
    )
    width = (F.col("high") - F.col("low")) / F.col("bins")
    edges = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.col("bins")))).select(
        "metric",
        "bin",
        (F.col("low") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("low") + F.col("bin") * width).alias("upper"),
    )
    # as many rows as bins asked for
    return (
        edges.join(F.broadcast(counted), ["metric", "bin"], "left")
        .withColumn("households", F.coalesce("households", F.lit(0)))
        .orderBy("metric", "bin")
    )


def histogram(df: DataFrame, bins: Mapping[str, int]) -> DataFrame:
    return _bins(melt(df, list(bins)), bins)


def log1p_histogram(df: DataFrame, bins: Mapping[str, int]) -> DataFrame:
    long = melt(df, list(bins)).withColumn("value", F.log1p("value"))
    return _bins(long, bins)


def up_to_quantile(df: DataFrame, column: str, prob: float) -> DataFrame:
    """Rows whose value is at most the given quantile."""
    cut = quantile_columns(df, {"_cut": (column, prob)})
    return (
        df.crossJoin(F.broadcast(cut)).filter(F.col(column).cast("double") <= F.col("_cut")).drop("_cut")
    )


def between_median_and_mean(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    median = quantile_columns(df, {"median": (column, 0.5)})
    mean = df.agg((F.sum(column).cast("double") / F.count(column)).alias("mean"))
    cuts = median.crossJoin(F.broadcast(mean))
    return (
        df.crossJoin(F.broadcast(cuts))
        .agg(
            count_where((value > F.col("median")) & (value < F.col("mean"))).alias("households"),
            F.count("*").alias("total"),
        )
        .select("households", percent(F.col("households"), F.col("total"), 2).alias("percentage"))
    )


def center_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    spread = quantiles(df, columns, [0.5])
    means = melt(df, columns).groupBy("metric").agg(F.avg("value").alias("mean"))
    return means.join(F.broadcast(spread), "metric").select(
        "metric", "mean", F.col("q")[0].alias("median")
    )


def spearman_table(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per pair of columns."""
    return spearman_pairs(df, pairs).select(
        F.concat_ws(" ~ ", "a", "b").alias("pair"), "n", "correlation"
    )


def log1p_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(
        "household_key",
        F.log1p(F.col(a).cast("double")).alias(f"log1p_{a}"),
        F.log1p(F.col(b).cast("double")).alias(f"log1p_{b}"),
    )


def promotion_incidence(mi: DataFrame) -> DataFrame:
    """Share of households that met each kind of promotion at least once."""
    flags = F.array(
        *[
            F.struct(F.lit(name).alias("promotion"), (F.col(c) > 0).alias("met"))
            for name, c in PROMOTION_FLAGS.items()
        ]
    )
    return (
        mi.select(F.inline(flags))
        .groupBy("promotion")
        .agg(count_where(F.col("met")).alias("households"), F.count("*").alias("total"))
        .select(
            "promotion",
            "households",
            (F.col("households") / F.col("total")).alias("share"),
            percent(F.col("households"), F.col("total"), 1).alias("share_pct"),
        )
    )


def normalized_promotion(mi: DataFrame) -> DataFrame:
    """Promotion money relative to the value before retailer discounts, and per basket."""
    pre = F.col("estimated_pre_retail_discount_value").cast("double")
    retail = F.col("total_retail_discount")

    def share(amount: Column) -> Column:
        return F.when(pre > 0, amount.cast("double") / pre)

    return mi.withColumns(
        {
            "retail_discount_share_of_pre_discount_value": share(retail),
            "retailer_funded_discount_share_of_pre_discount_value": share(
                retail + F.col("total_retail_coupon_match")
            ),
            "manufacturer_coupon_value_per_basket": F.col("total_manufacturer_coupon").cast("double")
            / F.col("in_sample_baskets"),
        }
    )


def normalized_promotion_checks(df: DataFrame) -> DataFrame:
    retail = F.col("retail_discount_share_of_pre_discount_value")
    funded = F.col("retailer_funded_discount_share_of_pre_discount_value")
    return df.agg(
        count_where(F.col("estimated_pre_retail_discount_value") <= 0).alias(
            "nonpositive_pre_discount_value"
        ),
        count_where(retail.isNull()).alias("missing_retail_share"),
        count_where(funded.isNull()).alias("missing_retailer_funded_share"),
        count_where((retail < 0) | (retail > 1)).alias("retail_share_outside"),
        count_where((funded < 0) | (funded > 1)).alias("retailer_funded_share_outside"),
    )


def rank_bucket(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """Equal-sized buckets 1.. by value; equal values are taken in key order, NULL has no bucket.

    The key and its place are all that is written and sorted; the bucket is joined back by key.
    """
    held = df.filter(F.col(column).isNotNull())
    keys = ordered(held, F.asc(column), F.asc("household_key"), keep=["household_key"])
    bucket = quantile_bucket(F.col("position"), keys.count(), buckets).cast("int")
    placed = global_place(keys).select("household_key", bucket.alias(name))
    return joined_back(df, placed, "household_key")


def sales_quintile(df: DataFrame) -> DataFrame:
    placed = rank_bucket(df, "historical_sales", 5, "_quintile")
    label = F.array(*[F.lit(x) for x in QUINTILE_LABELS])[F.col("_quintile") - 1]
    return placed.withColumn("historical_sales_quintile", label).drop("_quintile")


def quintile_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("historical_sales_quintile").agg(F.count("*").alias("households"))


QUINTILE = ["historical_sales_quintile"]


def quintile_activity(df: DataFrame) -> DataFrame:
    actual = "actual_holdout_baskets"
    spread = quantile_columns(
        df,
        {
            "historical_sales_median": ("historical_sales", 0.5),
            f"{actual}_median": (actual, 0.5),
            f"{actual}_q25": (actual, 0.25),
            f"{actual}_q75": (actual, 0.75),
        },
        QUINTILE,
    )
    totals = df.groupBy(*QUINTILE).agg(
        F.count("*").alias("customers"), F.avg(actual).alias(f"{actual}_mean")
    )
    return totals.join(F.broadcast(spread), QUINTILE).orderBy(*QUINTILE)


DISPERSION = {"p10": 0.1, "q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9}


def quintile_dispersion(df: DataFrame, column: str = "actual_holdout_baskets") -> DataFrame:
    spread = quantile_columns(df, {name: (column, p) for name, p in DISPERSION.items()}, QUINTILE)
    ends = df.groupBy(*QUINTILE).agg(F.min(column).alias("min"), F.max(column).alias("max"))
    return (
        ends.join(F.broadcast(spread), QUINTILE)
        .select(*QUINTILE, "min", *DISPERSION, "max")
        .orderBy(*QUINTILE)
    )


def box_stats(df: DataFrame, column: str = "actual_holdout_baskets") -> DataFrame:
    """Box-plot numbers: whiskers are the outermost data points within the 10th-90th percentile
    range, and never lie inside the box."""
    spread = quantile_columns(df, {name: (column, p) for name, p in DISPERSION.items()}, QUINTILE)
    value = F.col(column).cast("double")
    whiskers = (
        df.join(F.broadcast(spread), QUINTILE)
        .groupBy(*QUINTILE)
        .agg(
            F.min(F.when(value >= F.col("p10"), value)).alias("low"),
            F.max(F.when(value <= F.col("p90"), value)).alias("high"),
        )
    )
    return (
        whiskers.join(F.broadcast(spread), QUINTILE)
        .select(
            *QUINTILE,
            F.least("low", "q25").alias("whisker_low"),
            F.col("q25").alias("q1"),
            "median",
            F.col("q75").alias("q3"),
            F.greatest("high", "q75").alias("whisker_high"),
        )
        .orderBy(*QUINTILE)
    )
