"""Every query by name: what it runs on which step's table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tillsight.operators import (
    audit,
    baskets,
    bgnbd,
    checks,
    describe,
    evaluate,
    features,
    holdout,
    profiles,
    promotions,
)
from tillsight.plans.stages import RULE_GRID, RULE_THETA, THETA, Stages, stages
from tillsight.schema import PROJECT_PARAMETERS, TRANSACTIONS
from tillsight.sources.storage import (
    preview_rows,
    register_view,
    shared_folder,
    upsert_table,
    write_table,
)
from tillsight.sources.transactions import load_transactions

Step = Callable[[Stages], DataFrame]


def comparable(df: DataFrame, digits: int | None, special: dict[str, int]) -> DataFrame:
    """A result in the form in which engines can be compared: decimals as doubles, and doubles
    rounded, since engines add floating-point numbers in different orders."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DoubleType) and digits is not None:
            column = F.round(column, special.get(field.name, digits))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _loaded(fmt: str) -> Step:
    """The lines as the loader reads them from files."""

    def step(s: Stages) -> DataFrame:
        path = f"{shared_folder(s.spark)}/receipts_{fmt}"
        writer = s.receipt_lines.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(path)
        return load_transactions(s.spark, path, fmt)

    return step


def _write_table(s: Stages) -> DataFrame:
    return write_table(s.fact_basket, f"{shared_folder(s.spark)}/written_fact_basket")


def _register_view(s: Stages) -> DataFrame:
    register_view(s.model_view, "bgnbd_model_input")
    return s.spark.sql(
        "SELECT count(*) AS rows, sum(frequency) AS repeat_baskets FROM bgnbd_model_input"
    )


def _upsert_parameters(s: Stages) -> DataFrame:
    """Written, then upserted in place."""
    path = f"{shared_folder(s.spark)}/upserted_parameters"
    write_table(baskets.project_parameters(s.transactions, 52, 53, 78), path)
    return upsert_table(baskets.project_parameters(s.transactions), path, "parameter_id")


SOURCES: dict[str, Step] = {
    "load_transactions": _loaded("parquet"),
    "load_transactions_csv": _loaded("csv"),
    "imported_row_count": lambda s: checks.imported_row_count(s.transactions),
    "preview_rows": lambda s: preview_rows(s.transactions, 20),
    "check_schema": lambda s: checks.check_schema(s.transactions, TRANSACTIONS),
    "write_table": _write_table,
    "register_view": _register_view,
    "read_model_input": lambda s: s.model_view.orderBy("household_key"),
    "check_primary_key": lambda s: checks.check_primary_key(
        s.transactions, ["household_key", "basket_id"]
    ),
    "check_primary_key_fact_basket": lambda s: checks.check_primary_key(
        s.fact_basket, ["household_key", "basket_id"]
    ),
    "check_foreign_key": lambda s: checks.check_foreign_key(
        s.holdout_activity.select("household_key", "actual_holdout_baskets"),
        s.customer_features,
        "household_key",
    ),
    "check_not_null": lambda s: checks.check_not_null(s.transactions, TRANSACTIONS.fieldNames()),
    "check_predicate": lambda s: checks.check_predicate(s.transactions, F.col("retail_disc") <= 0),
    "check_not_null_parameters": lambda s: checks.check_not_null(
        baskets.project_parameters(s.transactions), PROJECT_PARAMETERS.fieldNames()
    ),
    "check_predicate_parameters": lambda s: checks.check_predicate(
        baskets.project_parameters(s.transactions), F.col("parameter_id") == 1
    ),
    "upsert_parameters": _upsert_parameters,
}

AUDIT: dict[str, Step] = {
    name: (lambda s, f=getattr(audit, name): f(s.transactions))
    for name in (
        "dataset_overview", "null_counts", "weekly_coverage", "day_week_violations",
        "boundary_weeks", "basket_attribute_consistency", "baskets_with_repeated_product",
        "basket_size_distribution", "exact_duplicates", "quantity_profile", "sales_profile",
        "zero_quantity_summary", "zero_quantity_discount_mix", "zero_quantity_positive_sales",
        "zero_quantity_only_baskets", "zero_quantity_only_profile", "discount_incidence",
        "discount_sign_audit", "positive_retail_discounts", "baskets_with_positive_retail",
        "positive_retail_basket_summary", "discount_relationships", "coupon_match_exceptions",
        "trans_time_range", "invalid_hhmm", "multi_time_baskets", "baskets_without_time",
        "extreme_lines", "unusual_value_rates",
    )
}

BASKETS: dict[str, Step] = {
    "project_parameters": lambda s: baskets.project_parameters(s.transactions),
    "parameter_validation": lambda s: baskets.parameter_validation(
        baskets.project_parameters(s.transactions)
    ),
    "fact_basket": lambda s: baskets.fact_basket(s.transactions),
    "reconcile_basket_count": lambda s: baskets.reconcile_basket_count(
        s.transactions, s.fact_basket
    ),
    "reconcile_line_count": lambda s: baskets.reconcile_line_count(s.transactions, s.fact_basket),
    "reconcile_measures": lambda s: baskets.reconcile_measures(s.transactions, s.fact_basket),
    "negative_discount_baskets": lambda s: baskets.negative_discount_baskets(s.fact_basket),
    "valid_basket_summary": lambda s: baskets.valid_basket_summary(s.fact_basket),
    "invalid_basket_listing": lambda s: baskets.invalid_basket_listing(s.fact_basket),
    "period_activity": lambda s: baskets.period_activity(s.fact_basket, s.params),
    "customer_overlap": lambda s: baskets.customer_overlap(s.fact_basket, s.params),
    "estimated_customer_payment": lambda s: baskets.estimated_customer_payment(s.transactions),
}

# fixed values: the columns of both parts of the household table
BGNBD_COLUMNS = [
    "household_key", "in_sample_baskets", "first_purchase_time_days", "last_purchase_time_days",
    "frequency", "recency_days", "observation_days", "days_since_last_purchase",
]
PROFILE_COLUMNS = [
    "household_key", "active_weeks", "historical_sales", "average_basket_value",
    "historical_quantity", "retail_discount_basket_rate", "retail_discount_per_basket",
    "total_retail_discount", "manufacturer_coupon_basket_rate", "total_manufacturer_coupon",
    "manufacturer_coupon_amount_per_redeeming_basket", "retail_coupon_match_basket_rate",
    "retail_coupon_match_per_basket", "total_retail_coupon_match",
    "estimated_pre_retail_discount_value",
]


def _features(s: Stages) -> DataFrame:
    return features.customer_features(s.fact_basket, s.params)


FEATURES: dict[str, Step] = {
    "same_day_baskets": lambda s: features.same_day_baskets(s.fact_basket, s.params),
    "same_minute_baskets": lambda s: features.same_minute_baskets(s.fact_basket, s.params),
    "same_minute_listing": lambda s: features.same_minute_listing(s.fact_basket, s.params),
    "purchase_time_days": lambda s: features.purchase_time_days(s.fact_basket, s.params),
    "bgnbd_features": lambda s: _features(s).select(*BGNBD_COLUMNS),
    "customer_profile_features": lambda s: _features(s).select(*PROFILE_COLUMNS),
    "customer_features": _features,
    "reconcile_features": lambda s: features.reconcile_features(
        s.fact_basket, s.customer_features, s.params
    ),
    **{
        name: (lambda s, f=getattr(features, name): f(s.customer_features))
        for name in (
            "bgnbd_relationship_checks", "one_time_purchasers", "feature_distribution_short",
            "recency_identity", "required_null_checks", "feature_distribution", "rate_bounds",
            "coupon_average_consistency", "negative_totals", "top_by_baskets", "top_by_sales",
        )
    },
}

HOLDOUT: dict[str, Step] = {
    "holdout_activity": lambda s: s.holdout_activity,
    "customer_holdout": lambda s: holdout.customer_holdout(s.customer_features, s.holdout_activity),
    "holdout_structure_checks": lambda s: holdout.holdout_structure_checks(s.customer_holdout),
    "holdout_cohort": lambda s: holdout.holdout_cohort(s.customer_holdout),
    "reconcile_holdout": lambda s: holdout.reconcile_holdout(
        s.customer_holdout, s.fact_basket, s.customer_features, s.params
    ),
    "holdout_only_households": lambda s: holdout.holdout_only_households(
        s.fact_basket, s.customer_features, s.params
    ),
    "bgnbd_model_input": lambda s: s.model_view,
    "model_input_checks": lambda s: holdout.model_input_checks(s.model_input),
    "horizon_uniqueness": lambda s: holdout.horizon_uniqueness(s.model_input),
    "model_input_sample": lambda s: holdout.model_input_sample(s.model_input),
}

HISTORY = [
    "in_sample_baskets", "active_weeks", "days_since_last_purchase", "observation_days",
    "historical_sales", "average_basket_value",
]
PROMOTION = [
    "retail_discount_basket_rate", "retail_discount_per_basket", "manufacturer_coupon_basket_rate",
    "manufacturer_coupon_amount_per_redeeming_basket", "retail_coupon_match_basket_rate",
    "retail_coupon_match_per_basket",
]
NORMALIZED = [
    "retail_discount_share_of_pre_discount_value",
    "retailer_funded_discount_share_of_pre_discount_value",
    "manufacturer_coupon_value_per_basket",
]
MODEL_COLUMNS = ["frequency", "recency_days", "observation_days", "actual_holdout_baskets"]
SPREAD = [0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
CENTERED = ["historical_sales", "in_sample_baskets", "days_since_last_purchase"]
HISTOGRAM = {
    "frequency": 50, "historical_sales": 50, "in_sample_baskets": 50,
    "days_since_last_purchase": 50, "retail_discount_basket_rate": 40,
    "manufacturer_coupon_basket_rate": 40, "retail_coupon_match_basket_rate": 40,
}
RANKED_PAIRS = [
    ("historical_sales", "in_sample_baskets"), ("historical_sales", "average_basket_value"),
    ("historical_sales", "observation_days"), ("historical_sales", "actual_holdout_baskets"),
]
PREDICTED = "predicted_holdout_baskets_bgnbd"
BASELINE = "predicted_holdout_baskets_baseline"
SCORED_PAIRS = [("historical_sales", PREDICTED), ("actual_holdout_baskets", PREDICTED)]


def _quintiles(s: Stages) -> DataFrame:
    return describe.sales_quintile(s.scored)


DESCRIPTION: dict[str, Step] = {
    "coerce_numeric": lambda s: describe.coerce_numeric(s.model_input, describe.numeric_columns()),
    "assert_cohort": lambda s: describe.cohort_counts(s.model_input),
    "model_null_counts": lambda s: describe.model_null_counts(s.model_input),
    "assert_relationships": lambda s: describe.relationship_violations(s.model_input),
    "recency_allclose": lambda s: describe.recency_allclose(s.model_input),
    "describe": lambda s: describe.describe(
        s.model_input, MODEL_COLUMNS, [0.01, 0.25, 0.50, 0.75, 0.99]
    ),
    "describe_history": lambda s: describe.describe(s.model_input, HISTORY, SPREAD),
    "describe_observation": lambda s: describe.describe(
        s.model_input, ["observation_days"], [0.25, 0.50, 0.75, 0.90, 0.99]
    ),
    "describe_promotions": lambda s: describe.describe(s.model_input, PROMOTION, SPREAD),
    "describe_normalized": lambda s: describe.describe(s.scored, NORMALIZED, SPREAD),
    "describe_predictions": lambda s: describe.describe(
        s.scored, ["probability_alive", PREDICTED]
    ),
    "describe_errors": lambda s: describe.describe(
        s.scored,
        ["baseline_error", "bgnbd_error", "baseline_absolute_error", "bgnbd_absolute_error"],
    ),
    "histogram": lambda s: describe.histogram(s.model_input, HISTOGRAM),
    "histogram_up_to_p99": lambda s: describe.histogram(
        describe.up_to_quantile(s.model_input, "frequency", 0.99), {"frequency": 50}
    ),
    "log1p_histogram": lambda s: describe.log1p_histogram(
        s.model_input, {c: 50 for c in CENTERED}
    ),
    "between_median_and_mean": lambda s: describe.between_median_and_mean(
        s.model_input, "historical_sales"
    ),
    "center_lines": lambda s: describe.center_lines(s.model_input, CENTERED),
    "spearman": lambda s: describe.spearman_table(s.model_input, RANKED_PAIRS),
    "spearman_predicted": lambda s: describe.spearman_table(s.scored, SCORED_PAIRS),
    "log1p_pairs": lambda s: describe.log1p_pairs(
        s.model_input, "in_sample_baskets", "historical_sales"
    ),
    "log1p_pairs_predicted": lambda s: describe.log1p_pairs(s.scored, "historical_sales", PREDICTED),
    "promotion_incidence": lambda s: describe.promotion_incidence(s.model_input),
    "normalized_promotion": lambda s: describe.normalized_promotion(s.model_input).select(
        "household_key", *NORMALIZED
    ),
    "normalized_promotion_checks": lambda s: describe.normalized_promotion_checks(s.scored),
    "sales_quintile": lambda s: _quintiles(s).select("household_key", "historical_sales_quintile"),
    "sales_quintile_sizes": lambda s: describe.quintile_sizes(_quintiles(s)),
    "quintile_activity": lambda s: describe.quintile_activity(s.profiled),
    "quintile_dispersion": lambda s: describe.quintile_dispersion(s.profiled),
    "box_stats": lambda s: describe.box_stats(s.profiled),
}

EVALUATION: dict[str, Step] = {
    "rate_baseline": lambda s: evaluate.rate_baseline(s.model_input).select(
        "household_key", "frequency", "observation_days", "historical_repeat_rate_per_day",
        BASELINE, "actual_holdout_baskets",
    ),
    "bgnbd_fit": lambda s: bgnbd.fit_table(s.model_input, s.fitted),
    "bgnbd_fit_reached": lambda s: bgnbd.reached(
        s.rule_histories, bgnbd.fit(s.rule_histories), RULE_GRID
    ),
    "bgnbd_summary_fixed": lambda s: bgnbd.summary(s.rule_histories, RULE_THETA),
    "bgnbd_log_likelihood": lambda s: bgnbd.log_likelihood(s.model_input, THETA),
    "bgnbd_summary": lambda s: bgnbd.summary(s.model_input, s.fitted.params),
    "probability_alive": lambda s: s.model_input.select(
        "household_key", bgnbd.probability_alive(THETA).alias("probability_alive")
    ),
    "rate_check": lambda s: bgnbd.rate_check(s.model_input, THETA),
    "expected_purchases": lambda s: s.model_input.select(
        "household_key",
        bgnbd.expected_purchases(THETA, F.col("prediction_horizon_days")).alias(PREDICTED),
    ),
    "evaluate_predictions": lambda s: evaluate.evaluate_predictions(s.scored),
    "model_comparison": lambda s: evaluate.model_comparison(s.scored),
    "improvement_pct": lambda s: evaluate.improvement_pct(s.scored),
    "prediction_errors": lambda s: s.scored.select(
        "household_key", "baseline_error", "bgnbd_error", "baseline_absolute_error",
        "bgnbd_absolute_error",
    ),
    "activity_decile": lambda s: evaluate.activity_decile(s.scored).select(
        "household_key", "household_baskets_decile"
    ),
    "decile_calibration": lambda s: evaluate.decile_calibration(evaluate.activity_decile(s.scored)),
    "top_share_capture": lambda s: evaluate.top_share_table(s.scored),
    "bootstrap_mae_improvement": lambda s: evaluate.bootstrap_mae_improvement(s.scored, hashed=True),
    "bootstrap_in_errors": lambda s: evaluate.bootstrap_in_errors(
        s.scored, evaluate.bootstrap_mae_improvement(s.scored)
    ),
    "bootstrap_points": lambda s: evaluate.bootstrap_mae_improvement(s.scored),
    "bootstrap_poisson": lambda s: evaluate.bootstrap_mae_improvement(s.scored, method="poisson"),
    "lowest_alive": lambda s: evaluate.lowest_alive(s.scored),
    "largest_errors": lambda s: evaluate.largest_errors(s.scored),
}


def _comparison(s: Stages) -> DataFrame:
    return promotions.within_level_promotion_comparison(s.profiled)


PROFILES: dict[str, Step] = {
    "within_quintile_split": lambda s: profiles.within_quintile_split(_quintiles(s)).select(
        "household_key", "historical_sales_quintile",
        "median_predicted_baskets_within_sales_quintile", "relative_predicted_baskets",
    ),
    "profile_levels": lambda s: profiles.profile_levels(s.scored).select(
        "household_key", "historical_value_level", "future_activity_level", "profile_label",
        "profile_order",
    ),
    "customer_profile": lambda s: profiles.profile_levels(s.scored).select(
        "household_key", "customer_profile"
    ),
    **{
        name: (lambda s, f=getattr(profiles, name): f(s.profiled))
        for name in (
            "quintile_split_counts", "within_quintile_summary", "within_quintile_difference",
            "within_quintile_uplift", "single_quintile_ratio", "profile_cutoffs",
            "profile_crosstab", "profile_sizes", "level_sizes", "profile_relevance",
            "profile_commercial_weight", "sales_within_groups",
        )
    },
    "assert_profiles": lambda s: profiles.profile_check(s.profiled),
    "promotion_metric_catalog": lambda s: promotions.metric_coverage(s.profiled),
    "profile_promotion_overview": lambda s: promotions.profile_promotion_overview(s.profiled),
    "level_promotion_overview": lambda s: promotions.level_promotion_overview(s.profiled),
    "promotion_benchmark": lambda s: promotions.promotion_benchmark(s.profiled),
    "within_level_promotion_comparison": _comparison,
    "comparison_primary": lambda s: promotions.priority_comparison(_comparison(s), "Primary"),
    "comparison_secondary": lambda s: promotions.priority_comparison(_comparison(s), "Secondary"),
    "comparison_higher_value": lambda s: promotions.level_comparison(_comparison(s), True),
    "comparison_lower_value": lambda s: promotions.level_comparison(_comparison(s), False),
    "comparison_coupon_distribution": lambda s: promotions.coupon_distribution_check(_comparison(s)),
}

STEPS: dict[str, Step] = {
    **SOURCES, **AUDIT, **BASKETS, **FEATURES, **HOLDOUT, **DESCRIPTION, **EVALUATION, **PROFILES,
}

# Decimals kept of floating-point results. Eight keep any quantile of six-decimal input exact; six
# are kept where sums of floating-point values or model scores enter; single quotients of exact
# values and bin edges are left as they are.
DEFAULT_DIGITS = 8
NOISY_DIGITS = 6
EXACT = {
    "coerce_numeric", "normalized_promotion", "rate_baseline", "histogram", "histogram_up_to_p99",
}
NOISY = {
    "describe_predictions", "describe_errors", "log1p_histogram", "spearman", "spearman_predicted",
    "log1p_pairs", "log1p_pairs_predicted", "bgnbd_fit", "bgnbd_summary", "bgnbd_log_likelihood",
    "bgnbd_fit_reached", "bgnbd_summary_fixed",
    "probability_alive", "rate_check", "expected_purchases", "evaluate_predictions",
    "model_comparison", "improvement_pct", "prediction_errors", "decile_calibration",
    "bootstrap_mae_improvement", "bootstrap_in_errors", "bootstrap_points", "bootstrap_poisson", "lowest_alive", "largest_errors", "within_quintile_split",
    "within_quintile_summary", "profile_cutoffs", "profile_relevance", "profile_commercial_weight",
    "profile_promotion_overview", "level_promotion_overview", "within_level_promotion_comparison",
    "comparison_primary", "comparison_secondary", "comparison_higher_value",
    "comparison_lower_value", "comparison_coupon_distribution",
}
SPECIAL_DIGITS: dict[str, dict[str, int]] = {
    **{
        name: {"mean": 6, "std": 6}
        for name in (
            "describe", "describe_history", "describe_observation", "describe_promotions",
            "describe_normalized", "center_lines",
        )
    },
    "bgnbd_log_likelihood": {"log_likelihood": 3},
    "bgnbd_fit_reached": {"log_likelihood": 3},
    # second differences on both sides
    "bgnbd_summary_fixed": dict.fromkeys(("standard_error", "lower_95", "upper_95"), 3),
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, step: Step):
        digits = None if name in EXACT else NOISY_DIGITS if name in NOISY else DEFAULT_DIGITS
        special = SPECIAL_DIGITS.get(name, {})
        return lambda spark, folder: comparable(step(stages(spark, folder)), digits, special)

    return {name: bind(name, step) for name, step in STEPS.items()}
