"""Decimal columns of the results.

Both sides of a comparison carry them as doubles, since readers differ in what they make of a
decimal. The values have few enough digits to convert exactly the same way.
"""

from __future__ import annotations

from pyspark.sql.types import DecimalType, StructType

from tillsight.schema import CUSTOMER_FEATURES, CUSTOMER_HOLDOUT, FACT_BASKET, TRANSACTIONS


def _decimals(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, DecimalType)]


_LINES = _decimals(TRANSACTIONS)
_BASKETS = _decimals(FACT_BASKET)
_FEATURES = _decimals(CUSTOMER_FEATURES)
_OUTCOMES = _decimals(CUSTOMER_HOLDOUT)
_TIMES = _FEATURES[:5]
_PROFILE = _FEATURES[5:]
_MODEL = [c for c in _FEATURES if "purchase_time" not in c] + _OUTCOMES
_RATES = [c for c in _PROFILE if c.endswith("_basket_rate")]
_HISTORY = ["recency_days", "observation_days"]

DECIMALS: dict[str, list[str]] = {
    **dict.fromkeys(
        (
            "load_transactions", "load_transactions_csv", "preview_rows", "check_predicate", "zero_quantity_positive_sales",
            "positive_retail_discounts", "baskets_with_positive_retail", "coupon_match_exceptions",
            "extreme_lines",
        ),
        _LINES,
    ),
    **dict.fromkeys(("write_table", "fact_basket"), _BASKETS),
    **dict.fromkeys(("read_model_input", "bgnbd_model_input"), _MODEL),
    **dict.fromkeys(("holdout_activity", "customer_holdout"), _OUTCOMES),
    **dict.fromkeys(("valid_basket_summary", "period_activity"), ["recorded_sales"]),
    **dict.fromkeys(
        ("feature_distribution_short", "feature_distribution"),
        [f"{end}_{c}" for c in _HISTORY for end in ("min", "max")],
    ),
    **dict.fromkeys(("promotion_incidence", "profile_sizes"), ["share_pct"]),
    "bgnbd_features": _TIMES,
    "customer_profile_features": _PROFILE,
    "customer_features": _FEATURES,
    "quantity_profile": ["average_quantity"],
    "sales_profile": ["min_sales", "average_sales", "max_sales"],
    "zero_quantity_summary": ["min_sales", "max_sales"],
    "zero_quantity_only_profile": ["total_sales"],
    "discount_sign_audit": ["minimum_value", "maximum_value"],
    "positive_retail_basket_summary": ["basket_sales"],
    "unusual_value_rates": [
        f"{c}_pct" for c in ("zero_quantity", "quantity_over_100", "zero_sales", "sales_over_1000")
    ],
    "reconcile_measures": [
        name
        for c in ("sales", "retail_discount", "manufacturer_coupon", "retail_coupon_match")
        for name in (f"raw_{c}", f"fact_{c}", f"{c}_difference")
    ],
    "invalid_basket_listing": _BASKETS[:3],
    "customer_overlap": ["pct_in_sample_active_in_holdout"],
    "estimated_customer_payment": [
        "sales_value", "estimated_customer_payment", "pre_retail_discount_value",
        "pre_discount_value_per_unit", "discounted_value_per_unit",
    ],
    "same_minute_listing": ["basket_sales_value"],
    "purchase_time_days": ["purchase_time_days"],
    "reconcile_features": ["fact_sales", "customer_sales", "sales_difference"],
    "one_time_purchasers": [f"{end}_{c}" for c in _HISTORY for end in ("minimum", "maximum")],
    "top_by_baskets": [
        *_HISTORY, "days_since_last_purchase", "historical_sales", "average_basket_value",
    ],
    "top_by_sales": ["historical_sales", "average_basket_value", *_RATES],
    "reconcile_holdout": [
        "fact_basket_holdout_sales", "customer_holdout_sales", "sales_difference",
    ],
    "model_input_sample": [*_HISTORY, "historical_sales", *_RATES],
    "between_median_and_mean": ["percentage"],
    "rate_baseline": ["observation_days"],
    "lowest_alive": [*_HISTORY, "days_since_last_purchase"],
    "largest_errors": _HISTORY,
}


def as_doubles(name: str, query: str) -> str:
    """The query with its decimal columns as doubles."""
    columns = DECIMALS.get(name)
    if not columns:
        return query
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({query.strip()})"
