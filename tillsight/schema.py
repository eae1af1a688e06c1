"""Declared table schemas and the time-split parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Row
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)


def _schema(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


TRANSACTIONS = _schema(
    ("household_key", IntegerType()),
    ("basket_id", LongType()),
    ("day", ShortType()),
    ("product_id", IntegerType()),
    ("quantity", IntegerType()),
    ("sales_value", DecimalType(12, 2)),
    ("store_id", IntegerType()),
    ("retail_disc", DecimalType(12, 2)),
    ("trans_time", ShortType()),
    ("week_no", ShortType()),
    ("coupon_disc", DecimalType(12, 2)),
    ("coupon_match_disc", DecimalType(12, 2)),
)

PROJECT_PARAMETERS = _schema(
    ("parameter_id", ShortType()),
    ("in_sample_end_week", ShortType()),
    ("holdout_start_week", ShortType()),
    ("holdout_end_week", ShortType()),
    ("in_sample_end_day", ShortType()),
    ("holdout_start_day", ShortType()),
    ("holdout_end_day", ShortType()),
    ("holdout_weeks", ShortType()),
)

FACT_BASKET = _schema(
    ("household_key", IntegerType()),
    ("basket_id", LongType()),
    ("basket_day", ShortType()),
    ("basket_week", ShortType()),
    ("store_id", IntegerType()),
    ("basket_trans_time", ShortType()),
    ("basket_product_lines_count", IntegerType()),
    ("basket_unique_product_count", IntegerType()),
    ("basket_total_quantity", LongType()),
    ("basket_sales_value", DecimalType(14, 2)),
    ("retail_discount_amount", DecimalType(14, 2)),
    ("manufacturer_coupon_amount", DecimalType(14, 2)),
    ("retail_coupon_match_amount", DecimalType(14, 2)),
    ("estimated_pre_retail_discount_value", DecimalType(14, 2)),
    ("has_retail_discount", BooleanType()),
    ("has_manufacturer_coupon", BooleanType()),
    ("has_retail_coupon_match", BooleanType()),
    ("is_valid_purchase_basket", BooleanType()),
)

CUSTOMER_FEATURES = _schema(
    ("household_key", IntegerType()),
    ("in_sample_baskets", IntegerType()),
    ("first_purchase_time_days", DecimalType(14, 6)),
    ("last_purchase_time_days", DecimalType(14, 6)),
    ("frequency", IntegerType()),
    ("recency_days", DecimalType(14, 6)),
    ("observation_days", DecimalType(14, 6)),
    ("days_since_last_purchase", DecimalType(14, 6)),
    ("active_weeks", IntegerType()),
    ("historical_sales", DecimalType(16, 2)),
    ("average_basket_value", DecimalType(14, 2)),
    ("historical_quantity", LongType()),
    ("retail_discount_basket_rate", DecimalType(12, 6)),
    ("retail_discount_per_basket", DecimalType(14, 4)),
    ("total_retail_discount", DecimalType(16, 2)),
    ("manufacturer_coupon_basket_rate", DecimalType(12, 6)),
    ("total_manufacturer_coupon", DecimalType(16, 2)),
    ("manufacturer_coupon_amount_per_redeeming_basket", DecimalType(14, 4)),
    ("retail_coupon_match_basket_rate", DecimalType(12, 6)),
    ("retail_coupon_match_per_basket", DecimalType(14, 4)),
    ("total_retail_coupon_match", DecimalType(16, 2)),
    ("estimated_pre_retail_discount_value", DecimalType(16, 2)),
    ("is_bgnbd_eligible", BooleanType()),
)

CUSTOMER_HOLDOUT = _schema(
    ("household_key", IntegerType()),
    ("actual_holdout_baskets", IntegerType()),
    ("actual_holdout_purchase_days", IntegerType()),
    ("actual_holdout_active_weeks", IntegerType()),
    ("actual_holdout_sales", DecimalType(16, 2)),
    ("was_active_in_holdout", BooleanType()),
)


@dataclass(frozen=True)
class Params:
    """The single parameter row, held on the driver so that every later filter is a literal."""

    in_sample_end_week: int
    holdout_start_week: int
    holdout_end_week: int
    in_sample_end_day: int
    holdout_start_day: int
    holdout_end_day: int
    holdout_weeks: int

    @classmethod
    def from_row(cls, row: Row) -> "Params":
        return cls(**{name: row[name] for name in cls.__dataclass_fields__})

    @property
    def prediction_horizon_days(self) -> int:
        return self.holdout_end_day - self.in_sample_end_day
