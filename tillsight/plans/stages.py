"""The tables that one step hands to the next, each written once per session and data folder."""

from __future__ import annotations

import math
from functools import cached_property
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import baskets, checks, describe, evaluate, features, holdout, profiles
from tillsight.operators.bgnbd import BgnbdFit, BgnbdParams, fit
from tillsight.schema import Params
from tillsight.sources.storage import materialize, releases
from tillsight.sources.transactions import transactions_from_orders

# Lines that one task joins and groups in memory.
LINES_PER_PARTITION = 1_000_000
# Parameters the queries score with: a fixed set, so that SQL can compute the same scores.
THETA = BgnbdParams(r=1.2, alpha=60.0, a=0.6, b=8.0)
# A set near the best one for the histories made by rule, and its neighbours.
RULE_THETA = BgnbdParams(r=4.0, alpha=1500.0, a=0.55, b=1.6)
RULE_GRID = [
    BgnbdParams(*(getattr(RULE_THETA, name) * f for name, f in zip(("r", "alpha", "a", "b"), factors)))
    for factors in product((0.8, 1.0, 1.25), repeat=4)
]


class Stages:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def receipt_lines(self) -> DataFrame:
        """The lines straight from the given tables, not yet written."""
        return transactions_from_orders(self.table("lineitem"), self.table("orders"))

    @property
    def lines_by_basket(self) -> DataFrame:
        """The same lines, those of a basket together, in as many partitions as their number asks for."""
        lines = self.table("lineitem")
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return transactions_from_orders(
            lines, self.table("orders"), max(least, math.ceil(lines.count() / LINES_PER_PARTITION))
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """The imported lines."""
        return materialize(self.receipt_lines, "transactions")

    @cached_property
    def _fact(self) -> tuple[DataFrame, dict]:
        """The basket fact, and the days that bound the periods, observed in the pass that writes it.

        Lines are joined and grouped where the join put them: they are moved once, and not written.
        """
        lines = checks.Watch(self.lines_by_basket, {}, baskets.period_bounds())
        fact = baskets.fact_basket(lines.rows).sortWithinPartitions("basket_day")
        return materialize(fact, "fact_basket"), lines.values()

    @cached_property
    def params(self) -> Params:
        days = self._fact[1]
        bounds = self.spark.range(1).select(*[F.lit(day).alias(name) for name, day in days.items()])
        return baskets.read_params(baskets.parameter_row(bounds))

    @cached_property
    def fact_basket(self) -> DataFrame:
        """Sorted by day inside each file, so that a filter on the period skips row groups."""
        return self._fact[0]

    @cached_property
    def customer_features(self) -> DataFrame:
        table = features.customer_features(self.fact_basket, self.params)
        return materialize(table, "customer_features")

    @cached_property
    def holdout_activity(self) -> DataFrame:
        return holdout.holdout_activity(self.fact_basket, self.params)

    @cached_property
    def customer_holdout(self) -> DataFrame:
        table = holdout.customer_holdout(self.customer_features, self.holdout_activity)
        return materialize(table, "customer_holdout")

    @property
    def model_view(self) -> DataFrame:
        """Lazy, as the view it stands for."""
        return holdout.bgnbd_model_input(
            self.customer_features, self.customer_holdout, self.params
        )

    @cached_property
    def model_input(self) -> DataFrame:
        """The view's rows, written once: description and fit read them many times."""
        return materialize(self.model_view, "model_input")

    @cached_property
    def fitted(self) -> BgnbdFit:
        return fit(self.model_input)

    @cached_property
    def rule_histories(self) -> DataFrame:
        """Histories of households that buy at unlike rates and stop buying, made of the orders by rule:
        orders are thinned by customer, and of those left some are the customer's last. Whole
        numbers only, so any engine gives the same rows."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        share = F.expr("CASE o_custkey % 3 WHEN 0 THEN 25 WHEN 1 THEN 60 ELSE 100 END")
        stop = F.expr(
            "CASE o_custkey div 3 % 4 WHEN 0 THEN 2 WHEN 1 THEN 10 WHEN 2 THEN 25 ELSE 60 END"
        )
        orders = (
            self.table("orders")
            .where((key * 31 + customer * 17) % 100 < share)
            .select(
                customer.alias("household_key"),
                F.expr("datediff(o_orderdate, DATE'1995-01-01')").alias("day"),
                F.struct(F.to_date("o_orderdate"), key).alias("place"),
                ((key * 53 + 11) % 100 < stop).alias("last"),
            )
        )
        first = F.min("place").alias("first")
        ends = (
            orders.join(orders.groupBy("household_key").agg(first), "household_key")
            .where(F.col("last") & (F.col("place") > F.col("first")))
            .groupBy("household_key").agg(F.min("place").alias("end"))
        )
        bought = orders.join(ends, "household_key", "left").where(
            F.col("end").isNull() | (F.col("place") <= F.col("end"))
        )
        day = F.col("day")
        histories = bought.groupBy("household_key").agg(
            (F.countDistinct(day) - 1).alias("frequency"),
            (F.max(day) - F.min(day)).alias("recency_days"),
            (F.lit(2405) - F.min(day)).alias("observation_days"),
        )
        return materialize(histories, "rule_histories")

    @cached_property
    def scored(self) -> DataFrame:
        """Model input with promotion shares, baseline, P(alive), expected baskets and errors."""
        scores = evaluate.score(describe.normalized_promotion(self.model_input), THETA)
        return materialize(evaluate.prediction_errors(scores), "scored")

    @cached_property
    def profiled(self) -> DataFrame:
        """Scored households with sales quintile, group within it, levels and profile."""
        quintiles = materialize(describe.sales_quintile(self.scored), "quintiles")
        split = profiles.within_quintile_split(quintiles)
        cuts = profiles.profile_cutoffs(quintiles)
        return materialize(profiles.profile_levels(split, cuts), "profiled")


_open: dict[tuple[str, str], tuple[int, Stages]] = {}


def stages(spark: SparkSession, folder: str) -> Stages:
    app = spark.sparkContext.applicationId
    key, round_ = (app, folder.rstrip("/")), releases[app]
    if key not in _open or _open[key][0] != round_:  # released tables are gone, and are built anew
        _open[key] = (round_, Stages(spark, folder))
    return _open[key][1]
