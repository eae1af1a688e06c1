"""All tables from receipt lines to profiles, written one after the other.

``python -m tillsight.plans.build SOURCE FOLDER [csv|parquet]`` builds them in a session of its own.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import audit, baskets, bgnbd, checks, describe, evaluate, features, holdout, profiles
from tillsight.schema import PROJECT_PARAMETERS
from tillsight.sources.storage import release, write_table
from tillsight.sources.transactions import load_transactions


def build(
    spark: SparkSession,
    source: str,
    folder: str,
    fmt: str = "parquet",
    weeks: tuple[int, int, int] = (78, 79, 102),
    penalizer: float = 0.0,
) -> dict[str, DataFrame]:
    """Writes every table below ``folder`` and returns them by name; ``read_table`` reads them later.

    A day must lie in one week, a basket have one household, day, week and store, times be clock times. The lines
    are read once: what they must keep, and the days that bound the periods, is observed in the pass that
    writes the baskets. A table with a broken constraint stops the build and does not take effect.
    """
    tables: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> DataFrame:
        tables[name] = write_table(df, f"{folder.rstrip('/')}/{name}", check)
        return tables[name]

    in_end, start, end = weeks
    lines = checks.Watch(
        load_transactions(spark, source, fmt),
        {"not a clock time": audit.not_a_clock_time()},
        baskets.period_bounds(in_end, start, end),
    )
    several = "a basket of several " + ", ".join(["household", *baskets.ONE_PER_BASKET])
    rows = checks.Watch(
        baskets.fact_basket(lines.rows, audited=True),
        {
            several: reduce(or_, [F.col(f"several_{c}") for c in baskets.ONE_PER_BASKET]),
            "fact_basket key": reduce(or_, [F.col(key).isNull() for key in baskets.KEYS]),
        },
    )

    def check_fact(fact: DataFrame) -> None:
        lines.require()
        rows.require()
        # (household, basket) is what the baskets are grouped by; a basket twice has two households
        checks.require_none(checks.check_primary_key(fact, ["basket_id"]), several)
        by_day = fact.select(F.col("basket_day").alias("day"), F.col("basket_week").alias("week_no"))
        checks.require_none(audit.day_week_violations(by_day), "a day of several weeks")
        if None in lines.values().values():
            raise ValueError(f"a week that bounds a period has no receipt lines: {lines.values()}")

    fact = keep(
        "fact_basket",
        rows.rows.drop(*[f"several_{c}" for c in baskets.ONE_PER_BASKET]).sortWithinPartitions("basket_day"),
        check_fact,
    )
    days = spark.range(1).select(*[F.lit(day).alias(name) for name, day in lines.values().items()])

    def check_parameters(row: DataFrame) -> None:
        missing = reduce(or_, [F.col(c).isNull() for c in PROJECT_PARAMETERS.fieldNames()])
        checks.require_none(row.filter(missing), "a parameter is missing")
        checks.require_none(checks.check_primary_key(row, ["parameter_id"]), "project_parameters key")
        checks.require_none(
            checks.check_predicate(row, F.col("parameter_id") == 1), "one parameter set, numbered 1"
        )

    row = baskets.parameter_row(days, in_end, start, end, end - start + 1)
    params = baskets.read_params(keep("project_parameters", row, check_parameters))

    def unique(table: str) -> Callable[[DataFrame], None]:
        return lambda df: checks.require_none(
            checks.check_primary_key(df, ["household_key"]), f"{table} key"
        )

    cf = keep("customer_features", features.customer_features(fact, params), unique("customer_features"))

    def check_holdout(ch: DataFrame) -> None:
        unique("customer_holdout")(ch)
        checks.require_none(
            checks.check_foreign_key(ch, cf, "household_key"), "customer_holdout without history"
        )

    ch = keep(
        "customer_holdout",
        holdout.customer_holdout(cf, holdout.holdout_activity(fact, params)),
        check_holdout,
    )

    histories = checks.Watch(holdout.bgnbd_model_input(cf, ch, params), describe.relationships())

    def check_histories(mi: DataFrame) -> None:
        histories.require()
        describe.assert_cohort(mi)

    mi = keep("bgnbd_model_input", histories.rows, check_histories)

    fitted = bgnbd.fit(mi, penalizer)
    if not fitted.converged:
        # the written table bgnbd_fit says so too
        warnings.warn(f"the model fit did not converge: {fitted}", stacklevel=2)
    keep("bgnbd_fit", bgnbd.fit_table(mi, fitted))
    scores = evaluate.score(describe.normalized_promotion(mi), fitted.params)
    scored = keep("scored", evaluate.activity_decile(evaluate.prediction_errors(scores)))
    quintiles = keep("sales_quintiles", describe.sales_quintile(scored))
    split = profiles.within_quintile_split(quintiles)
    levels = profiles.profile_levels(split, profiles.profile_cutoffs(quintiles))
    keep("profiles", levels, profiles.assert_profiles)
    return tables


def main() -> None:
    source, folder, *fmt = sys.argv[1:]
    spark = SparkSession.builder.appName("tillsight").getOrCreate()
    tables = build(spark, source, folder, *(fmt or ["parquet"]))
    evaluate.model_comparison(tables["scored"]).show(truncate=False)
    profiles.profile_relevance(tables["profiles"]).show(truncate=False)
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
