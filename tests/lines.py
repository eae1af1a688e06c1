"""Small transaction tables for tests."""

from decimal import Decimal

from tillsight.schema import TRANSACTIONS

DEFAULTS = dict(
    household_key=1, basket_id=1, day=1, product_id=1, quantity=1, sales_value="1.00", store_id=1,
    retail_disc="0.00", trans_time=0, week_no=1, coupon_disc="0.00", coupon_match_disc="0.00",
)
MONEY = {"sales_value", "retail_disc", "coupon_disc", "coupon_match_disc"}


def lines(spark, *rows):
    """Each row is a dict of the columns that differ from the defaults."""
    table = []
    for row in rows:
        full = {**DEFAULTS, **row}
        table.append(
            tuple(
                Decimal(full[n]) if n in MONEY and full[n] is not None else full[n]
                for n in TRANSACTIONS.fieldNames()
            )
        )
    return spark.createDataFrame(table, TRANSACTIONS)


def week_of(day):
    return (day + 1) // 7 + 1


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()
