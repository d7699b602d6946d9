"""Age profiling: loyalty sales by age segment, category / item and period.

Plan shape: the 10-day window and the loyalty / currency filters are applied
to the fact first (the window is also stated per channel on the raw date
columns so that each arm can prune row groups), the item lookup is a
size-checked broadcast, and one ``groupBy`` per output replaces the
reference's two identical aggregation levels (sum is associative).  The
per-customer sales then meet the loyalty snapshot on ``customer_id`` and are
summed by the report keys.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..sources.layout import since_day
from .joins import lookup_join

CATEGORY_KEYS = [
    "customer_id",
    "store_currency_code",
    "channel",
    "trans_order_date",
    "division",
    "department",
    "category",
]
ITEM_KEYS = [
    "customer_id",
    "sale_code",
    "store_currency_code",
    "channel",
    "TradeWeekCode",
    "division",
    "department",
    "category",
    "item",
]
REPORT_ITEM_KEYS = [k for k in ITEM_KEYS if k != "sale_code"]
PROFILE_KEYS = [
    "store_currency_code",
    "channel",
    "trans_order_date",
    "division",
    "department",
    "category",
    "age_segment",
]
PROFILE_ITEM_KEYS = [
    "store_currency_code",
    "channel",
    "TradeWeekCode",
    "division",
    "department",
    "category",
    "item",
    "age_segment",
]


def profile_window(as_of: datetime) -> tuple:
    """Inclusive date range: 10 days back to 1 day back from the run date."""
    day = dates.as_of_date(as_of)
    return day - timedelta(days=C.PROFILE_FIRST_DAY_BACK), day - timedelta(days=C.PROFILE_LAST_DAY_BACK)


def _windowed_loyalty_sales(fact_sales: DataFrame, as_of: datetime) -> DataFrame:
    first, last = profile_window(as_of)
    online = F.col("online_sale")
    store_day = F.to_date("transaction_date_time")
    order_day = F.to_date("ordered_date")
    channel = F.when(online == 0, F.lit(C.CHANNEL_STORE)).when(online == 1, F.lit(C.CHANNEL_ONLINE))
    order_date = F.when(online == 0, store_day).when(online == 1, order_day)
    # Same rows as "order_date BETWEEN first AND last", written per arm as
    # plain ranges on the raw columns: with a stored channel column the whole
    # disjunction is translated into a parquet filter.
    in_window = ((online == 0) & dates.day_range(F.col("transaction_date_time"), first, last)) | (
        (online == 1) & dates.day_range(F.col("ordered_date"), first, last)
    )
    return (
        since_day(fact_sales, first).filter((F.col("loyalty_flag") == 1) & F.col("store_currency_code").isin(*C.PROFILE_CURRENCIES))
        .filter(in_window)
        .select(
            "customer_id",
            "sale_code",
            "item_id",
            "store_currency_code",
            channel.alias("channel"),
            order_date.alias("trans_order_date"),
            "aud_sales",
        )
    )


def age_profile_sales(fact_sales: DataFrame, dim_item: DataFrame, as_of: datetime) -> DataFrame:
    """Loyalty sales of the last 10 days by customer, currency, channel, day and category."""
    items = dim_item.select("item_id", "division", "department", "category")
    sales = lookup_join(_windowed_loyalty_sales(fact_sales, as_of), items, "item_id", F.struct("customer_id", "trans_order_date"))
    return sales.groupBy(*CATEGORY_KEYS).agg(F.sum("aud_sales").alias("aud_sales"))


def age_profile_item_sales(
    fact_sales: DataFrame,
    dim_item: DataFrame,
    date_dimension: DataFrame,
    as_of: datetime,
    keys: list[str] = ITEM_KEYS,
) -> DataFrame:
    """Loyalty sales of the last 10 days by customer, sale, trade week and item.

    The item report passes :data:`REPORT_ITEM_KEYS`: it does not need the
    single sales, so they are summed per customer before any shuffle.

    The item key is the description with commas replaced by dashes, so two
    raw descriptions that differ only there are summed together.
    """
    items = dim_item.select(
        "item_id",
        "division",
        "department",
        "category",
        F.replace(F.col("item_description"), F.lit(","), F.lit("-")).alias("item"),
    )
    # Only the 10 window days of the calendar are needed: a broadcast of known size.
    first, last = profile_window(as_of)
    weeks = F.broadcast(
        date_dimension.filter(F.col("d").between(first, last)).select(
            F.col("d").alias("trans_order_date"), F.col("trade_week_code").alias("TradeWeekCode")
        )
    )
    sales = lookup_join(_windowed_loyalty_sales(fact_sales, as_of), items, "item_id", F.struct("customer_id", "sale_code"))
    sales = sales.join(weeks, "trans_order_date")
    return sales.groupBy(*keys).agg(F.sum("aud_sales").alias("aud_sales"))


def _with_segment(sales: DataFrame, perks: DataFrame) -> DataFrame:
    """``sales`` of the customers in the snapshot, with their age segment.

    NULL ids pair with each other, as in an in-memory merge; both sides hold
    a customer's rows summed up or ranked to one, so the NULL group is small.
    """
    segments = perks.select(F.col("customer_id").alias("_customer"), "age_segment")
    return sales.join(segments, F.col("customer_id").eqNullSafe(F.col("_customer"))).drop("_customer")


def _sum_by(df: DataFrame, keys: list[str]) -> DataFrame:
    # Rows with a NULL key are dropped and an all-NULL sum reports 0, as a
    # group-by over an in-memory frame would.
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("aud_sales"), F.lit(0)).cast("double").alias("aud_sales"))
    )


def age_profile(perks: DataFrame, category_sales: DataFrame) -> DataFrame:
    """Sales by currency, channel, day, category and age segment (Missing kept)."""
    return _sum_by(_with_segment(category_sales, perks), PROFILE_KEYS)


def age_profile_item(perks: DataFrame, item_sales: DataFrame) -> DataFrame:
    """Sales by currency, channel, trade week, item and age segment (Missing dropped)."""
    joined = _with_segment(item_sales, perks).filter(~F.col("age_segment").eqNullSafe(F.lit(C.MISSING)))
    return _sum_by(joined, PROFILE_ITEM_KEYS)
