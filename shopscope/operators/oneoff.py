"""One-off extracts kept (commented out) beside the customer view.

* :func:`high_value_extract` - e-mail addresses with a loyalty sale line
  over 275 in the customer-view window, with their online history.
* :func:`plus_size_ladieswear_customers` - customers who bought a ``+``
  size in ladieswear in the last 365 days.
* :func:`sports_original` - the earlier sports rule, where buying anything
  besides AFL / NRL items makes a customer Multi.
* :func:`sports_flag_pairs` - customer counts by (AFL, NRL) purchase flags.

The country-prefixed sales-rank extract that sits with them reads a table
that is never defined, so it cannot be rebuilt.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates, rules
from ..sources.layout import since_day
from .joins import bounded_broadcast

# Fixed values of the one-off extracts.
HIGH_VALUE_SALES = 275
CHANNEL_NO_ONLINE = "No Prior Online Shop"
CHANNEL_ONLINE_BEFORE = "Shopped Online before"
PLUS_SIZE_MARK = "+"
CURVE_SEGMENT = "CURVE"


def high_value_extract(memberships: DataFrame, summary: DataFrame, crm_customer: DataFrame) -> DataFrame:
    """(email_address, Channel) of high-value addresses, highest sales first.

    ``memberships`` is the full customer base (one row per membership, not
    only rank 1, so a customer with two memberships counts twice, as in the
    original); ``summary`` is :func:`~shopscope.operators.segments.transaction_summary`.
    Addresses are grouped with map-side partial aggregation, so a shared
    address (one key holding many customers) collapses before the shuffle.
    """
    sales = F.coalesce(F.col("AUDSales"), F.lit(0))
    emails = crm_customer.select("customer_id", "email_address")
    per_email = (
        memberships.select("customer_id")
        .join(summary.select("customer_id", "channel_online", "AUDSales"), "customer_id", "left")
        .join(emails, "customer_id", "left")
        .groupBy("email_address")
        .agg(
            F.max(F.coalesce(F.col("channel_online"), F.lit(0))).alias("channel_online"),
            F.max(rules.flag(sales > HIGH_VALUE_SALES)).alias("segment_high_value"),
            F.sum(sales).alias("AUDsales"),
        )
    )
    # LEN ignores trailing spaces.
    visible_length = F.length(F.rtrim(F.col("email_address")))
    channel = F.when(F.coalesce(F.col("channel_online"), F.lit(0)) == 0, F.lit(CHANNEL_NO_ONLINE)).otherwise(
        F.lit(CHANNEL_ONLINE_BEFORE)
    )
    return (
        per_email.filter((F.col("segment_high_value") == 1) & (visible_length > 2))
        # Ties on sales are ordered by address: the range-partitioned sort then
        # splits a popular sales value over several tasks.
        .orderBy(F.col("AUDsales").desc(), F.col("email_address"))
        .select("email_address", channel.alias("Channel"))
    )


def plus_size_ladieswear_customers(fact_sales: DataFrame, dim_item: DataFrame, as_of: datetime) -> DataFrame:
    """Distinct customers with a ladieswear ``+`` size line in the last 365 days (any channel)."""
    items = bounded_broadcast(
        dim_item.filter(
            (F.col("department") == C.DEPT_LADIESWEAR) & rules.contains_text(F.upper(F.col("size")), PLUS_SIZE_MARK)
        ).select("item_id")
    )
    first = dates.days_back_bound(as_of, C.KIDS_DAYS)
    lines = since_day(fact_sales, first).filter(dates.on_or_after(F.col("transaction_date_time"), first)).select("customer_id", "item_id")
    return lines.join(items, "item_id").select("customer_id", F.lit(CURVE_SEGMENT).alias("segment")).distinct()


def sports_original(afl: Column, nrl: Column, other: Column) -> Column:
    """The earlier sports rule: AFL / NRL only when nothing else was bought."""
    other0 = F.coalesce(other, F.lit(0))
    return (
        F.when((afl == 1) & (F.coalesce(nrl, F.lit(0)) == 0) & (other0 == 0), F.lit("AFL"))
        .when((nrl == 1) & (F.coalesce(afl, F.lit(0)) == 0) & (other0 == 0), F.lit("NRL"))
        .when(((afl == 1) | (nrl == 1)) & (other0 == 1), F.lit("Multi"))
    )


def _customers_with_summary(customers: DataFrame, summary: DataFrame) -> DataFrame:
    return customers.select("customer_id").join(summary, "customer_id", "left")


def sports_original_counts(customers: DataFrame, summary: DataFrame) -> DataFrame:
    """Customers per value of the earlier sports rule (NULL when none applies)."""
    joined = _customers_with_summary(customers, summary)
    rule = sports_original(F.col("trans_AFL"), F.col("trans_NRL"), F.col("trans_other_than_AFL_NRL"))
    return joined.groupBy(rule.alias("Transacted_Cat_Sports_original")).agg(F.count(F.lit(1)).alias("n"))


def sports_flag_pairs(customers: DataFrame, summary: DataFrame) -> DataFrame:
    """Customers per (trans_AFL, trans_NRL) pair, NULL when no summary row."""
    joined = _customers_with_summary(customers, summary)
    return joined.groupBy("trans_AFL", "trans_NRL").agg(F.count(F.lit(1)).alias("c"))
