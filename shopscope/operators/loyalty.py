"""Loyalty customer base (one row per membership) and the loyalty snapshot.

Plan shape: active loyalty accounts are de-duplicated and joined to started
memberships on ``loyalty_customer_id``; ``row_number`` per ``customer_id``
ranks these narrow rows or picks the earliest one; only the rows that remain
meet the customer, sign-up store, store and location lookups.  The store and
location dimensions are broadcast only after a row-count check.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates, rules
from .joins import bounded_broadcast
from .ranking import row_number_by

# Column order of the reference outputs.
BASE_COLUMNS = [
    "customer_id",
    "date_from_f",
    "date_to_f",
    "insert_user",
    "loyalty_code",
    "gender",
    "email_address",
    "age_band",
    "age_segment",
    "age",
    "signup_storetype",
    "store_sign_up",
    "cust_postcode",
    "uq_cust_rank",
]


def _started(loyalty_customer: DataFrame, loyalty_member: DataFrame, as_of: datetime) -> DataFrame:
    """Started memberships of active accounts, without any lookup."""
    # The DISTINCT removes duplicate account rows map-side before its shuffle,
    # so a duplicated (hot) account collapses to one row per task.  Clustering
    # by loyalty_customer_id first would save the second exchange but ship
    # every duplicate of a hot account to one task.
    accounts = (
        loyalty_customer.filter(F.col("status_ind") == C.ACTIVE_STATUS)
        .select("customer_id", "loyalty_customer_id", "loyalty_code")
        .distinct()
    )
    started = (
        loyalty_member.select(
            "loyalty_customer_id",
            F.to_date("date_from").alias("date_from_f"),
            F.to_date("date_to").alias("date_to_f"),
            rules.insert_user_norm(F.col("insert_user")).alias("insert_user"),
        )
        # A date compared with the run time is taken at midnight: a
        # membership starting on the run date has started.
        .filter(F.col("date_from_f") <= F.lit(dates.as_of_date(as_of)))
    )
    return accounts.join(started, "loyalty_customer_id")


def _with_lookups(
    rows: DataFrame,
    crm_customer: DataFrame,
    cust_store: DataFrame,
    dim_store: DataFrame,
    location: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """``rows`` with customer, sign-up store, store and location attributes.

    Both tables are left-joined to the rows one after the other: the second
    join finds its rows already dealt by customer, and customers without a
    kept row never meet their sign-up store.
    """
    customers = crm_customer.select("customer_id", "birth_date", "billing_post_code", "gender", "email_address")
    signups = cust_store.select("customer_id", "store_sign_up")
    # Store type and store postcode in one small lookup.  The location keys on
    # the matched store code, so (m LEFT JOIN store) LEFT JOIN location equals
    # m LEFT JOIN (store LEFT JOIN location): one broadcast instead of two.
    stores = bounded_broadcast(
        dim_store.select("store_code", "store_type")
        .join(location.select("location_code", "postcode"), F.col("store_code") == F.col("location_code"), "left")
        .select("store_code", "store_type", "postcode")
    )
    known = rows.join(customers, "customer_id", "left").join(signups, "customer_id", "left")
    return known.join(stores, F.col("store_sign_up") == F.col("store_code"), "left").withColumn(
        "age_years", dates.year_boundaries(as_of, F.col("birth_date"))
    )


# Earliest membership first; the extra keys make the order total.
RANK_ORDER = ["date_from_f", "loyalty_customer_id", "loyalty_code", "insert_user", "date_to_f"]


def _first(started: DataFrame) -> DataFrame:
    """The earliest membership of each customer (``uq_cust_rank`` 1).

    Ranked before any lookup: the window follows a join on the account, so
    ``row_number() ... = 1`` becomes a ``WindowGroupLimit`` on both sides of
    one exchange and every map task hands on one row per customer.
    """
    order = [F.col(c).asc_nulls_first() for c in RANK_ORDER]
    rank = F.row_number().over(Window.partitionBy("customer_id").orderBy(*order))
    return started.withColumn("uq_cust_rank", rank).filter(F.col("uq_cust_rank") == 1)


def _scv_columns() -> list[F.Column]:
    """Customer-view flavour: gender as it is, the view's age bands, unknown age 9999."""
    age, birth = F.col("age_years"), F.col("birth_date")
    made = {
        "age_band": rules.age_band_scv(age, birth),
        "age_segment": rules.age_segment(age, birth),
        "age": F.coalesce(age, F.lit(C.UNKNOWN_AGE)),
        "signup_storetype": F.col("store_type"),
        "cust_postcode": rules.customer_postcode(F.col("store_type"), F.col("postcode"), F.col("billing_post_code")),
    }
    return [made[c].alias(c) if c in made else F.col(c) for c in BASE_COLUMNS]


def membership_rows(
    loyalty_customer: DataFrame,
    loyalty_member: DataFrame,
    crm_customer: DataFrame,
    cust_store: DataFrame,
    dim_store: DataFrame,
    location: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Customer-view flavour, one row per started membership (no rank)."""
    started = _started(loyalty_customer, loyalty_member, as_of).withColumn("uq_cust_rank", F.lit(None).cast("int"))
    rows = _with_lookups(started, crm_customer, cust_store, dim_store, location, as_of)
    return rows.select(*_scv_columns()).drop("uq_cust_rank")


def loyalty_base(
    loyalty_customer: DataFrame,
    loyalty_member: DataFrame,
    crm_customer: DataFrame,
    cust_store: DataFrame,
    dim_store: DataFrame,
    location: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Every started membership with its rank per customer (earliest first).

    All memberships are ranked, before the lookups; a customer with very many
    of them is dealt out by start date
    (:func:`~shopscope.operators.ranking.row_number_by`).
    """
    started = _started(loyalty_customer, loyalty_member, as_of)
    ranked = row_number_by(started, "customer_id", RANK_ORDER, "uq_cust_rank")
    return _with_lookups(ranked, crm_customer, cust_store, dim_store, location, as_of).select(*_scv_columns())


def scv_customers(
    loyalty_customer: DataFrame,
    loyalty_member: DataFrame,
    crm_customer: DataFrame,
    cust_store: DataFrame,
    dim_store: DataFrame,
    location: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """First membership per customer (rank 1), customer-view flavour."""
    first = _first(_started(loyalty_customer, loyalty_member, as_of))
    return _with_lookups(first, crm_customer, cust_store, dim_store, location, as_of).select(*_scv_columns())


def perks_snapshot(
    loyalty_customer: DataFrame,
    loyalty_member: DataFrame,
    crm_customer: DataFrame,
    cust_store: DataFrame,
    dim_store: DataFrame,
    location: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Loyalty snapshot: one row per customer (earliest membership).

    Gender is normalised to M / F / Missing, the age band is the snapshot
    variant and the age stays NULL when the birth date is unknown.
    """
    first = _first(_started(loyalty_customer, loyalty_member, as_of))
    m = _with_lookups(first, crm_customer, cust_store, dim_store, location, as_of)
    age, birth = F.col("age_years"), F.col("birth_date")
    return m.select(
        "customer_id",
        "date_from_f",
        "date_to_f",
        "insert_user",
        "loyalty_code",
        rules.gender_norm(F.col("gender")).alias("gender"),
        "email_address",
        rules.age_band_perks(age, birth).alias("age_band"),
        rules.age_segment(age, birth).alias("age_segment"),
        age.alias("age"),
        F.col("store_type").alias("signup_storetype"),
        "store_sign_up",
        rules.customer_postcode(F.col("store_type"), F.col("postcode"), F.col("billing_post_code")).alias(
            "cust_postcode"
        ),
        "uq_cust_rank",
    )
