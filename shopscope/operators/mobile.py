"""Daily mobile-app report from nested app events.

Plan shape at scale:

* Sessions, transactions and first opens are three conditional counts of
  ONE pass over the events, grouped by (event day, country) with map-side
  partial aggregation (:func:`daily_counts`); the reference scans the event
  table once per metric.
* Before exploding the repeated fields, the arrays are filtered with
  higher-order ``filter`` so only matching elements are exploded (the
  reference explodes the full product of both arrays and filters after).
* Push revenue reproduces the reference's many-to-many left join by
  (user, session) WITHOUT emitting its pairs: each side is first reduced to
  one row per key (count and sum), and the counts are multiplied.  A hot
  session therefore costs one row per side, not k x m rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rules
from .joins import bounded_broadcast

DAILY_KEYS = ["ed", "country"]


def _country() -> Column:
    return rules.country_bucket(F.col("geo.country"))


def _event_day(col: str = "event_date") -> Column:
    return F.to_date(F.col(col), C.EVENT_DATE_FORMAT)


def push_sessions(events: DataFrame) -> DataFrame:
    """Distinct app opens carrying a ``Push`` parameter, with their session id."""
    pushed = F.filter("event_params", lambda p: p["value"]["string_value"] == C.PUSH_PARAM_VALUE)
    sessions = F.filter("user_properties", lambda u: u["key"] == C.SESSION_PROPERTY_KEY)
    base = events.filter(F.col("event_name") == C.EVENT_APP_OPEN).select(
        _country().alias("country"),
        "event_timestamp",
        _event_day().alias("event_date"),
        "event_name",
        "user_pseudo_id",
        F.explode(pushed).alias("param"),
        sessions.alias("_up"),
    )
    return (
        base.select("*", F.explode("_up").alias("up"))
        .select(
            "country",
            "event_timestamp",
            "event_date",
            "event_name",
            "user_pseudo_id",
            F.col("param.key").alias("event_key"),
            F.col("param.value.string_value").alias("event_key_value"),
            F.col("up.key").alias("user_properties_key"),
            F.col("up.value.int_value").alias("ga_session_id"),
        )
        .distinct()
    )


#: Bits of the session filter: 16 MB at most, however many sessions there are.
SESSION_BITS = 1 << 27


def _session_number() -> Column:
    """A number from 1 to SESSION_BITS of a row's (user, session)."""
    return F.pmod(F.xxhash64("user_pseudo_id", "ga_session_id"), F.lit(SESSION_BITS)) + 1


def session_filter(push: DataFrame) -> DataFrame:
    """Which (user, session) pairs may be among those of ``push``, as bitmaps of 4 KB by chunk (a Bloom filter of one hash)."""
    known = push.filter(F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull())
    n = known.select(_session_number().alias("n"))
    return n.groupBy(F.expr("bitmap_bucket_number(n)").alias("_chunk")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(n))").alias("_bits")
    )


def in_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows whose (user, session) may be in the filter: all that are, and few others.

    The filter is of a proven size (:data:`SESSION_BITS`), so it is broadcast and the
    rows are tested where they are read, before any shuffle.
    """
    numbered = rows.withColumn("_n", _session_number()).withColumn("_chunk", F.expr("bitmap_bucket_number(_n)"))
    tested = numbered.join(F.broadcast(sessions), "_chunk").withColumn("_at", F.expr("bitmap_bit_position(_n)"))
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int)")
    return tested.filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0).select(*rows.columns)


def ecomm_purchases(events: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Purchase events with their session id and summed value.

    ``among`` (a :func:`session_filter`) drops purchases that no push session can
    match before they are shuffled; rows with a NULL user or session match none.
    """
    sessions = F.filter("user_properties", lambda u: u["key"] == C.SESSION_PROPERTY_KEY)
    keys = ["country", "event_timestamp", "event_date", "event_name", "user_pseudo_id", "ga_session_id"]
    rows = (
        events.filter(F.col("event_name") == C.EVENT_PURCHASE)
        .select(
            _country().alias("country"),
            "event_timestamp",
            _event_day().alias("event_date"),
            "event_name",
            "user_pseudo_id",
            "event_value_in_usd",
            F.explode(sessions).alias("up"),
        )
        .withColumn("ga_session_id", F.col("up.value.int_value"))
        .select(*keys, "event_value_in_usd")
    )
    if among is not None:
        known = rows.filter(F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull())
        rows = in_sessions(known, among)
    return rows.groupBy(*keys).agg(F.sum("event_value_in_usd").alias("sales_usd"))


def push_revenue(push: DataFrame, purchases: DataFrame) -> DataFrame:
    """Per country and day: push session rows, distinct push users, push sales.

    Same numbers as ``push LEFT JOIN purchases USING (user, session)``
    followed by count(*), count(DISTINCT user), sum(sales): a push row that
    matches m purchase rows stands for max(m, 1) joined rows and adds the
    sum of their sales once per push row.
    """
    session = ["user_pseudo_id", "ga_session_id"]
    pushes = push.groupBy(*session, "country", "event_date").agg(F.count(F.lit(1)).alias("k"))
    bought = purchases.groupBy(*session).agg(F.count(F.lit(1)).alias("m"), F.sum("sales_usd").alias("s"))
    # The join shuffles on (user, session): rows whose session is NULL still
    # hash by user, so they spread over tasks (and never match).
    paired = pushes.join(bought, session, "left")
    return paired.groupBy("country", "event_date").agg(
        F.sum(F.col("k") * F.greatest(F.coalesce(F.col("m"), F.lit(0)), F.lit(1))).alias("push_sessions"),
        F.countDistinct("user_pseudo_id").alias("distinct_push_user"),
        F.sum(F.col("k") * F.col("s")).alias("push_sales_usd"),
    )


def daily_counts(events: DataFrame) -> DataFrame:
    """Sessions, transactions and first opens per (event date text, country)."""
    name = F.col("event_name")

    def n(event: str) -> Column:
        return F.count(F.when(name == event, F.lit(1)))

    return (
        events.filter(name.isin(C.EVENT_SESSION_START, C.EVENT_PURCHASE, C.EVENT_FIRST_OPEN))
        .select(F.col("event_date").alias("ed"), _country().alias("country"), "event_name")
        .groupBy(*DAILY_KEYS)
        .agg(
            n(C.EVENT_SESSION_START).alias("sessions"),
            n(C.EVENT_PURCHASE).alias("transactions"),
            n(C.EVENT_FIRST_OPEN).alias("first_opens"),
        )
    )


def daily_transactions(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("transactions") > 0).select(
        _event_day("ed").alias("event_date"), "country", "transactions"
    )


def first_opens(daily: DataFrame) -> DataFrame:
    """First opens per day with the running total per country.

    The running total covers only days that have first opens; its input is
    already one row per (day, country), so the per-country window is small.
    """
    running = Window.partitionBy("country").orderBy("event_date").rangeBetween(Window.unboundedPreceding, 0)
    return (
        daily.filter(F.col("first_opens") > 0)
        .select(_event_day("ed").alias("event_date"), "country", "first_opens")
        .withColumn("cumulative_opens", F.sum("first_opens").over(running))
    )


def opens_before(daily: DataFrame, first_day: date) -> DataFrame:
    """First opens per country of all days before ``first_day``: (country, opens_before), to be stored."""
    earlier = daily.filter(F.col("ed") < first_day.strftime("%Y%m%d"))
    return earlier.groupBy("country").agg(F.sum("first_opens").alias("opens_before"))


def _calendar(date_dimension: DataFrame) -> DataFrame:
    # One row per calendar day, broadcast after the size check; the key is
    # cast to text on the calendar side, as the event date is text.
    return bounded_broadcast(
        date_dimension.select(
            F.col("date_key").cast("string").alias("ed"),
            F.col("trade_week_code").alias("TradeWeekCode"),
            F.trunc(F.col("d"), "week").alias("week_commencing"),
        )
    )


def daily_sessions(daily: DataFrame, date_dimension: DataFrame) -> DataFrame:
    """Sessions per day with trade week, week commencing (Monday) and join key."""
    return (
        daily.filter(F.col("sessions") > 0)
        .join(_calendar(date_dimension), "ed")
        .select(
            _event_day("ed").alias("event_date"),
            "TradeWeekCode",
            "week_commencing",
            "country",
            F.concat(F.col("ed"), F.col("country")).alias("joinKey"),
            "sessions",
        )
    )


REPORT_COLUMNS = [
    "event_date",
    "TradeWeekCode",
    "week_commencing",
    "country",
    "joinKey",
    "first_opens",
    "cumulative_opens",
    "sessions",
    "transactions",
    "push_sessions",
    "distinct_push_sessions",
    "push_sales_usd",
]


def mobile_report(
    events: DataFrame,
    date_dimension: DataFrame,
    daily: DataFrame | None = None,
    first_day: date | None = None,
    last_day: date | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """The 12-column daily report, one row per (day, country) with sessions.

    All three daily metrics come from ONE aggregate of the events
    (:func:`daily_counts`), so the report needs no self-joins: the running
    total of first opens is a window over that aggregate (days without
    first opens add 0 to it and report 0, as in the original), and only the
    push revenue is joined on (day, country).  The original joins its
    metrics on (day, country), where a NULL country matches nothing, so
    NULL-country rows report 0 for every metric except sessions.

    ``daily`` may be a stored copy of :func:`daily_counts` (for instance the
    counters kept up to date by :mod:`shopscope.streaming`), in which case
    only the push-revenue branches scan the events.

    ``first_day`` / ``last_day`` restrict the reported days.  The push-open
    branch then reads only those days (``event_date`` is ``yyyyMMdd`` text,
    so text order is date order and the filter prunes date partitions).
    Purchases are still matched over the whole history, because a session
    can cross midnight, but only those that may belong to a push session of
    the shown days are shuffled (:func:`session_filter`).  The running total
    counts every earlier day: over all events, or with ``before`` (the stored
    :func:`opens_before` of ``first_day``) on top of those totals, so that the
    counters too read the shown days only.
    """
    running = Window.partitionBy("country").orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    if before is not None and first_day is None:
        raise ValueError("before needs the first_day that it was made for")
    counted = daily
    if before is not None:
        low = first_day.strftime("%Y%m%d")
        counted = daily.filter(F.col("ed") >= low) if daily is not None else daily_counts(events.filter(F.col("event_date") >= low))
    elif daily is None:
        counted = daily_counts(events)
    per_day = counted.select(
        "ed", _event_day("ed").alias("event_date"), "country", "sessions", "transactions", "first_opens"
    ).withColumn("running_opens", F.sum("first_opens").over(running))
    if before is not None:
        # One row per country (a handful), joined NULL-safely.
        totals = bounded_broadcast(before.select(F.col("country").alias("_country"), "opens_before"))
        per_day = per_day.join(totals, F.col("country").eqNullSafe(F.col("_country")), "left").withColumn(
            "running_opens", F.col("running_opens") + F.coalesce("opens_before", F.lit(0))
        )
    calendar = _calendar(date_dimension)
    shown = per_day.filter(F.col("sessions") > 0)
    opens = events
    if first_day is not None:
        shown = shown.filter(F.col("ed") >= first_day.strftime("%Y%m%d"))
        opens = opens.filter(F.col("event_date") >= first_day.strftime("%Y%m%d"))
    if last_day is not None:
        shown = shown.filter(F.col("ed") <= last_day.strftime("%Y%m%d"))
        opens = opens.filter(F.col("event_date") <= last_day.strftime("%Y%m%d"))
    sessions = shown.join(calendar, "ed")
    pushed = push_sessions(opens)
    limited = first_day is not None or last_day is not None
    push = push_revenue(pushed, ecomm_purchases(events, session_filter(pushed) if limited else None)).withColumnRenamed(
        "distinct_push_user", "distinct_push_sessions"
    )
    joined = sessions.join(push, ["event_date", "country"], "left")
    matched = F.col("country").isNotNull()

    def metric(value: Column) -> Column:
        return F.when(matched, F.coalesce(value, F.lit(0))).otherwise(F.lit(0))

    return joined.select(
        "event_date",
        "TradeWeekCode",
        "week_commencing",
        "country",
        F.concat(F.col("ed"), F.col("country")).alias("joinKey"),
        metric(F.col("first_opens")).alias("first_opens"),
        metric(F.when(F.col("first_opens") > 0, F.col("running_opens"))).alias("cumulative_opens"),
        F.col("sessions"),
        metric(F.col("transactions")).alias("transactions"),
        metric(F.col("push_sessions")).alias("push_sessions"),
        metric(F.col("distinct_push_sessions")).alias("distinct_push_sessions"),
        metric(F.col("push_sales_usd")).alias("push_sales_usd"),
    ).orderBy("country", "event_date")
