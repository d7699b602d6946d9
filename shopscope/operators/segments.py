"""Single customer view (SCV): purchase segments, sports affinity, life stage.

Plan shape at scale:

* Item rules are evaluated once per item on the dimension side and packed
  into one INT bit mask (:func:`item_flags`), so the fact is joined with a
  narrow ``item_id -> flags`` table that is broadcast after a row-count
  check, and the per-customer flags are two ``bit_or`` aggregates.
* The two windows over the sale fact (C7: 365 days in store / 1 day online;
  C8: 365 days of kids sales, all channels) are read in ONE scan and
  aggregated in ONE shuffle by ``customer_id`` (:func:`fact_summary`); every
  C7 flag is guarded by the C7 window so results equal two separate passes.
* E-mail opens and clicks on sports campaigns are reduced to one row per
  subscriber before they meet the customer base; NULL e-mails are spread
  over the join and an address shared by very many customers is salted
  over several tasks, so neither can pile into one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates, rules
from ..sources.layout import since_day
from .joins import DEFAULT_HOT_KEY_ROWS, bounded_broadcast, hot_key_left_join, lookup_join, spread_null_key

# Bit positions of the per-line rule mask: the item rules, then the channel.
LINE_BITS = [
    "kids_div",
    "baby",
    "mens",
    "curve",
    "plus_bottoms",
    "petite",
    "afl",
    "nrl",
    "afl_or_nrl",
    "kids",
    "cobrand",
    "supre",
    "online",
    "store",
]
BIT = {name: 1 << i for i, name in enumerate(LINE_BITS)}

SCV_COLUMNS = [
    "customer_id",
    "email_address",
    "Transacted_KIDS",
    "Transacted_BABY",
    "Transacted_Cat_Menswear",
    "Transacted_KIDS_flag",
    "Transacted_Cat_Sports",
    "Transacted_Cat_Curve",
    "Transacted_Cat_CoBrands",
    "Transacted_Cat_SUPRE",
    "Transacted_Cat_Curve_Bottoms",
    "Transacted_Cat_Petite",
    "LIFESTAGE",
]


# -- item side -----------------------------------------------------------------
def _is_plus_bottoms() -> Column:
    """Rule of the plus-size bottoms, a predicate on one item row."""
    size = F.col("size")
    return (
        F.col("division").isin(*C.PLUS_BOTTOMS_DIVISIONS)
        & F.col("department").isin(*C.PLUS_BOTTOMS_DEPARTMENTS)
        & rules.is_bottoms(F.col("category"))
        & (size.like(C.PLUS_SIZE_PATTERN) | size.isin(*C.PLUS_SIZES))
    )


def plus_bottoms(dim_item: DataFrame) -> DataFrame:
    """Plus-size bottoms: ladies / body bottoms in a size containing L, or 14 / 16."""
    bottoms = F.when(rules.is_bottoms(F.col("category")), F.lit(C.BOTTOMS_LABEL)).otherwise(F.lit(""))
    return (
        dim_item.filter(_is_plus_bottoms())
        .select(
            "division",
            "department",
            "category",
            "item_id",
            F.col("item_colour_code").alias("prod_id"),
            "size",
            F.lit(1).alias("bottoms_14plus"),
            bottoms.alias("tops_bottoms"),
        )
        .distinct()
    )


def item_rules(dim_item: DataFrame) -> DataFrame:
    """One row per item with a boolean column per item rule (NULL-safe: never NULL).

    The plus-size rule looks at the item row itself (item ids are keys), so
    it needs no lookup join.
    """
    div, dept, cat = F.col("division"), F.col("department"), F.col("category")
    desc, size = F.col("item_description"), F.col("size")
    sports_text = rules.contains_text(desc, C.SPORTS_AFL_TEXT) | rules.contains_text(desc, C.SPORTS_NRL_TEXT)
    tests = {
        "kids_div": div == C.DIV_KIDS,
        "baby": dept == C.DEPT_BABY,
        "mens": rules.is_mens(div, dept),
        "curve": cat == C.CAT_CURVE,
        "plus_bottoms": _is_plus_bottoms(),
        "petite": rules.is_petite(div, dept, cat, size),
        "afl": rules.is_sports(div, desc, C.SPORTS_AFL_TEXT),
        "nrl": rules.is_sports(div, desc, C.SPORTS_NRL_TEXT),
        "afl_or_nrl": sports_text & (div == C.DIV_COMMUNITY),
        "kids": div.isin(*C.KIDS_DIVISIONS),
        "cobrand": div.isin(*C.COBRAND_DIVISIONS),
        "supre": div == C.DIV_SUPRE,
    }
    # CASE WHEN rule THEN 1 ELSE 0: a NULL test counts as "no".
    return dim_item.select(
        "item_id", *[(rules.flag(t) == 1).alias(f"is_{n}") for n, t in tests.items()]
    )


def item_flags(dim_item: DataFrame) -> DataFrame:
    """``(item_id, flags)``: one INT per item with one bit per rule (:data:`LINE_BITS`).

    Packing the twelve rules into one INT keeps the broadcast lookup at
    about 24 bytes per item (the bound of 4 million items is ~100 MB) and lets the
    per-customer aggregation keep two ints instead of twenty maxima.
    """
    r = item_rules(dim_item)
    mask = sum(
        (F.when(F.col(f"is_{n}"), F.lit(BIT[n])).otherwise(F.lit(0)) for n in LINE_BITS[:12]),
        F.lit(0),
    )
    return r.select("item_id", mask.cast("int").alias("flags"))


def _bit(mask: Column, name: str) -> Column:
    """0/1 value of one bit of ``mask`` (NULL when the mask is NULL)."""
    return F.shiftright(mask, LINE_BITS.index(name)).bitwiseAND(F.lit(1))


def _has(mask: Column, name: str) -> Column:
    return mask.bitwiseAND(F.lit(BIT[name])) != 0


# -- fact side -----------------------------------------------------------------
def scv_window(as_of: datetime) -> Column:
    """C7 window: online orders of the last day, store sales of the last 365 days."""
    online_first = dates.days_back_bound(as_of, C.SCV_ONLINE_DAYS)
    store_first = dates.days_back_bound(as_of, C.SCV_STORE_DAYS)
    online = F.col("online_sale")
    return ((online == 1) & dates.on_or_after(F.col("ordered_date"), online_first)) | (
        (online == 0) & dates.on_or_after(F.col("transaction_date_time"), store_first)
    )


def kids_window(as_of: datetime) -> Column:
    """C8 window: any channel, transaction date within the last 365 days."""
    return dates.on_or_after(F.col("transaction_date_time"), dates.days_back_bound(as_of, C.KIDS_DAYS))


def channel_bits() -> Column:
    """The channel bits of a fact line."""
    online = F.col("online_sale")
    return F.when(online == 1, F.lit(BIT["online"])).otherwise(F.lit(0)).bitwiseOR(
        F.when(online == 0, F.lit(BIT["store"])).otherwise(F.lit(0))
    )


def with_item_flags(lines: DataFrame, dim_item: DataFrame, max_items: int) -> DataFrame:
    """Fact lines of known items with the ``mask`` of their item and channel."""
    # One flags row per item, so the item table's own row count bounds the lookup.
    flagged = lookup_join(
        lines, item_flags(dim_item), "item_id", F.struct("customer_id", "transaction_date_time"), max_items, dim_item.select("item_id")
    )
    return flagged.withColumn("mask", F.col("flags").bitwiseOR(channel_bits()))


def clamped_sales() -> Column:
    """Sales of a fact line, returns counted as 0."""
    return F.when(F.col("aud_sales") < 0, F.lit(0)).otherwise(F.col("aud_sales"))


def fact_summary(fact_sales: DataFrame, dim_item: DataFrame, as_of: datetime, max_items: int = 4_000_000) -> DataFrame:
    """Per-customer purchase flags (C7) and kids sales (C8) from one fact scan.

    Every "bought X" flag is ``max(case when rule then 1 else 0 end)`` over
    the C7 lines and every "bought something other than X" flag is
    ``max(case when rule then 0 else 1 end)``.  With one bit per rule these
    are the bits of ``bit_or(mask)`` and ``bit_or(~mask)`` over the C7 lines
    (NULL when the customer has none), so the aggregation buffer is two ints.
    ``n_summary_lines`` / ``n_kids_lines`` count the lines in each window so
    that either summary can be recovered exactly.
    """
    in_c7, in_c8 = F.col("in_c7"), F.col("in_c8")
    lines = (
        since_day(fact_sales, min(dates.days_back_bound(as_of, n) for n in (C.SCV_ONLINE_DAYS, C.SCV_STORE_DAYS, C.KIDS_DAYS)))
        .filter(F.col("loyalty_flag") == 1)
        .select(
            "customer_id",
            "item_id",
            "online_sale",
            "transaction_date_time",
            "aud_sales",
            scv_window(as_of).alias("in_c7"),
            kids_window(as_of).alias("in_c8"),
        )
        .filter(in_c7 | in_c8)
    )
    lines = with_item_flags(lines, dim_item, max_items)
    mask, clamped = F.col("mask"), clamped_sales()
    kids_line = in_c8 & _has(mask, "kids")
    summary = lines.groupBy("customer_id").agg(
        dates.max_ddmmyyyy_text(in_c7 & _has(mask, "kids_div"), F.col("transaction_date_time")).alias(
            "Transacted_KIDS"
        ),
        F.bit_or(F.when(in_c7, mask)).alias("seen"),
        F.bit_or(F.when(in_c7, F.bitwise_not(mask))).alias("seen_not"),
        F.sum(F.when(in_c7, clamped)).alias("AUDSales"),
        F.sum(F.when(kids_line, clamped)).alias("kids_AUDSales"),
        F.count(F.when(in_c7, F.lit(1))).alias("n_summary_lines"),
        F.count(F.when(kids_line, F.lit(1))).alias("n_kids_lines"),
    )
    return unpacked_summary(summary)


def unpacked_summary(summary: DataFrame) -> DataFrame:
    """The flag columns of a per-customer summary with the masks ``seen`` and ``seen_not``."""
    seen, seen_not = F.col("seen"), F.col("seen_not")
    unpacked = {
        "Transacted_BABY": _bit(seen, "baby"),
        "trans_other_than_BABY": _bit(seen_not, "baby"),
        "trans_mens": _bit(seen, "mens"),
        "trans_other_than_mens": _bit(seen_not, "mens"),
        "trans_curve": _bit(seen, "curve"),
        "trans_other_than_curve": _bit(seen_not, "curve"),
        "trans_curve_bottoms": _bit(seen, "plus_bottoms"),
        "trans_petite": _bit(seen, "petite"),
        "trans_AFL": _bit(seen, "afl"),
        "trans_NRL": _bit(seen, "nrl"),
        "trans_other_than_AFL_NRL": _bit(seen_not, "afl_or_nrl"),
        "trans_Kids": _bit(seen, "kids"),
        "trans_other_than_Kids": _bit(seen_not, "kids"),
        "trans_cobrands": _bit(seen, "cobrand"),
        "trans_other_than_cobrands": _bit(seen_not, "cobrand"),
        "trans_supre": _bit(seen, "supre"),
        "trans_other_than_supre": _bit(seen_not, "supre"),
        "channel_online": _bit(seen, "online"),
        "channel_store": _bit(seen, "store"),
    }
    return summary.select(
        "customer_id",
        "Transacted_KIDS",
        *[expr.alias(name) for name, expr in unpacked.items()],
        "AUDSales",
        "kids_AUDSales",
        "n_summary_lines",
        "n_kids_lines",
    )


TRANSACTION_SUMMARY_COLUMNS = [
    "customer_id",
    "Transacted_KIDS",
    "Transacted_BABY",
    "trans_other_than_BABY",
    "trans_mens",
    "trans_other_than_mens",
    "trans_curve",
    "trans_other_than_curve",
    "trans_curve_bottoms",
    "trans_petite",
    "trans_AFL",
    "trans_NRL",
    "trans_other_than_AFL_NRL",
    "trans_Kids",
    "trans_other_than_Kids",
    "trans_cobrands",
    "trans_other_than_cobrands",
    "trans_supre",
    "trans_other_than_supre",
    "channel_online",
    "channel_store",
    "AUDSales",
]


def transaction_summary(summary: DataFrame) -> DataFrame:
    """C7: customers with loyalty lines in the C7 window, with their flags and sales."""
    return summary.filter(F.col("n_summary_lines") > 0).select(*TRANSACTION_SUMMARY_COLUMNS)


def kids_summary(summary: DataFrame) -> DataFrame:
    """C8: customers with kids lines in the last 365 days, with clamped kids sales."""
    return summary.filter(F.col("n_kids_lines") > 0).select("customer_id", "kids_AUDSales")


# -- e-mail engagement ---------------------------------------------------------
def sports_campaigns(sendjobs: DataFrame) -> DataFrame:
    """Sends whose upper-cased name contains _AFL or _NRL, with three flags."""
    name = F.upper(F.col("email_name"))
    has = lambda text: rules.flag(rules.contains_text(name, text))
    return sendjobs.select(
        "*",
        has(C.CAMPAIGN_AFL_NRL).alias("afl_nrl"),
        has(C.CAMPAIGN_AFL).alias("afl"),
        has(C.CAMPAIGN_NRL).alias("nrl"),
    ).filter(rules.contains_text(name, C.CAMPAIGN_AFL) | rules.contains_text(name, C.CAMPAIGN_NRL))


def _engaged(events: DataFrame, campaigns: DataFrame, prefix: str) -> DataFrame:
    camp = bounded_broadcast(campaigns.select("send_id", "afl_nrl", "afl", "nrl"))
    return (
        events.select("subscriber_key", "send_id")
        .join(camp, "send_id")
        .groupBy("subscriber_key")
        .agg(
            F.max("afl_nrl").alias(f"{prefix}_afl_nrl"),
            F.max("afl").alias(f"{prefix}_afl"),
            F.max("nrl").alias(f"{prefix}_nrl"),
        )
    )


def opened_flags(opens: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per subscriber: opened an AFL+NRL / AFL / NRL campaign."""
    return _engaged(opens, campaigns, "opened")


def clicked_flags(clicks: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per subscriber: clicked an AFL+NRL / AFL / NRL campaign."""
    return _engaged(clicks, campaigns, "clicked")


def engagement(opens: DataFrame, clicks: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Opened and clicked flags side by side, one row per subscriber.

    Same values as joining :func:`opened_flags` and :func:`clicked_flags`
    to the customer base separately, but the opens and clicks on sports
    campaigns are stacked and reduced in ONE aggregation (map-side partial
    aggregation first), whose output is already partitioned by subscriber.
    """
    camp = bounded_broadcast(campaigns.select("send_id", "afl_nrl", "afl", "nrl"))
    none = F.lit(None).cast("int")

    def stacked(events: DataFrame, opened: bool) -> DataFrame:
        flags = [F.col(c) if opened else none for c in ("afl_nrl", "afl", "nrl")]
        flags += [none if opened else F.col(c) for c in ("afl_nrl", "afl", "nrl")]
        names = ["opened_afl_nrl", "opened_afl", "opened_nrl", "clicked_afl_nrl", "clicked_afl", "clicked_nrl"]
        joined = events.select("subscriber_key", "send_id").join(camp, "send_id")
        return joined.select("subscriber_key", *[f.alias(n) for f, n in zip(flags, names)])

    both = stacked(opens, True).unionByName(stacked(clicks, False))
    names = [c for c in both.columns if c != "subscriber_key"]
    return both.groupBy("subscriber_key").agg(*[F.max(c).alias(c) for c in names])


# -- customer view -----------------------------------------------------------------
def customer_email_keys(crm_customer: DataFrame) -> DataFrame:
    """E-mail join keys of every customer record (``_email_key``).

    Each customer of the view takes its address from this table, so the
    number of records per key here is at least the number in the view: a
    cheap place to find addresses shared by very many customers.
    """
    return crm_customer.filter(F.col("email_address").isNotNull()).select(F.col("email_address").alias("_email_key"))


def scv(
    customers: DataFrame,
    summary: DataFrame,
    engaged: DataFrame,
    max_email_rows: int = DEFAULT_HOT_KEY_ROWS,
    email_keys: DataFrame | None = None,
) -> DataFrame:
    """The customer view: one row per customer, blanks for missing segments.

    ``customers`` is the rank-1 customer base, ``summary`` the output of
    :func:`fact_summary` and ``engaged`` the output of :func:`engagement`.
    ``email_keys`` (:func:`customer_email_keys`) is where shared addresses
    are counted; by default they are counted on ``customers``.
    """
    base = customers.select("customer_id", "email_address", "age")
    with_sales = base.join(summary, "customer_id", "left")
    # NULL e-mails never match; give them unique keys so they spread evenly.
    # An address shared by very many customers is salted over several tasks.
    # Addresses are counted on the customer records (or the customer base):
    # the summary has one row per customer, so the join above keeps the rows
    # per address.
    key = spread_null_key(F.col("email_address"), F.col("customer_id"))
    joined = hot_key_left_join(
        with_sales.withColumn("_email_key", key),
        engaged.withColumnRenamed("subscriber_key", "_email_key"),
        "_email_key",
        spread_by=F.col("customer_id"),
        max_key_rows=max_email_rows,
        counts_of=email_keys if email_keys is not None else customer_email_keys(base),
    )
    col = F.col
    sales = F.coalesce(col("AUDSales"), F.lit(0)).cast("double")
    kids_sales = F.coalesce(col("kids_AUDSales"), F.lit(0)).cast("double")
    segments = {
        "Transacted_KIDS": col("Transacted_KIDS"),
        "Transacted_BABY": rules.pure_multi(col("Transacted_BABY"), col("trans_other_than_BABY")),
        "Transacted_Cat_Menswear": rules.pure_multi(col("trans_mens"), col("trans_other_than_mens")),
        "Transacted_KIDS_flag": rules.pure_multi(col("trans_Kids"), col("trans_other_than_Kids")),
        "Transacted_Cat_Sports": rules.sports_affinity(
            col("trans_AFL"),
            col("trans_NRL"),
            col("clicked_afl_nrl"),
            col("clicked_afl"),
            col("clicked_nrl"),
            col("opened_afl_nrl"),
            col("opened_afl"),
            col("opened_nrl"),
        ),
        "Transacted_Cat_Curve": rules.pure_multi(col("trans_curve"), col("trans_other_than_curve")),
        "Transacted_Cat_CoBrands": rules.pure_multi(col("trans_cobrands"), col("trans_other_than_cobrands")),
        "Transacted_Cat_SUPRE": rules.pure_multi(col("trans_supre"), col("trans_other_than_supre")),
        # The reference compares these two flags with themselves, so they are
        # Multi or NULL, never Pure.
        "Transacted_Cat_Curve_Bottoms": rules.pure_multi(col("trans_curve_bottoms"), col("trans_curve_bottoms")),
        "Transacted_Cat_Petite": rules.pure_multi(col("trans_petite"), col("trans_petite")),
    }
    return joined.select(
        "customer_id",
        "email_address",
        *[F.coalesce(expr, F.lit("")).alias(name) for name, expr in segments.items()],
        rules.lifestage(kids_sales, sales, col("age")).alias("LIFESTAGE"),
    ).select(*SCV_COLUMNS)


# -- extracts ----------------------------------------------------------------------
def segment_extracts(scv_df: DataFrame) -> DataFrame:
    """Long form of the ten segment files: (segment_name, customer_id, Segment).

    One ``unpivot`` (a single Expand over one scan of the view) replaces ten
    filtered copies; blank segments are left out.
    """
    names = {column: base for base, column, _ in C.SEGMENT_ROUTING}
    renamed = scv_df.select("customer_id", *[F.col(c).alias(b) for c, b in names.items()])
    long = renamed.unpivot("customer_id", list(names.values()), "segment_name", "Segment")
    return long.filter(~F.col("Segment").eqNullSafe(F.lit(""))).select("segment_name", "customer_id", "Segment")


def supre_extract(scv_df: DataFrame) -> DataFrame:
    """The SUPRE file carries the e-mail address beside the segment."""
    return scv_df.filter(~F.col("Transacted_Cat_SUPRE").eqNullSafe(F.lit(""))).select(
        "customer_id", F.col("Transacted_Cat_SUPRE").alias("Segment"), "email_address"
    )
