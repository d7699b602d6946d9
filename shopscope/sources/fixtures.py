"""Logical retail inputs derived from the TPC-H-like parquet tables.

The jobs consume loyalty, customer, store, item, sale-fact, calendar, e-mail
and app-event tables (see :mod:`shopscope.sources.schema`).  The test data
ships TPC-H-like tables instead, so this module derives each logical input
from them with plain DataFrame operations.  The same derivation is written
as DuckDB SQL in :mod:`shopscope.checks.oracle_sql`; both follow the
mapping table in ``FIXTURES.md`` section 2.

Every input is built lazily: a job that needs three inputs only reads the
raw tables behind those three, and the planner prunes unused columns.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md section 2).
# ---------------------------------------------------------------------------
CURRENCY_BY_NATION_MOD_8 = ["AUD", "HKD", "MLR", "NZD", "SGD", "USD", "ZAR", "GBP"]
DIVISION_BY_PART_MOD_9 = [
    "1 - COTTONON",
    "2 - KIDS",
    "3 - BODY",
    "4 - RUBI",
    "5 - FACTORIE",
    "10 - SUPRE",
    "11 - COMMUNITY",
    "12 - LOST (DNU)",
    "13 - SUNNY BUDDY (DNU)",
]
CATEGORY_BY_NAME_WORD = [
    ("ring", "165 - CURVE"),
    ("bolt", "101 - BOTTOMS"),
    ("gear", "102 - SKIRTS"),
    ("rod", "103 - DENIM"),
    ("gizmo", "300 - SOLUTIONS"),
    ("plate", "399 - BODY OTHER"),
    ("anvil", "104 - TOPS"),
]
CATEGORY_OTHER = "105 - DRESSES"
SIZE_BY_PART_SIZE_MOD_10 = ["XXS", "XS", "S", "M", "L", "XL+", "6", "8", "14", "16"]
GENDER_BY_SEGMENT = [("BUILDING", "m"), ("MACHINERY", "M"), ("HOUSEHOLD", "f"), ("FURNITURE", "F")]
INSERT_USER_BY_MOD_4 = ["WEB", "RD Script", None, "STAFF"]
CAMPAIGN_PREFIX_BY_MOD_5 = ["W_AFLNRL_", "w_afl_", "W_NRL_", "XAFL_", "PROMO_"]
EVENT_NAME_BY_TYPE = [
    ("error", "appOpen"),
    ("purchase", "ecommerce_purchase"),
    ("view", "session_start"),
    ("signup", "first_open"),
    ("click", "screen_view"),
]
COUNTRY_BY_USER_MOD_6 = ["Australia", "New Zealand", "United States", "Japan", "France", None]
MEMBER_EPOCH = date(1995, 1, 1)
BIRTH_EPOCH = date(1915, 6, 15)
CALENDAR_FIRST = date(1995, 1, 1)
CALENDAR_LAST = date(2024, 12, 31)


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` (0-based) as a column; indexes here are always in range."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(column: Column, pairs: list[tuple[str, str]], default: Column | str | None = None) -> Column:
    expr = None
    for when_value, then_value in pairs:
        expr = (F.when if expr is None else expr.when)(column == F.lit(when_value), F.lit(then_value))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


class FixtureInputs:
    """Logical inputs over one directory of test tables (``sf_dir``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # One relation per table: the file listing and footer read happen once.
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.sf_dir, name)
        return self._raw[name]

    # -- customers -----------------------------------------------------------
    @cached_property
    def _memberships(self) -> DataFrame:
        # Every customer has membership n=0; every third customer also n=1.
        c = self.raw("customer").select("c_custkey", "c_mktsegment")
        n = F.explode(F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        return c.select("c_custkey", "c_mktsegment", n.alias("n"))

    @cached_property
    def loyalty_customer(self) -> DataFrame:
        m = self._memberships
        return m.select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") * 10 + F.col("n")).alias("loyalty_customer_id"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit("LOYALTYAU")).otherwise(F.lit("LOYALTY")).alias("loyalty_code"),
            F.when(F.col("c_custkey") % 11 == 0, F.lit("I")).otherwise(F.lit("A")).alias("status_ind"),
        )

    @cached_property
    def loyalty_member(self) -> DataFrame:
        m = self._memberships
        date_from = F.date_add(F.lit(MEMBER_EPOCH), ((F.col("c_custkey") * 7 + F.col("n") * 400) % 2500).cast("int"))
        return m.select(
            (F.col("c_custkey") * 10 + F.col("n")).alias("loyalty_customer_id"),
            date_from.alias("date_from"),
            F.date_add(date_from, 3650).alias("date_to"),
            _pick(INSERT_USER_BY_MOD_4, F.col("c_custkey") % 4).cast("string").alias("insert_user"),
        )

    @cached_property
    def crm_customer(self) -> DataFrame:
        c = self.raw("customer")
        birth = F.date_add(F.lit(BIRTH_EPOCH), ((F.col("c_custkey") * 37) % 30000).cast("int"))
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("date")).otherwise(birth).alias("birth_date"),
            (F.lit(1000) + F.col("c_custkey") % 9000).cast("string").alias("billing_post_code"),
            _case(F.col("c_mktsegment"), GENDER_BY_SEGMENT).alias("gender"),
            F.lower(F.concat(F.col("c_name"), F.lit("@example.com"))).alias("email_address"),
        )

    @cached_property
    def cust_store(self) -> DataFrame:
        c = self.raw("customer")
        return c.filter(F.col("c_custkey") % 5 != 0).select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("int").alias("store_sign_up")
        )

    @cached_property
    def dim_store(self) -> DataFrame:
        n = self.raw("nation")
        return n.filter(F.col("n_nationkey") < 23).select(
            F.col("n_nationkey").cast("int").alias("store_code"),
            F.when(F.col("n_nationkey") % 2 == 0, F.lit("INSTORE")).otherwise(F.lit("ONLINE")).alias("store_type"),
            F.col("n_name").alias("store_brand"),
            F.col("n_name").alias("store_description"),
        )

    @cached_property
    def location(self) -> DataFrame:
        n = self.raw("nation")
        return n.filter(F.col("n_nationkey") < 20).select(
            F.col("n_nationkey").cast("int").alias("location_code"),
            (F.lit(3000) + F.col("n_nationkey")).cast("string").alias("postcode"),
        )

    # -- items and sales -----------------------------------------------------
    @cached_property
    def dim_item(self) -> DataFrame:
        p = self.raw("part")
        division = _pick(DIVISION_BY_PART_MOD_9, F.col("p_partkey") % 9)
        ptype = F.col("p_type")
        std_promo = ptype.isin("STANDARD", "PROMO")
        department = (
            F.when((division == "1 - COTTONON") & ptype.isin("STANDARD", "PROMO", "ECONOMY"), F.lit("12 - LADIESWEAR"))
            .when(division == "1 - COTTONON", F.lit("11 - MENSWEAR"))
            .when((division == "2 - KIDS") & std_promo, F.lit("21 - BABY"))
            .when(division == "2 - KIDS", F.lit("22 - GIRLS"))
            .when((division == "3 - BODY") & std_promo, F.lit("31 - BODY SLEEPWEAR"))
            .when((division == "3 - BODY") & ptype.isin("ECONOMY", "MEDIUM"), F.lit("32 - BODY INTIMATES"))
            .when(division == "3 - BODY", F.lit("33 - BODY - ACTIVE"))
            .when((division == "5 - FACTORIE") & std_promo, F.lit("51 - GUYS"))
            .when(division == "5 - FACTORIE", F.lit("52 - GIRLS"))
            .otherwise(F.lit("99 - OTHER"))
        )
        first_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
        second_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
        description = (
            F.when(first_word == "hot", F.concat(F.lit("AFL "), F.col("p_name")))
            .when(first_word == "cold", F.concat(F.lit("NRL "), F.col("p_name")))
            .otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")))
        )
        return p.select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_brand").alias("item_colour_code"),
            description.alias("item_description"),
            division.alias("division"),
            department.alias("department"),
            _case(second_word, CATEGORY_BY_NAME_WORD, CATEGORY_OTHER).alias("category"),
            _pick(SIZE_BY_PART_SIZE_MOD_10, F.col("p_size") % 10).alias("size"),
        )

    @cached_property
    def fact_sales(self) -> DataFrame:
        # One row per order line.  online_sale is derived from l_orderkey
        # (equal to o_orderkey through the join) so that channel predicates
        # can be evaluated on the line-item side of the join.
        line = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
        )
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        cust = self.raw("customer").select("c_custkey", "c_nationkey")
        online = (F.col("l_orderkey") % 2).cast("int")
        amount = (
            F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))
        ).cast("decimal(18,4)")
        refund = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return (
            line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_custkey").alias("customer_id"),
                F.col("l_partkey").alias("item_id"),
                F.col("l_orderkey").alias("sale_code"),
                online.alias("online_sale"),
                F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(0)).otherwise(F.lit(1)).alias("loyalty_flag"),
                F.col("l_shipdate").alias("transaction_date_time"),
                F.when(online == 1, F.col("o_orderdate")).alias("ordered_date"),
                _pick(CURRENCY_BY_NATION_MOD_8, F.col("c_nationkey") % 8).alias("store_currency_code"),
                F.when(refund, -amount).otherwise(amount).cast("decimal(18,4)").alias("aud_sales"),
            )
        )

    @cached_property
    def date_dimension(self) -> DataFrame:
        # A fixed calendar: one row per day, 10,958 rows (a proven bound).
        days = F.explode(F.sequence(F.lit(CALENDAR_FIRST), F.lit(CALENDAR_LAST), F.expr("INTERVAL 1 DAY")))
        cal = self.spark.range(1).select(days.alias("d"))
        return cal.select(
            "d",
            F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"),
            (F.year("d") * 100 + F.floor((F.dayofyear("d") - 1) / 7).cast("int") + 1).alias("trade_week_code"),
        )

    # -- e-mail engagement ---------------------------------------------------
    def _events_k(self) -> DataFrame:
        return self.raw("events").select(
            "event_type", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k")
        )

    @cached_property
    def sendjobs(self) -> DataFrame:
        k = self._events_k().select("k").distinct()
        return k.select(
            F.col("k").alias("send_id"),
            F.concat(_pick(CAMPAIGN_PREFIX_BY_MOD_5, F.col("k") % 5), F.col("k").cast("string")).alias("email_name"),
        )

    def _engagement(self, event_type: str, keep: Column | None) -> DataFrame:
        ev = self._events_k().filter(F.col("event_type") == event_type)
        if keep is not None:
            ev = ev.filter(keep)
        cust = self.crm_customer.select("customer_id", "email_address")
        return ev.join(cust, ev.user_id == cust.customer_id).select(
            F.col("email_address").alias("subscriber_key"), F.col("k").alias("send_id")
        )

    @cached_property
    def opens(self) -> DataFrame:
        return self._engagement("view", None)

    @cached_property
    def clicks(self) -> DataFrame:
        return self._engagement("click", F.col("k") % 10 < 3)

    # -- mobile app events -----------------------------------------------------
    @cached_property
    def app_events(self) -> DataFrame:
        return app_events_from_raw(self.raw("events"))


def app_events_from_raw(e: DataFrame) -> DataFrame:
    """Nested app events from raw ``events`` rows (a row-wise projection, so it
    works on a batch or a streaming DataFrame alike)."""
    k = F.get_json_object("props", "$.k").cast("int")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")

    def kv(key: str, string_value: Column, int_value: Column) -> Column:
        value = F.struct(string_value.cast("string").alias("string_value"), int_value.cast("bigint").alias("int_value"))
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    params = F.array(
        kv("source", F.when(k % 2 == 0, F.lit("Push")).otherwise(F.lit("Organic")), F.lit(None)),
        kv("engagement", F.lit(None), F.lit(1)),
    )
    props = F.array(
        kv("ga_session_id", F.lit(None), F.col("user_id") * 100 + F.dayofmonth("ts")),
        kv("first_open_time", F.lit(None), micros),
    )
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        micros.alias("event_timestamp"),
        _case(F.col("event_type"), EVENT_NAME_BY_TYPE).alias("event_name"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        F.struct(_pick(COUNTRY_BY_USER_MOD_6, F.col("user_id") % 6).cast("string").alias("country")).alias("geo"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,2)")).alias("event_value_in_usd"),
        params.alias("event_params"),
        props.alias("user_properties"),
    )
