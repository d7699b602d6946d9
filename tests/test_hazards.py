
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from shopscope.operators import age_profile as AP
from shopscope.operators import mobile as M
from shopscope.operators import segments as S
from shopscope.sources import schema as SC

AS_OF = datetime(2001, 6, 30, 10, 46)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SC.LOGICAL_SCHEMAS[name])


def item(item_id, division="1 - COTTONON", department="12 - LADIESWEAR", category="104 - TOPS", size="M", desc="plain"):
    return (item_id, "Brand#1", desc, division, department, category, size)


def sale(cust, item_id, tx, amount, online=0, ordered=None, loyalty=1, currency="AUD", code=1):
    return (cust, item_id, code, online, loyalty, tx, ordered, currency, Decimal(str(amount)))


# -- events helpers -----------------------------------------------------------------
def event(name, user, ts_us, day="20240101", country="Australia", push=False, session=7, value=None):
    params = [("source", ("Push" if push else "Organic", None))]
    props = [("ga_session_id", (None, session)), ("first_open_time", (None, ts_us))]
    v = None if value is None else Decimal(str(value))
    return (day, ts_us, name, user, (country,), v, params, props)


def test_session_fan_out_is_counted_like_the_join(spark):
    # 2 push opens x 2 purchases in one session: 4 joined rows, sales doubled.
    ev = frame(
        spark,
        "app_events",
        [
            event("appOpen", "u1", 1, push=True),
            event("appOpen", "u1", 2, push=True),
            event("ecommerce_purchase", "u1", 3, value=10),
            event("ecommerce_purchase", "u1", 4, value=5),
            event("appOpen", "u2", 5, push=True, session=9),  # no purchase: 1 row, no sales
        ],
    )
    out = M.push_revenue(M.push_sessions(ev), M.ecomm_purchases(ev)).collect()
    assert len(out) == 1
    row = out[0]
    assert row.push_sessions == 4 + 1
    assert row.distinct_push_user == 2
    assert row.push_sales_usd == Decimal("30.00")


def test_push_filter_uses_value_not_key(spark):
    ev = frame(spark, "app_events", [event("appOpen", "u1", 1, push=False), event("screen_view", "u1", 2, push=True)])
    assert M.push_sessions(ev).count() == 0


def test_running_total_is_zero_on_days_without_first_opens(spark):
    dd = spark.createDataFrame(
        [(date(2024, 1, d), 20240100 + d, 202401) for d in (1, 2, 3)], SC.LOGICAL_SCHEMAS["date_dimension"]
    )
    ev = frame(
        spark,
        "app_events",
        [
            event("first_open", "u1", 1, day="20240101"),
            event("session_start", "u1", 2, day="20240101"),
            event("session_start", "u1", 3, day="20240102"),  # sessions, no first open
            event("first_open", "u2", 4, day="20240103"),  # first open, no session: not reported
            event("first_open", "u3", 5, day="20240103"),
            event("session_start", "u9", 6, day="20240101", country=None),
            event("first_open", "u9", 7, day="20240101", country=None),
        ],
    )
    rows = {(r.event_date.day, r.country): r for r in M.mobile_report(ev, dd).collect()}
    assert set(rows) == {(1, "Australia"), (2, "Australia"), (1, None)}
    assert (rows[(1, "Australia")].first_opens, rows[(1, "Australia")].cumulative_opens) == (1, 1)
    assert (rows[(2, "Australia")].first_opens, rows[(2, "Australia")].cumulative_opens) == (0, 0)
    # NULL country never joins: its metrics are 0 and its join key is NULL
    null_row = rows[(1, None)]
    assert (null_row.sessions, null_row.first_opens, null_row.joinKey) == (1, 0, None)
    fo = {(r.event_date.day, r.country): r.cumulative_opens for r in M.first_opens(M.daily_counts(ev)).collect()}
    assert fo[(3, "Australia")] == 3


def test_scv_window_edges(spark):
    items = frame(spark, "dim_item", [item(1)])
    day = lambda n: datetime(2001, 6, 30) - timedelta(days=n)
    facts = frame(
        spark,
        "fact_sales",
        [
            sale(1, 1, day(365), 5),  # store, exactly 365 days back: excluded
            sale(2, 1, day(364), 7),  # store, 364 days back: included
            sale(3, 1, day(0), 11, online=1, ordered=day(1)),  # online, 1 day back: excluded
            sale(4, 1, day(9), 13, online=1, ordered=day(0)),  # online, ordered on the run date: included
            sale(5, 1, day(1), 17, loyalty=0),  # not a loyalty sale
        ],
    )
    got = {r.customer_id: r.AUDSales for r in S.transaction_summary(S.fact_summary(facts, items, AS_OF)).collect()}
    assert got == {2: Decimal("7.0000"), 4: Decimal("13.0000")}


def test_negative_lines_clamped_in_scv_not_in_profile(spark):
    items = frame(spark, "dim_item", [item(1, division="2 - KIDS", department="21 - BABY")])
    t = datetime(2001, 6, 25, 12)
    facts = frame(spark, "fact_sales", [sale(1, 1, t, 10), sale(1, 1, t, -4)])
    summary = S.fact_summary(facts, items, AS_OF).collect()[0]
    assert summary.AUDSales == Decimal("10.0000") and summary.kids_AUDSales == Decimal("10.0000")
    profile = AP.age_profile_sales(facts, items, AS_OF).collect()[0]
    assert profile.aud_sales == Decimal("6.0000")


def test_kids_recency_is_a_text_maximum(spark):
    items = frame(spark, "dim_item", [item(1, division="2 - KIDS")])
    facts = frame(
        spark, "fact_sales", [sale(1, 1, datetime(2000, 12, 2, 9), 1), sale(1, 1, datetime(2001, 1, 31, 9), 1)]
    )
    row = S.fact_summary(facts, items, AS_OF).collect()[0]
    assert row.Transacted_KIDS == "31/01/2001"
    facts2 = frame(
        spark, "fact_sales", [sale(1, 1, datetime(2001, 1, 2, 9), 1), sale(1, 1, datetime(2000, 12, 31, 9), 1)]
    )
    assert S.fact_summary(facts2, items, AS_OF).collect()[0].Transacted_KIDS == "31/12/2000"


def test_campaign_names_are_literal_substrings(spark):
    jobs = frame(spark, "sendjobs", [(1, "W_AFLNRL_1"), (2, "w_afl_1"), (3, "W_NRL_1"), (4, "XAFL_1"), (5, "PROMO_1")])
    got = {r.send_id: (r.afl_nrl, r.afl, r.nrl) for r in S.sports_campaigns(jobs).collect()}
    assert got == {1: (1, 1, 0), 2: (0, 1, 0), 3: (0, 0, 1)}


def test_engagement_equals_two_left_joins(spark):
    jobs = frame(spark, "sendjobs", [(1, "W_AFLNRL_1"), (2, "w_afl_1"), (3, "W_NRL_1"), (4, "PROMO_1")])
    camp = S.sports_campaigns(jobs)
    opens = frame(spark, "opens", [("a@x", 1), ("a@x", 4), ("b@x", 2), ("c@x", 4), (None, 3)])
    clicks = frame(spark, "clicks", [("b@x", 3), ("d@x", 2)])
    eng = {r.subscriber_key: tuple(r)[1:] for r in S.engagement(opens, clicks, camp).collect()}
    opened = {r.subscriber_key: tuple(r)[1:] for r in S.opened_flags(opens, camp).collect()}
    clicked = {r.subscriber_key: tuple(r)[1:] for r in S.clicked_flags(clicks, camp).collect()}
    for key in set(opened) | set(clicked):
        assert eng[key] == opened.get(key, (None,) * 3) + clicked.get(key, (None,) * 3)
    assert set(eng) == set(opened) | set(clicked)


def test_scv_null_emails_do_not_match_and_keep_their_rows(spark):
    customers = spark.createDataFrame(
        [(1, "a@x", 30), (2, None, 9999), (3, None, 20)], "customer_id long, email_address string, age int"
    )
    summary = S.fact_summary(frame(spark, "fact_sales", []), frame(spark, "dim_item", [item(1)]), AS_OF)
    jobs = frame(spark, "sendjobs", [(1, "W_AFLNRL_1")])
    opens = frame(spark, "opens", [("a@x", 1), (None, 1)])
    engaged = S.engagement(opens, frame(spark, "clicks", []), S.sports_campaigns(jobs))
    got = {r.customer_id: (r.Transacted_Cat_Sports, r.LIFESTAGE) for r in S.scv(customers, summary, engaged).collect()}
    assert got == {1: ("Multi_em_o", "GENERIC"), 2: ("", "GENERIC"), 3: ("", "EDIT")}


def test_profile_group_by_drops_null_keys_and_zero_fills(spark):
    perks = spark.createDataFrame(
        [(1, "Edit (19-24)"), (2, "Missing"), (None, "Edit (19-24)")], "customer_id long, age_segment string"
    )
    sales = spark.createDataFrame(
        [
            (1, "AUD", "Store", date(2001, 6, 25), "d", "p", "c", Decimal("5")),
            (1, "AUD", None, date(2001, 6, 25), "d", "p", "c", Decimal("9")),  # NULL key: dropped
            (2, "AUD", "Store", date(2001, 6, 25), "d", "p", "c", None),  # all-NULL sum: 0
            (None, "AUD", "Store", date(2001, 6, 25), "d", "p", "c", Decimal("1")),  # NULL customers pair in the merge
        ],
        "customer_id long, store_currency_code string, channel string, trans_order_date date, division string,"
        " department string, category string, aud_sales decimal(18,4)",
    )
    got = {r.age_segment: r.aud_sales for r in AP.age_profile(perks, sales).collect()}
    assert got == {"Edit (19-24)": 6.0, "Missing": 0.0}


def test_item_profile_merges_comma_variants_and_drops_missing(spark):
    items = frame(
        spark, "dim_item", [item(1, desc="red, bolt"), item(2, desc="red- bolt"), item(3, desc="other")]
    )
    t = datetime(2001, 6, 25, 12)
    facts = frame(spark, "fact_sales", [sale(1, 1, t, 2), sale(1, 2, t, 3), sale(2, 3, t, 4), sale(1, 1, t, 1, currency="GBP")])
    dd = spark.createDataFrame([(date(2001, 6, 25), 20010625, 200126)], SC.LOGICAL_SCHEMAS["date_dimension"])
    perks = spark.createDataFrame([(1, "Edit (19-24)"), (2, "Missing")], "customer_id long, age_segment string")
    sales = AP.age_profile_item_sales(facts, items, dd, AS_OF)
    assert {r.item: r.aud_sales for r in sales.collect()} == {"red- bolt": Decimal("5.0000"), "other": Decimal("4.0000")}
    out = AP.age_profile_item(perks, sales).collect()
    assert [(r.item, r.age_segment, r.aud_sales) for r in out] == [("red- bolt", "Edit (19-24)", 5.0)]


def test_kids_share_can_exceed_one(spark):
    # Kids sales cover 365 days of both channels, total sales only 1 day online.
    items = frame(spark, "dim_item", [item(1, division="2 - KIDS")])
    facts = frame(
        spark,
        "fact_sales",
        [sale(1, 1, datetime(2001, 3, 1, 9), 50, online=1, ordered=datetime(2001, 3, 1)),
         sale(1, 1, datetime(2001, 6, 30, 9), 10, online=1, ordered=datetime(2001, 6, 30))],
    )
    row = S.fact_summary(facts, items, AS_OF).collect()[0]
    assert row.kids_AUDSales / row.AUDSales == 6


def test_plus_bottoms_patterns(spark):
    items = frame(
        spark,
        "dim_item",
        [
            item(1, category="101 - BOTTOMS", size="XXL"),
            item(2, category="101 - BOTTOMS", size="14"),
            item(3, category="101 - BOTTOMS", size="M"),
            item(4, category="104 - TOPS", size="XL"),
            item(5, division="2 - KIDS", category="101 - BOTTOMS", size="XL"),
        ],
    )
    assert sorted(r.item_id for r in S.plus_bottoms(items).collect()) == [1, 2]
    flags = {r.item_id: int(r.is_plus_bottoms) for r in S.item_rules(items).collect()}
    assert flags == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


def test_null_item_attributes_count_as_other(spark):
    # CASE on NULL goes to ELSE: a NULL category is "other than curve", never curve.
    items = frame(spark, "dim_item", [(1, None, None, None, None, None, None), item(2, category="165 - CURVE")])
    t = datetime(2001, 6, 25, 12)
    facts = frame(spark, "fact_sales", [sale(1, 1, t, 1), sale(2, 2, t, 1), sale(3, 1, t, 1), sale(3, 2, t, 1)])
    got = {
        r.customer_id: (r.trans_curve, r.trans_other_than_curve, r.trans_other_than_BABY, r.channel_store)
        for r in S.transaction_summary(S.fact_summary(facts, items, AS_OF)).collect()
    }
    assert got == {1: (0, 1, 1, 1), 2: (1, 0, 1, 1), 3: (1, 1, 1, 1)}


def test_push_rows_without_session_count_once_and_match_nothing(spark):
    ev = frame(
        spark,
        "app_events",
        [
            event("appOpen", "u1", 1, push=True, session=None),
            event("appOpen", "u1", 2, push=True, session=None),
            event("ecommerce_purchase", "u1", 3, value=10, session=None),
            event("appOpen", "u2", 4, push=True),
            event("ecommerce_purchase", "u2", 5, value=4),
        ],
    )
    row = M.push_revenue(M.push_sessions(ev), M.ecomm_purchases(ev)).collect()[0]
    assert (row.push_sessions, row.distinct_push_user, row.push_sales_usd) == (3, 2, Decimal("4.00"))


def test_report_range_keeps_purchases_of_sessions_crossing_midnight(spark):
    dd = spark.createDataFrame(
        [(date(2024, 1, d), 20240100 + d, 202401) for d in (3, 4)], SC.LOGICAL_SCHEMAS["date_dimension"]
    )
    ev = frame(
        spark,
        "app_events",
        [
            event("session_start", "u1", 1, day="20240103"),
            event("appOpen", "u1", 2, day="20240103", push=True, session=7),
            event("ecommerce_purchase", "u1", 3, day="20240104", value=10, session=7),  # same session, next day
        ],
    )
    full = {r.event_date.day: r.push_sales_usd for r in M.mobile_report(ev, dd).collect()}
    ranged = M.mobile_report(ev, dd, first_day=date(2024, 1, 3), last_day=date(2024, 1, 3)).collect()
    assert full[3] == Decimal("10.00")
    assert [(r.event_date.day, r.push_sales_usd) for r in ranged] == [(3, Decimal("10.00"))]


def test_hot_keys_keep_whole_results(spark):
    # One e-mail shared by a third of the customers, one customer with a third of the sale lines.
    n = 90
    emails = ["hot@x" if i % 3 == 0 else f"c{i}@x" for i in range(n)]
    customers = spark.createDataFrame(
        [(i, emails[i], 30) for i in range(n)], "customer_id long, email_address string, age int"
    )
    items = frame(spark, "dim_item", [item(1, division="11 - COMMUNITY", desc="AFL jersey"), item(2)])
    t = datetime(2001, 6, 25, 12)
    lines = [sale(0, 2, t, 1) for _ in range(n)] + [sale(i, 1 + i % 2, t, 2) for i in range(1, n)]
    facts = frame(spark, "fact_sales", lines)
    summary = S.fact_summary(facts, items, AS_OF)
    jobs_ = frame(spark, "sendjobs", [(1, "W_NRL_1")])
    opens = frame(spark, "opens", [("hot@x", 1)] * 50)
    engaged = S.engagement(opens, frame(spark, "clicks", []), S.sports_campaigns(jobs_))
    view = {r.customer_id: r for r in S.scv(customers, summary, engaged).collect()}
    assert len(view) == n
    hot = [view[i] for i in range(n) if emails[i] == "hot@x"]
    assert len(hot) == n // 3
    # every hot-address customer without an AFL purchase gets the e-mail segment
    assert all(r.Transacted_Cat_Sports in ("NRL_em_o", "AFL") for r in hot)
    # customer 0 and odd ids bought only the plain item; even ids (>0) bought the AFL item
    assert sum(r.Transacted_Cat_Sports == "NRL_em_o" for r in hot) == sum(1 for i in range(0, n, 3) if i == 0 or i % 2 == 1)
    heavy = S.transaction_summary(summary).filter("customer_id = 0").first()
    assert heavy.AUDSales == Decimal("90.0000")
