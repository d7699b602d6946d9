"""Oracle SQL (DuckDB dialect) for every registered query.

Each query is one statement over the raw views ``region nation customer
supplier part orders lineitem events ...``.  It first derives the logical
inputs with the fixture mapping (``FIXTURES.md`` section 2) and then
computes the report in plain, direct SQL written independently of the Spark
plans: per-line boolean rules aggregated with ``bool_or``, two separate fact
passes for the customer view, two left joins for opens and clicks, the
many-to-many push join materialised, one event scan per mobile metric, and
date windows written as "midnight of the date >= run time minus n days".
Agreement with the Spark plans, which are restructured for scale (bit masks,
one fact pass, pre-aggregated push join, one daily aggregate), is therefore a
real check.

Output types follow :func:`shopscope.plans.queries.present`: integers are
BIGINT and money is DOUBLE.
"""

from __future__ import annotations

from .. import config as C

TS = f"TIMESTAMP '{C.FIXTURE_AS_OF:%Y-%m-%d %H:%M:%S}'"


# ---------------------------------------------------------------------------
# Fixture mapping (logical inputs from the raw tables).
# ---------------------------------------------------------------------------
_MAPPING: dict[str, tuple[list[str], str]] = {
    "fact_sales": (
        [],
        """
    SELECT o.o_custkey AS customer_id, l.l_partkey AS item_id, l.l_orderkey AS sale_code,
           CAST(o.o_orderkey % 2 AS INTEGER) AS online_sale,
           CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 1 END AS loyalty_flag,
           l.l_shipdate AS transaction_date_time,
           CASE WHEN o.o_orderkey % 2 = 1 THEN o.o_orderdate END AS ordered_date,
           (['AUD', 'HKD', 'MLR', 'NZD', 'SGD', 'USD', 'ZAR', 'GBP'])[c.c_nationkey % 8 + 1] AS store_currency_code,
           CAST((CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN -1 ELSE 1 END)
                * CAST(l.l_extendedprice AS DECIMAL(18,2))
                * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS aud_sales
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey""",
    ),
    "dim_item": (
        [],
        """
    SELECT p_partkey AS item_id, p_brand AS item_colour_code,
           CASE WHEN split_part(p_name, ' ', 1) = 'hot' THEN 'AFL ' || p_name
                WHEN split_part(p_name, ' ', 1) = 'cold' THEN 'NRL ' || p_name
                ELSE replace(p_name, ' ', ', ') END AS item_description,
           division,
           CASE WHEN division = '1 - COTTONON' AND p_type IN ('STANDARD', 'PROMO', 'ECONOMY') THEN '12 - LADIESWEAR'
                WHEN division = '1 - COTTONON' THEN '11 - MENSWEAR'
                WHEN division = '2 - KIDS' AND p_type IN ('STANDARD', 'PROMO') THEN '21 - BABY'
                WHEN division = '2 - KIDS' THEN '22 - GIRLS'
                WHEN division = '3 - BODY' AND p_type IN ('STANDARD', 'PROMO') THEN '31 - BODY SLEEPWEAR'
                WHEN division = '3 - BODY' AND p_type IN ('ECONOMY', 'MEDIUM') THEN '32 - BODY INTIMATES'
                WHEN division = '3 - BODY' THEN '33 - BODY - ACTIVE'
                WHEN division = '5 - FACTORIE' AND p_type IN ('STANDARD', 'PROMO') THEN '51 - GUYS'
                WHEN division = '5 - FACTORIE' THEN '52 - GIRLS'
                ELSE '99 - OTHER' END AS department,
           CASE split_part(p_name, ' ', 2)
                WHEN 'ring' THEN '165 - CURVE' WHEN 'bolt' THEN '101 - BOTTOMS' WHEN 'gear' THEN '102 - SKIRTS'
                WHEN 'rod' THEN '103 - DENIM' WHEN 'gizmo' THEN '300 - SOLUTIONS' WHEN 'plate' THEN '399 - BODY OTHER'
                WHEN 'anvil' THEN '104 - TOPS' ELSE '105 - DRESSES' END AS category,
           (['XXS', 'XS', 'S', 'M', 'L', 'XL+', '6', '8', '14', '16'])[p_size % 10 + 1] AS size
    FROM (SELECT *, (['1 - COTTONON', '2 - KIDS', '3 - BODY', '4 - RUBI', '5 - FACTORIE', '10 - SUPRE',
                      '11 - COMMUNITY', '12 - LOST (DNU)', '13 - SUNNY BUDDY (DNU)'])[p_partkey % 9 + 1] AS division
          FROM part) p""",
    ),
    "memberships": (
        [],
        """
    SELECT c_custkey, c_mktsegment, 0 AS n FROM customer
    UNION ALL
    SELECT c_custkey, c_mktsegment, 1 AS n FROM customer WHERE c_custkey % 3 = 0""",
    ),
    "loyalty_customer": (
        ["memberships"],
        """
    SELECT c_custkey AS customer_id, c_custkey * 10 + n AS loyalty_customer_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'LOYALTYAU' ELSE 'LOYALTY' END AS loyalty_code,
           CASE WHEN c_custkey % 11 = 0 THEN 'I' ELSE 'A' END AS status_ind
    FROM memberships""",
    ),
    "loyalty_member": (
        ["memberships"],
        """
    SELECT c_custkey * 10 + n AS loyalty_customer_id,
           DATE '1995-01-01' + CAST((c_custkey * 7 + n * 400) % 2500 AS INTEGER) AS date_from,
           DATE '1995-01-01' + CAST((c_custkey * 7 + n * 400) % 2500 AS INTEGER) + 3650 AS date_to,
           (['WEB', 'RD Script', NULL, 'STAFF'])[c_custkey % 4 + 1] AS insert_user
    FROM memberships""",
    ),
    "crm_customer": (
        [],
        """
    SELECT c_custkey AS customer_id,
           CASE WHEN c_custkey % 13 = 0 THEN NULL
                ELSE DATE '1915-06-15' + CAST((c_custkey * 37) % 30000 AS INTEGER) END AS birth_date,
           CAST(1000 + c_custkey % 9000 AS VARCHAR) AS billing_post_code,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'm' WHEN 'MACHINERY' THEN 'M'
                             WHEN 'HOUSEHOLD' THEN 'f' WHEN 'FURNITURE' THEN 'F' END AS gender,
           lower(c_name || '@example.com') AS email_address
    FROM customer""",
    ),
    "cust_store": (
        [],
        """
    SELECT c_custkey AS customer_id, CAST(c_nationkey AS INTEGER) AS store_sign_up
    FROM customer WHERE c_custkey % 5 <> 0""",
    ),
    "dim_store": (
        [],
        """
    SELECT CAST(n_nationkey AS INTEGER) AS store_code,
           CASE WHEN n_nationkey % 2 = 0 THEN 'INSTORE' ELSE 'ONLINE' END AS store_type,
           n_name AS store_brand, n_name AS store_description
    FROM nation WHERE n_nationkey < 23""",
    ),
    "location": (
        [],
        """
    SELECT CAST(n_nationkey AS INTEGER) AS location_code, CAST(3000 + n_nationkey AS VARCHAR) AS postcode
    FROM nation WHERE n_nationkey < 20""",
    ),
    "date_dimension": (
        [],
        """
    SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(year(d) * 100 + floor((dayofyear(d) - 1) / 7) + 1 AS INTEGER) AS trade_week_code
    FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS d) cal""",
    ),
    "events_k": (
        [],
        """
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    ),
    "sendjobs": (
        ["events_k"],
        """
    SELECT k AS send_id,
           (['W_AFLNRL_', 'w_afl_', 'W_NRL_', 'XAFL_', 'PROMO_'])[k % 5 + 1] || CAST(k AS VARCHAR) AS email_name
    FROM (SELECT DISTINCT k FROM events_k) ks""",
    ),
    "opens": (
        ["events_k", "crm_customer"],
        """
    SELECT c.email_address AS subscriber_key, e.k AS send_id
    FROM events_k e JOIN crm_customer c ON e.user_id = c.customer_id
    WHERE e.event_type = 'view'""",
    ),
    "clicks": (
        ["events_k", "crm_customer"],
        """
    SELECT c.email_address AS subscriber_key, e.k AS send_id
    FROM events_k e JOIN crm_customer c ON e.user_id = c.customer_id
    WHERE e.event_type = 'click' AND e.k % 10 < 3""",
    ),
    "app_events": (
        ["events_k"],
        """
    SELECT strftime(ts, '%Y%m%d') AS event_date,
           epoch_us(ts) AS event_timestamp,
           CASE event_type WHEN 'error' THEN 'appOpen' WHEN 'purchase' THEN 'ecommerce_purchase'
                           WHEN 'view' THEN 'session_start' WHEN 'signup' THEN 'first_open'
                           WHEN 'click' THEN 'screen_view' END AS event_name,
           CAST(user_id AS VARCHAR) AS user_pseudo_id,
           {'country': (['Australia', 'New Zealand', 'United States', 'Japan', 'France', NULL])[user_id % 6 + 1]} AS geo,
           CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS event_value_in_usd,
           [{'key': 'source', 'value': {'string_value': CASE WHEN k % 2 = 0 THEN 'Push' ELSE 'Organic' END,
                                        'int_value': CAST(NULL AS BIGINT)}},
            {'key': 'engagement', 'value': {'string_value': CAST(NULL AS VARCHAR), 'int_value': CAST(1 AS BIGINT)}}]
             AS event_params,
           [{'key': 'ga_session_id', 'value': {'string_value': CAST(NULL AS VARCHAR),
                                               'int_value': CAST(user_id * 100 + day(ts) AS BIGINT)}},
            {'key': 'first_open_time', 'value': {'string_value': CAST(NULL AS VARCHAR), 'int_value': epoch_us(ts)}}]
             AS user_properties
    FROM events_k""",
    ),
}

# ---------------------------------------------------------------------------
# Report logic in plain SQL, written independently of the Spark plans.
# ---------------------------------------------------------------------------
def _since(col: str, days: int) -> str:
    # The date of ``col`` is taken at midnight and compared with the run time minus n days.
    return f"CAST(CAST({col} AS DATE) AS TIMESTAMP) >= {TS} - INTERVAL {days} DAY"


def _band(rules, otherwise: str) -> str:
    arms = " ".join(f"WHEN yrs {op} {bound} THEN '{label}'" for op, bound, label in rules)
    return f"CASE WHEN birth_date IS NULL THEN 'Missing' {arms} ELSE '{otherwise}' END"


def _pure_multi(flag: str, other: str) -> str:
    return f"CASE WHEN {flag} = 1 THEN CASE coalesce({other}, 0) WHEN 0 THEN 'Pure' WHEN 1 THEN 'Multi' END END"


def _clamped(col: str) -> str:
    return f"CASE WHEN {col} >= 0 THEN {col} WHEN {col} < 0 THEN 0 END"


_PROFILE_DAYS = f"BETWEEN CAST({TS} - INTERVAL 10 DAY AS DATE) AND CAST({TS} - INTERVAL 1 DAY AS DATE)"
_POSTCODE = "CASE WHEN store_type = 'INSTORE' THEN postcode ELSE billing_post_code END"
_SPORT_TEXT = "(contains(i.item_description, 'AFL ') OR contains(i.item_description, 'NRL '))"

_SUMMARY_FLAGS = [
    # (output column, aggregate over the window's lines)
    ("Transacted_BABY", "bool_or(is_baby)"),
    ("trans_other_than_BABY", "bool_or(NOT is_baby)"),
    ("trans_mens", "bool_or(is_mens)"),
    ("trans_other_than_mens", "bool_or(NOT is_mens)"),
    ("trans_curve", "bool_or(is_curve)"),
    ("trans_other_than_curve", "bool_or(NOT is_curve)"),
    ("trans_curve_bottoms", "bool_or(is_plus)"),
    ("trans_petite", "bool_or(is_petite)"),
    ("trans_AFL", "bool_or(is_afl)"),
    ("trans_NRL", "bool_or(is_nrl)"),
    ("trans_other_than_AFL_NRL", "bool_or(NOT is_sport)"),
    ("trans_Kids", "bool_or(is_kids)"),
    ("trans_other_than_Kids", "bool_or(NOT is_kids)"),
    ("trans_cobrands", "bool_or(is_cobrand)"),
    ("trans_other_than_cobrands", "bool_or(NOT is_cobrand)"),
    ("trans_supre", "bool_or(is_supre)"),
    ("trans_other_than_supre", "bool_or(NOT is_supre)"),
    ("channel_online", "bool_or(coalesce(online_sale = 1, FALSE))"),
    ("channel_store", "bool_or(coalesce(online_sale = 0, FALSE))"),
]
_FLAG_COLUMNS = [name for name, _ in _SUMMARY_FLAGS]

_MEMBER_INPUTS = ["loyalty_customer", "loyalty_member", "crm_customer", "cust_store", "dim_store", "location"]

_QUERY_CTES: dict[str, tuple[list[str], str]] = {
    # -- customers -------------------------------------------------------------------
    "membership_facts": (
        _MEMBER_INPUTS,
        f"""
    SELECT a.customer_id, a.loyalty_customer_id, a.loyalty_code, s.date_from_f, s.date_to_f, s.insert_user,
           c.birth_date, c.billing_post_code, c.gender, c.email_address, cs.store_sign_up, ds.store_type, loc.postcode,
           year({TS}) - year(c.birth_date) AS yrs,
           row_number() OVER (PARTITION BY a.customer_id
                              ORDER BY s.date_from_f NULLS FIRST, a.loyalty_customer_id NULLS FIRST,
                                       a.loyalty_code NULLS FIRST, s.insert_user NULLS FIRST, s.date_to_f NULLS FIRST) AS uq_cust_rank
    FROM (SELECT DISTINCT customer_id, loyalty_customer_id, loyalty_code
          FROM loyalty_customer WHERE status_ind = 'A') a
    JOIN (SELECT loyalty_customer_id, CAST(date_from AS DATE) AS date_from_f, CAST(date_to AS DATE) AS date_to_f,
                 CASE WHEN insert_user IS NULL OR insert_user IN ('WEB', 'RD Script') THEN insert_user
                      ELSE 'OTHER' END AS insert_user
          FROM loyalty_member
          WHERE CAST(CAST(date_from AS DATE) AS TIMESTAMP) <= {TS}) s ON s.loyalty_customer_id = a.loyalty_customer_id
    LEFT JOIN crm_customer c ON c.customer_id = a.customer_id
    LEFT JOIN cust_store cs ON cs.customer_id = a.customer_id
    LEFT JOIN dim_store ds ON ds.store_code = cs.store_sign_up
    LEFT JOIN location loc ON loc.location_code = ds.store_code""",
    ),
    "scv_members": (
        ["membership_facts"],
        f"""
    SELECT customer_id, date_from_f, date_to_f, insert_user, loyalty_code, gender, email_address,
           {_band(C.AGE_BAND_SCV, C.AGE_BAND_SCV_ELSE)} AS age_band,
           {_band(C.AGE_SEGMENT, C.AGE_SEGMENT_ELSE)} AS age_segment,
           coalesce(yrs, 9999) AS age, store_type AS signup_storetype, store_sign_up,
           {_POSTCODE} AS cust_postcode, uq_cust_rank
    FROM membership_facts""",
    ),
    "snapshot": (
        ["membership_facts"],
        f"""
    SELECT customer_id, date_from_f, date_to_f, insert_user, loyalty_code,
           CASE WHEN gender IN ('m', 'M') THEN 'M' WHEN gender IN ('f', 'F') THEN 'F' ELSE 'Missing' END AS gender,
           email_address,
           {_band(C.AGE_BAND_PERKS, C.AGE_BAND_PERKS_ELSE)} AS age_band,
           {_band(C.AGE_SEGMENT, C.AGE_SEGMENT_ELSE)} AS age_segment,
           yrs AS age, store_type AS signup_storetype, store_sign_up, {_POSTCODE} AS cust_postcode, uq_cust_rank
    FROM membership_facts
    WHERE uq_cust_rank = 1""",
    ),
    # -- purchases ---------------------------------------------------------------------
    "plus_size_bottoms": (
        ["dim_item"],
        """
    SELECT DISTINCT division, department, category, item_id, item_colour_code AS prod_id, size,
           1 AS bottoms_14plus, 'bottoms' AS tops_bottoms
    FROM dim_item
    WHERE division IN ('1 - COTTONON', '3 - BODY')
      AND department IN ('12 - LADIESWEAR', '31 - BODY SLEEPWEAR', '32 - BODY INTIMATES', '33 - BODY - ACTIVE')
      AND (contains(lower(category), 'bottoms') OR contains(lower(category), 'skirts')
           OR contains(lower(category), 'pants') OR contains(lower(category), 'denim')
           OR contains(lower(category), 'shorts'))
      AND (size LIKE '%L%' OR size IN ('14', '16'))""",
    ),
    "summary_lines": (
        ["fact_sales", "dim_item", "plus_size_bottoms"],
        f"""
    SELECT f.customer_id, f.online_sale, f.transaction_date_time, f.aud_sales, i.division,
           coalesce(i.department = '21 - BABY', FALSE) AS is_baby,
           coalesce(i.division IN ('1 - COTTONON', '5 - FACTORIE')
                    AND (contains(i.department, 'BOY') OR contains(i.department, 'MENS')
                         OR contains(i.department, 'GUY')), FALSE) AS is_mens,
           coalesce(i.category = '165 - CURVE', FALSE) AS is_curve,
           coalesce(f.item_id IN (SELECT item_id FROM plus_size_bottoms), FALSE) AS is_plus,
           coalesce((i.department = '12 - LADIESWEAR' AND i.category <> '165 - CURVE')
                    OR (i.division = '3 - BODY' AND i.category NOT IN ('300 - SOLUTIONS', '399 - BODY OTHER')
                        AND i.size IN ('XXS', 'XS', '6', '8')), FALSE) AS is_petite,
           coalesce(contains(i.item_description, 'AFL ') AND i.division = '11 - COMMUNITY', FALSE) AS is_afl,
           coalesce(contains(i.item_description, 'NRL ') AND i.division = '11 - COMMUNITY', FALSE) AS is_nrl,
           coalesce({_SPORT_TEXT} AND i.division = '11 - COMMUNITY', FALSE) AS is_sport,
           coalesce(i.division IN ('2 - KIDS', '13 - SUNNY BUDDY (DNU)'), FALSE) AS is_kids,
           coalesce(i.division IN ('1 - COTTONON', '3 - BODY', '4 - RUBI', '12 - LOST (DNU)'), FALSE) AS is_cobrand,
           coalesce(i.division = '10 - SUPRE', FALSE) AS is_supre
    FROM fact_sales f JOIN dim_item i ON i.item_id = f.item_id
    WHERE f.loyalty_flag = 1
      AND ((f.online_sale = 1 AND {_since('f.ordered_date', 1)})
           OR (f.online_sale = 0 AND {_since('f.transaction_date_time', 365)}))""",
    ),
    "purchase_summary": (
        ["summary_lines"],
        "\n    SELECT customer_id,\n"
        "           max(CASE WHEN division = '2 - KIDS' THEN strftime(transaction_date_time, '%d/%m/%Y') END)"
        " AS Transacted_KIDS,\n"
        + "".join(f"           CAST({agg} AS INTEGER) AS {name},\n" for name, agg in _SUMMARY_FLAGS)
        + f"           sum({_clamped('aud_sales')}) AS AUDSales\n"
        "    FROM summary_lines GROUP BY customer_id",
    ),
    "kids_spend": (
        ["fact_sales", "dim_item"],
        f"""
    SELECT f.customer_id, sum({_clamped('f.aud_sales')}) AS kids_AUDSales
    FROM fact_sales f JOIN dim_item i ON i.item_id = f.item_id
    WHERE f.loyalty_flag = 1 AND i.division IN ('2 - KIDS', '13 - SUNNY BUDDY (DNU)')
      AND {_since('f.transaction_date_time', 365)}
    GROUP BY f.customer_id""",
    ),
    # -- e-mail engagement --------------------------------------------------------------
    "sports_sends": (
        ["sendjobs"],
        """
    SELECT send_id, email_name,
           CAST(contains(upper(email_name), '_AFLNRL') AS INTEGER) AS afl_nrl,
           CAST(contains(upper(email_name), '_AFL') AS INTEGER) AS afl,
           CAST(contains(upper(email_name), '_NRL') AS INTEGER) AS nrl
    FROM sendjobs
    WHERE contains(upper(email_name), '_AFL') OR contains(upper(email_name), '_NRL')""",
    ),
    "open_flags": (
        ["opens", "sports_sends"],
        """
    SELECT o.subscriber_key, max(s.afl_nrl) AS opened_afl_nrl, max(s.afl) AS opened_afl, max(s.nrl) AS opened_nrl
    FROM opens o JOIN sports_sends s ON s.send_id = o.send_id
    GROUP BY o.subscriber_key""",
    ),
    "click_flags": (
        ["clicks", "sports_sends"],
        """
    SELECT k.subscriber_key, max(s.afl_nrl) AS clicked_afl_nrl, max(s.afl) AS clicked_afl, max(s.nrl) AS clicked_nrl
    FROM clicks k JOIN sports_sends s ON s.send_id = k.send_id
    GROUP BY k.subscriber_key""",
    ),
    # -- customer view -------------------------------------------------------------------
    "view_inputs": (
        ["scv_members", "purchase_summary", "kids_spend", "open_flags", "click_flags"],
        """
    SELECT m.customer_id, m.email_address, m.age, p.*,
           CAST(coalesce(p.AUDSales, 0) AS DOUBLE) AS sales, CAST(coalesce(k.kids_AUDSales, 0) AS DOUBLE) AS kids_sales,
           o.opened_afl_nrl, o.opened_afl, o.opened_nrl, c.clicked_afl_nrl, c.clicked_afl, c.clicked_nrl,
           CAST(coalesce(k.kids_AUDSales, 0) AS DOUBLE) / nullif(CAST(coalesce(p.AUDSales, 0) AS DOUBLE), 0) AS r
    FROM scv_members m
    LEFT JOIN purchase_summary p ON p.customer_id = m.customer_id
    LEFT JOIN kids_spend k ON k.customer_id = m.customer_id
    LEFT JOIN open_flags o ON o.subscriber_key = m.email_address
    LEFT JOIN click_flags c ON c.subscriber_key = m.email_address
    WHERE m.uq_cust_rank = 1""",
    ),
    "scv": (
        ["view_inputs"],
        f"""
    SELECT customer_id, email_address,
           coalesce(Transacted_KIDS, '') AS Transacted_KIDS,
           coalesce({_pure_multi('Transacted_BABY', 'trans_other_than_BABY')}, '') AS Transacted_BABY,
           coalesce({_pure_multi('trans_mens', 'trans_other_than_mens')}, '') AS Transacted_Cat_Menswear,
           coalesce({_pure_multi('trans_Kids', 'trans_other_than_Kids')}, '') AS Transacted_KIDS_flag,
           coalesce(CASE WHEN trans_AFL = 1 AND coalesce(trans_NRL, 0) = 0 THEN 'AFL'
                         WHEN trans_NRL = 1 AND coalesce(trans_AFL, 0) = 0 THEN 'NRL'
                         WHEN trans_AFL = 1 AND trans_NRL = 1 THEN 'Multi'
                         WHEN clicked_afl_nrl = 1 THEN 'Multi_em_c'
                         WHEN clicked_afl = 1 THEN 'AFL_em_c'
                         WHEN clicked_nrl = 1 THEN 'NRL_em_c'
                         WHEN opened_afl_nrl = 1 THEN 'Multi_em_o'
                         WHEN opened_afl = 1 THEN 'AFL_em_o'
                         WHEN opened_nrl = 1 THEN 'NRL_em_o' END, '') AS Transacted_Cat_Sports,
           coalesce({_pure_multi('trans_curve', 'trans_other_than_curve')}, '') AS Transacted_Cat_Curve,
           coalesce({_pure_multi('trans_cobrands', 'trans_other_than_cobrands')}, '') AS Transacted_Cat_CoBrands,
           coalesce({_pure_multi('trans_supre', 'trans_other_than_supre')}, '') AS Transacted_Cat_SUPRE,
           coalesce({_pure_multi('trans_curve_bottoms', 'trans_curve_bottoms')}, '') AS Transacted_Cat_Curve_Bottoms,
           coalesce({_pure_multi('trans_petite', 'trans_petite')}, '') AS Transacted_Cat_Petite,
           CASE WHEN r >= 0.05 OR (r >= 0.01 AND age = 9999) THEN 'PARENT'
                WHEN age < 25 THEN 'EDIT'
                ELSE 'GENERIC' END AS LIFESTAGE
    FROM view_inputs""",
    ),
    # -- age profiling -------------------------------------------------------------------
    "profile_lines": (
        ["fact_sales", "dim_item"],
        """
    SELECT f.customer_id, f.sale_code, f.store_currency_code,
           CASE f.online_sale WHEN 0 THEN 'Store' WHEN 1 THEN 'Online' END AS channel,
           CASE f.online_sale WHEN 0 THEN CAST(f.transaction_date_time AS DATE)
                              WHEN 1 THEN CAST(f.ordered_date AS DATE) END AS trans_order_date,
           i.division, i.department, i.category, i.item_description, f.aud_sales
    FROM fact_sales f JOIN dim_item i ON i.item_id = f.item_id
    WHERE f.loyalty_flag = 1 AND f.store_currency_code IN ('AUD', 'HKD', 'MLR', 'NZD', 'SGD', 'USD', 'ZAR')""",
    ),
    "category_sales": (
        ["profile_lines"],
        f"""
    SELECT customer_id, store_currency_code, channel, trans_order_date, division, department, category,
           sum(aud_sales) AS aud_sales
    FROM profile_lines
    WHERE trans_order_date {_PROFILE_DAYS}
    GROUP BY customer_id, store_currency_code, channel, trans_order_date, division, department, category""",
    ),
    "item_sales": (
        ["profile_lines", "date_dimension"],
        f"""
    SELECT x.customer_id, x.sale_code, x.store_currency_code, x.channel, d.trade_week_code AS TradeWeekCode,
           x.division, x.department, x.category, replace(x.item_description, ',', '-') AS item,
           sum(x.aud_sales) AS aud_sales
    FROM profile_lines x JOIN date_dimension d ON d.d = x.trans_order_date
    WHERE x.trans_order_date {_PROFILE_DAYS}
    GROUP BY x.customer_id, x.sale_code, x.store_currency_code, x.channel, d.trade_week_code, x.division,
             x.department, x.category, replace(x.item_description, ',', '-')""",
    ),
    # -- mobile app ----------------------------------------------------------------------
    "app": (
        ["app_events"],
        """
    SELECT *, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS day,
           replace(CASE WHEN geo.country IN ('Australia', 'New Zealand', 'United States') THEN geo.country
                        WHEN geo.country IS NOT NULL THEN 'Other' END, ' ', '') AS ctry
    FROM app_events""",
    ),
    "push_open_rows": (
        ["app"],
        """
    SELECT DISTINCT a.ctry AS country, a.event_timestamp, a.day AS event_date, a.event_name, a.user_pseudo_id,
           p.key AS event_key, p.value.string_value AS event_key_value,
           u.key AS user_properties_key, u.value.int_value AS ga_session_id
    FROM app a, unnest(a.event_params) AS t1(p), unnest(a.user_properties) AS t2(u)
    WHERE a.event_name = 'appOpen' AND p.value.string_value = 'Push' AND u.key = 'ga_session_id'""",
    ),
    "purchase_rows": (
        ["app"],
        """
    SELECT a.ctry AS country, a.event_timestamp, a.day AS event_date, a.event_name, a.user_pseudo_id,
           u.value.int_value AS ga_session_id, sum(a.event_value_in_usd) AS sales_usd
    FROM app a, unnest(a.user_properties) AS t(u)
    WHERE a.event_name = 'ecommerce_purchase' AND u.key = 'ga_session_id'
    GROUP BY a.ctry, a.event_timestamp, a.day, a.event_name, a.user_pseudo_id, u.value.int_value""",
    ),
    "push_by_day": (
        ["push_open_rows", "purchase_rows"],
        """
    SELECT p.country, p.event_date, count(*) AS push_sessions, count(DISTINCT p.user_pseudo_id) AS distinct_push_user,
           sum(b.sales_usd) AS push_sales_usd
    FROM push_open_rows p
    LEFT JOIN purchase_rows b ON b.user_pseudo_id = p.user_pseudo_id AND b.ga_session_id = p.ga_session_id
    GROUP BY p.country, p.event_date""",
    ),
    "purchases_by_day": (
        ["app"],
        """
    SELECT day AS event_date, ctry AS country, count(*) AS transactions
    FROM app WHERE event_name = 'ecommerce_purchase' GROUP BY day, ctry""",
    ),
    "sessions_by_day": (
        ["app", "date_dimension"],
        """
    SELECT a.day AS event_date, c.trade_week_code AS TradeWeekCode, CAST(date_trunc('week', c.d) AS DATE) AS week_commencing,
           a.ctry AS country, a.event_date || a.ctry AS joinKey, count(*) AS sessions
    FROM app a JOIN date_dimension c ON CAST(c.date_key AS VARCHAR) = a.event_date
    WHERE a.event_name = 'session_start'
    GROUP BY a.day, a.event_date, c.trade_week_code, c.d, a.ctry""",
    ),
    "first_opens_by_day": (
        ["app"],
        """
    SELECT event_date, country, first_opens,
           sum(first_opens) OVER (PARTITION BY country ORDER BY event_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_opens
    FROM (SELECT day AS event_date, ctry AS country, count(*) AS first_opens
          FROM app WHERE event_name = 'first_open' GROUP BY day, ctry) x""",
    ),
}

_ALL_CTES = {**_MAPPING, **_QUERY_CTES}


def _with(final_sql: str, needs: list[str]) -> str:
    """``WITH`` clause holding ``needs`` and everything they depend on, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in _ALL_CTES[name][0]:
            visit(dep)
        ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({_ALL_CTES[name][1]}\n)" for name in ordered)
    return f"WITH {ctes}\n{final_sql.strip()}"


def _big(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)


_BASE_SELECT = """
SELECT customer_id, date_from_f, date_to_f, insert_user, loyalty_code, gender, email_address, age_band, age_segment,
       CAST(age AS BIGINT) AS age, signup_storetype, CAST(store_sign_up AS BIGINT) AS store_sign_up, cust_postcode,
       CAST(uq_cust_rank AS BIGINT) AS uq_cust_rank"""

_SEGMENT_UNION = "\nUNION ALL\n".join(
    f"SELECT '{base}' AS segment_name, customer_id, {column} AS Segment FROM scv WHERE {column} IS DISTINCT FROM ''"
    for base, column, _ in C.SEGMENT_ROUTING
)

_PROFILE_SUM = "CAST(coalesce(sum(aud_sales), 0) AS DOUBLE) AS aud_sales"
_WITH_SUMMARY = "FROM scv_members m LEFT JOIN purchase_summary p ON p.customer_id = m.customer_id WHERE m.uq_cust_rank = 1"

ORACLE_SQL: dict[str, str] = {
    "loyalty_base": _with(_BASE_SELECT + " FROM scv_members", ["scv_members"]),
    "perks_snapshot": _with(_BASE_SELECT + " FROM snapshot", ["snapshot"]),
    "age_band_a_counts": _with(
        "SELECT age_band, count(*) AS n FROM scv_members WHERE uq_cust_rank = 1 GROUP BY age_band", ["scv_members"]
    ),
    "age_band_b_counts": _with("SELECT age_band, count(*) AS n FROM snapshot GROUP BY age_band", ["snapshot"]),
    "age_segment_counts": _with("SELECT age_segment, count(*) AS n FROM snapshot GROUP BY age_segment", ["snapshot"]),
    "plus_bottoms": _with(
        "SELECT division, department, category, item_id, prod_id, size, CAST(bottoms_14plus AS BIGINT) AS bottoms_14plus,"
        " tops_bottoms FROM plus_size_bottoms",
        ["plus_size_bottoms"],
    ),
    "transaction_summary": _with(
        f"SELECT customer_id, Transacted_KIDS, {_big(_FLAG_COLUMNS)}, CAST(AUDSales AS DOUBLE) AS AUDSales"
        " FROM purchase_summary",
        ["purchase_summary"],
    ),
    "kids_summary": _with(
        "SELECT customer_id, CAST(kids_AUDSales AS DOUBLE) AS kids_AUDSales FROM kids_spend", ["kids_spend"]
    ),
    "sports_campaigns": _with(
        f"SELECT CAST(send_id AS BIGINT) AS send_id, email_name, {_big(['afl_nrl', 'afl', 'nrl'])} FROM sports_sends",
        ["sports_sends"],
    ),
    "opened_flags": _with(
        f"SELECT subscriber_key, {_big(['opened_afl_nrl', 'opened_afl', 'opened_nrl'])} FROM open_flags", ["open_flags"]
    ),
    "clicked_flags": _with(
        f"SELECT subscriber_key, {_big(['clicked_afl_nrl', 'clicked_afl', 'clicked_nrl'])} FROM click_flags",
        ["click_flags"],
    ),
    "scv": _with("SELECT * FROM scv", ["scv"]),
    "lifestage_counts": _with("SELECT LIFESTAGE, count(*) AS n FROM scv GROUP BY LIFESTAGE", ["scv"]),
    "sports_affinity_counts": _with(
        "SELECT Transacted_Cat_Sports, count(*) AS n FROM scv GROUP BY Transacted_Cat_Sports", ["scv"]
    ),
    "segment_extracts": _with(_SEGMENT_UNION, ["scv"]),
    "supre_extract": _with(
        "SELECT customer_id, Transacted_Cat_SUPRE AS Segment, email_address FROM scv"
        " WHERE Transacted_Cat_SUPRE IS DISTINCT FROM ''",
        ["scv"],
    ),
    "age_profile_sales": _with(
        "SELECT customer_id, store_currency_code, channel, trans_order_date, division, department, category,"
        " CAST(aud_sales AS DOUBLE) AS aud_sales FROM category_sales",
        ["category_sales"],
    ),
    "age_profile": _with(
        f"""SELECT c.store_currency_code, c.channel, c.trans_order_date, c.division, c.department, c.category,
       s.age_segment, {_PROFILE_SUM}
FROM category_sales c JOIN snapshot s ON s.customer_id IS NOT DISTINCT FROM c.customer_id
WHERE c.store_currency_code IS NOT NULL AND c.channel IS NOT NULL AND c.trans_order_date IS NOT NULL
  AND c.division IS NOT NULL AND c.department IS NOT NULL AND c.category IS NOT NULL AND s.age_segment IS NOT NULL
GROUP BY c.store_currency_code, c.channel, c.trans_order_date, c.division, c.department, c.category, s.age_segment""",
        ["category_sales", "snapshot"],
    ),
    "age_profile_item_sales": _with(
        "SELECT customer_id, sale_code, store_currency_code, channel, CAST(TradeWeekCode AS BIGINT) AS TradeWeekCode,"
        " division, department, category, item, CAST(aud_sales AS DOUBLE) AS aud_sales FROM item_sales",
        ["item_sales"],
    ),
    "age_profile_item": _with(
        f"""SELECT x.store_currency_code, x.channel, CAST(x.TradeWeekCode AS BIGINT) AS TradeWeekCode, x.division,
       x.department, x.category, x.item, s.age_segment, {_PROFILE_SUM}
FROM item_sales x JOIN snapshot s ON s.customer_id IS NOT DISTINCT FROM x.customer_id
WHERE s.age_segment <> 'Missing'
  AND x.store_currency_code IS NOT NULL AND x.channel IS NOT NULL AND x.TradeWeekCode IS NOT NULL
  AND x.division IS NOT NULL AND x.department IS NOT NULL AND x.category IS NOT NULL AND x.item IS NOT NULL
GROUP BY x.store_currency_code, x.channel, x.TradeWeekCode, x.division, x.department, x.category, x.item,
         s.age_segment""",
        ["item_sales", "snapshot"],
    ),
    "push_sessions": _with("SELECT * FROM push_open_rows", ["push_open_rows"]),
    "ecomm_purchases": _with(
        "SELECT country, event_timestamp, event_date, event_name, user_pseudo_id, ga_session_id,"
        " CAST(sales_usd AS DOUBLE) AS sales_usd FROM purchase_rows",
        ["purchase_rows"],
    ),
    "push_revenue": _with(
        "SELECT country, event_date, push_sessions, distinct_push_user, CAST(push_sales_usd AS DOUBLE) AS push_sales_usd"
        " FROM push_by_day",
        ["push_by_day"],
    ),
    "daily_transactions": _with("SELECT * FROM purchases_by_day", ["purchases_by_day"]),
    "daily_sessions": _with(
        "SELECT event_date, CAST(TradeWeekCode AS BIGINT) AS TradeWeekCode, week_commencing, country, joinKey, sessions"
        " FROM sessions_by_day",
        ["sessions_by_day"],
    ),
    "first_opens": _with(
        "SELECT event_date, country, first_opens, CAST(cumulative_opens AS BIGINT) AS cumulative_opens"
        " FROM first_opens_by_day",
        ["first_opens_by_day"],
    ),
    "mobile_report": _with(
        """SELECT s.event_date, CAST(s.TradeWeekCode AS BIGINT) AS TradeWeekCode, s.week_commencing, s.country, s.joinKey,
       coalesce(f.first_opens, 0) AS first_opens,
       CAST(coalesce(f.cumulative_opens, 0) AS BIGINT) AS cumulative_opens,
       coalesce(s.sessions, 0) AS sessions,
       coalesce(t.transactions, 0) AS transactions,
       coalesce(b.push_sessions, 0) AS push_sessions,
       coalesce(b.distinct_push_user, 0) AS distinct_push_sessions,
       CAST(coalesce(b.push_sales_usd, 0) AS DOUBLE) AS push_sales_usd
FROM sessions_by_day s
LEFT JOIN first_opens_by_day f ON f.event_date = s.event_date AND f.country = s.country
LEFT JOIN purchases_by_day t ON t.event_date = s.event_date AND t.country = s.country
LEFT JOIN push_by_day b ON b.event_date = s.event_date AND b.country = s.country
ORDER BY s.country NULLS FIRST, s.event_date""",
        ["sessions_by_day", "first_opens_by_day", "purchases_by_day", "push_by_day"],
    ),
    "high_value_extract": _with(
        """SELECT email_address,
       CASE WHEN online_before = 0 THEN 'No Prior Online Shop' ELSE 'Shopped Online before' END AS Channel
FROM (SELECT c.email_address, max(coalesce(p.channel_online, 0)) AS online_before,
             bool_or(coalesce(p.AUDSales, 0) > 275) AS high_value, sum(coalesce(p.AUDSales, 0)) AS total
      FROM scv_members m
      LEFT JOIN purchase_summary p ON p.customer_id = m.customer_id
      LEFT JOIN crm_customer c ON c.customer_id = m.customer_id
      GROUP BY c.email_address) e
WHERE high_value AND length(rtrim(email_address)) > 2
ORDER BY total DESC""",
        ["scv_members", "purchase_summary", "crm_customer"],
    ),
    "plus_size_ladieswear": _with(
        f"""SELECT DISTINCT f.customer_id, 'CURVE' AS segment
FROM fact_sales f JOIN dim_item i ON i.item_id = f.item_id
WHERE i.department = '12 - LADIESWEAR' AND contains(upper(i.size), '+') AND {_since('f.transaction_date_time', 365)}""",
        ["fact_sales", "dim_item"],
    ),
    "sports_original_counts": _with(
        f"""SELECT CASE WHEN trans_AFL = 1 AND coalesce(trans_NRL, 0) = 0 AND coalesce(trans_other_than_AFL_NRL, 0) = 0 THEN 'AFL'
            WHEN trans_NRL = 1 AND coalesce(trans_AFL, 0) = 0 AND coalesce(trans_other_than_AFL_NRL, 0) = 0 THEN 'NRL'
            WHEN (trans_AFL = 1 OR trans_NRL = 1) AND coalesce(trans_other_than_AFL_NRL, 0) = 1 THEN 'Multi'
       END AS Transacted_Cat_Sports_original, count(*) AS n
{_WITH_SUMMARY}
GROUP BY 1""",
        ["scv_members", "purchase_summary"],
    ),
    "sports_flag_pairs": _with(
        f"""SELECT count(*) AS c, CAST(trans_AFL AS BIGINT) AS trans_AFL, CAST(trans_NRL AS BIGINT) AS trans_NRL
{_WITH_SUMMARY}
GROUP BY trans_AFL, trans_NRL""",
        ["scv_members", "purchase_summary"],
    ),
}

# The same report from the same events, however they are stored.
ORACLE_SQL["mobile_report_shards"] = ORACLE_SQL["mobile_report"]
# The same summary, from day states instead of one pass over the year.
ORACLE_SQL["rolling_summary"] = ORACLE_SQL["transaction_summary"]
ORACLE_SQL["transaction_summary_clustered"] = ORACLE_SQL["transaction_summary"]
ORACLE_SQL["first_opens_stored"] = ORACLE_SQL["first_opens"]
# The same reports, written as SQL text.
ORACLE_SQL["perks_snapshot_sql"] = ORACLE_SQL["perks_snapshot"]
ORACLE_SQL["age_profile_sql"] = ORACLE_SQL["age_profile"]
ORACLE_SQL["daily_sessions_sql"] = ORACLE_SQL["daily_sessions"]

ORACLE_SQL["push_users_by_week"] = _with(
    """SELECT CAST(c.trade_week_code AS BIGINT) AS TradeWeekCode, p.country, count(DISTINCT p.user_pseudo_id) AS push_users
FROM push_open_rows p JOIN date_dimension c ON c.d = p.event_date
GROUP BY ALL HAVING count(p.user_pseudo_id) > 0""",
    ["push_open_rows", "date_dimension"],
)
