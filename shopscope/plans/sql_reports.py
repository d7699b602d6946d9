"""Three reports written as SQL text over the input views and the SQL functions.

They are what a user who keeps scripts would write for
:func:`~shopscope.plans.views.run_sql`: the loyalty snapshot, the category age profile
and the app sessions per day.  ``{p}`` stands for the prefix of the views.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from .sql_functions import register_functions
from .views import register_inputs, run_sql

#: The earliest started membership of each customer meets the lookups, as in the DataFrame report.
PERKS = """
SELECT f.customer_id, f.date_from_f, f.date_to_f, f.insert_user, f.loyalty_code,
       gender_norm(c.gender) AS gender, c.email_address,
       age_band_perks(c.birth_date) AS age_band, age_segment(c.birth_date) AS age_segment,
       year_difference(c.birth_date, CAST(getdate() AS DATE)) AS age,
       d.store_type AS signup_storetype, s.store_sign_up,
       CASE WHEN d.store_type = :instore THEN l.postcode ELSE c.billing_post_code END AS cust_postcode,
       f.uq_cust_rank
FROM (
  SELECT *, row_number() OVER (
           PARTITION BY customer_id ORDER BY date_from_f, loyalty_customer_id, loyalty_code, insert_user, date_to_f
         ) AS uq_cust_rank
  FROM (SELECT DISTINCT customer_id, loyalty_customer_id, loyalty_code FROM {p}loyalty_customer WHERE status_ind = :active)
  JOIN (SELECT loyalty_customer_id, CAST(date_from AS DATE) AS date_from_f, CAST(date_to AS DATE) AS date_to_f,
               insert_user_norm(insert_user) AS insert_user
        FROM {p}loyalty_member WHERE CAST(date_from AS DATE) <= getdate())
  USING (loyalty_customer_id)
) f
LEFT JOIN {p}crm_customer c ON f.customer_id = c.customer_id
LEFT JOIN {p}cust_store s ON f.customer_id = s.customer_id
LEFT JOIN {p}dim_store d ON s.store_sign_up = d.store_code
LEFT JOIN {p}location l ON d.store_code = l.location_code
WHERE f.uq_cust_rank = 1
"""

#: ``{snapshot}`` is the text above.  The window is stated on the raw columns of either channel, so that it is pushed down.
AGE_PROFILE = """
WITH snapshot AS ({snapshot}),
sales AS (
  SELECT f.customer_id, f.store_currency_code,
         CASE f.online_sale WHEN 0 THEN :store WHEN 1 THEN :online END AS channel,
         CAST(CASE f.online_sale WHEN 0 THEN f.transaction_date_time WHEN 1 THEN f.ordered_date END AS DATE) AS trans_order_date,
         i.division, i.department, i.category, f.aud_sales
  FROM {p}fact_sales f JOIN {p}dim_item i ON f.item_id = i.item_id
  WHERE f.loyalty_flag = 1 AND array_contains(:currencies, f.store_currency_code)
    AND (f.online_sale = 0 AND f.transaction_date_time >= dateadd(DAY, -:first, CAST(getdate() AS DATE))
                           AND f.transaction_date_time < dateadd(DAY, 1 - :last, CAST(getdate() AS DATE))
      OR f.online_sale = 1 AND f.ordered_date >= dateadd(DAY, -:first, CAST(getdate() AS DATE))
                           AND f.ordered_date < dateadd(DAY, 1 - :last, CAST(getdate() AS DATE)))
),
per_customer AS (
  SELECT customer_id, store_currency_code, channel, trans_order_date, division, department, category, sum(aud_sales) AS aud_sales
  FROM sales GROUP BY ALL
)
SELECT s.store_currency_code, s.channel, s.trans_order_date, s.division, s.department, s.category, p.age_segment,
       isnull_number(CAST(sum(s.aud_sales) AS DOUBLE), 0) AS aud_sales
FROM per_customer s JOIN snapshot p ON s.customer_id <=> p.customer_id
WHERE s.store_currency_code IS NOT NULL AND s.channel IS NOT NULL AND s.trans_order_date IS NOT NULL
  AND s.division IS NOT NULL AND s.department IS NOT NULL AND s.category IS NOT NULL AND p.age_segment IS NOT NULL
GROUP BY s.store_currency_code, s.channel, s.trans_order_date, s.division, s.department, s.category, p.age_segment
"""

SESSIONS = """
SELECT parse_date('%Y%m%d', e.ed) AS event_date, w.trade_week_code AS TradeWeekCode, monday_week(w.d) AS week_commencing,
       e.country, concat(e.ed, e.country) AS joinKey, e.sessions
FROM (
  SELECT event_date AS ed, country_bucket(geo.country) AS country, count(*) AS sessions
  FROM {p}app_events WHERE event_name = :session_start GROUP BY 1, 2
) e JOIN {p}date_dimension w ON e.ed = CAST(w.date_key AS STRING)
"""


class SqlReports:
    """The texts above over ``inputs``, with their values bound as arguments."""

    def __init__(self, spark: SparkSession, inputs, as_of: datetime, prefix: str = "in_"):
        self.spark, self.prefix = spark, prefix
        register_inputs(spark, inputs, prefix)
        register_functions(spark, as_of)

    def _run(self, text: str, **args) -> DataFrame:
        return run_sql(self.spark, text.format(p=self.prefix, snapshot=PERKS.format(p=self.prefix)), args)

    def perks_snapshot(self) -> DataFrame:
        return self._run(PERKS, instore=C.INSTORE_STORE_TYPE, active=C.ACTIVE_STATUS)

    def age_profile(self) -> DataFrame:
        return self._run(
            AGE_PROFILE,
            instore=C.INSTORE_STORE_TYPE,
            active=C.ACTIVE_STATUS,
            store=C.CHANNEL_STORE,
            online=C.CHANNEL_ONLINE,
            currencies=list(C.PROFILE_CURRENCIES),
            first=C.PROFILE_FIRST_DAY_BACK,
            last=C.PROFILE_LAST_DAY_BACK,
        )

    def daily_sessions(self) -> DataFrame:
        return self._run(SESSIONS, session_start=C.EVENT_SESSION_START)
