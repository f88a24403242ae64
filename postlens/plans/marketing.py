"""Registered customer and marketing queries."""

from __future__ import annotations

from postlens.operators import marketing as M
from postlens.operators.marketing import sentiment_shares
from postlens.plans.catalog import register
from postlens.sources.standins import load
from postlens.sources.tables import table

S = "2.5"
MI = "(year({d}) * 12 + month({d}) - 1)"


@register("ecommerce_kpis", section=S, oracle="""
SELECT count(DISTINCT order_id) AS total_orders, sum(amount) AS total_revenue,
       sum(amount) / nullif(count(DISTINCT order_id), 0) AS avg_order_value
FROM purchases""")
def q_ecommerce_kpis(spark, sf):
    return M.ecommerce_kpis(load(spark, sf, "purchases"))


@register("funnel_counts", section=S, oracle="""
SELECT page_views, cart_additions, checkout_starts, orders,
       cart_additions / nullif(page_views, 0) AS view_to_cart,
       checkout_starts / nullif(cart_additions, 0) AS cart_to_checkout,
       orders / nullif(checkout_starts, 0) AS checkout_to_order
FROM (SELECT cast(count_if(channel = 'view') AS BIGINT) AS page_views,
             cast(count_if(channel = 'click') AS BIGINT) AS cart_additions,
             cast(count_if(channel = 'signup') AS BIGINT) AS checkout_starts,
             cast(count_if(channel = 'purchase') AS BIGINT) AS orders
      FROM touches) c""")
def q_funnel_counts(spark, sf):
    return M.funnel_counts(load(spark, sf, "touches"))


@register("crm_kpis", section=S, oracle=f"""
WITH per AS (SELECT customer_id, min(order_date) AS first, count(*) AS n FROM purchases GROUP BY customer_id)
SELECT count(*) AS total_customers,
       cast(count_if({MI.format(d='first')} = (SELECT max({MI.format(d='order_date')}) FROM purchases)) AS BIGINT)
         AS new_leads,
       count_if(n >= 2) / nullif(count(*), 0) * 100.0E0 AS conversion_rate,
       (SELECT avg(amount) FROM purchases) AS avg_deal_size
FROM per""")
def q_crm_kpis(spark, sf):
    return M.crm_kpis(load(spark, sf, "purchases"))


@register("email_kpis", section=S, oracle="""
SELECT cast(sent AS BIGINT) AS emails_sent, opened / nullif(sent, 0) * 100.0E0 AS open_rate,
       clicked / nullif(sent, 0) * 100.0E0 AS click_rate
FROM (SELECT count_if(channel = 'view') AS sent, count_if(channel = 'click') AS opened,
             count_if(channel = 'signup') AS clicked FROM touches) c""")
def q_email_kpis(spark, sf):
    return M.email_kpis(load(spark, sf, "touches"))


SESSIONS_SQL = """
se AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM touches),
st AS (SELECT *, CASE WHEN prev IS NULL OR prev + INTERVAL 30 MINUTE <= ts THEN 1 ELSE 0 END AS is_start FROM se),
sn AS (SELECT *, sum(is_start) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
       FROM st),
ss AS (SELECT user_id, sid, count(*) AS events, min(ts) AS s0, max(ts) AS s1,
              last(channel ORDER BY ts, event_id) AS exit_page,
              max(CASE WHEN is_conversion THEN 1 ELSE 0 END) AS converted
       FROM sn GROUP BY user_id, sid)"""


@register("web_kpis", section=S, oracle=f"""
WITH {SESSIONS_SQL}
SELECT count(*) AS sessions,
       count_if(events = 1) / nullif(count(*), 0) * 100.0E0 AS bounce_rate,
       sum(converted) / nullif(count(*), 0) * 100.0E0 AS conversion_rate,
       avg(events) AS pages_per_session,
       avg(date_diff('microsecond', s0, s1) / 1e6) AS avg_session_seconds,
       (SELECT exit_page FROM (SELECT exit_page, count(*) AS n FROM ss GROUP BY exit_page) x
        ORDER BY n DESC, exit_page LIMIT 1) AS top_exit_page
FROM ss""")
def q_web_kpis(spark, sf):
    return M.web_kpis(load(spark, sf, "touches"))


@register("behavior_kpis", section=S, oracle=f"""
WITH {SESSIONS_SQL},
u AS (SELECT channel, count(*) AS sessions_using FROM (SELECT DISTINCT channel, user_id, sid FROM sn) d
      GROUP BY channel)
SELECT channel, sessions_using, (SELECT count(*) FROM ss) AS sessions,
       (SELECT count_if(channel = 'click') FROM touches) / nullif((SELECT count(*) FROM ss), 0)
         AS clicks_per_session,
       sessions_using / nullif((SELECT count(*) FROM ss), 0) AS feature_use_share
FROM u""")
def q_behavior_kpis(spark, sf):
    return M.behavior_kpis(load(spark, sf, "touches"))


@register("social_kpis", section=S, oracle="""
SELECT channel, count(*) AS followers, cast(sum(n) AS BIGINT) AS mentions,
       count_if(n >= 2) / nullif(count(*), 0) * 100.0E0 AS engagement_rate
FROM (SELECT channel, user_id, count(*) AS n FROM touches GROUP BY channel, user_id) p
GROUP BY channel""")
def q_social_kpis(spark, sf):
    return M.social_kpis(load(spark, sf, "touches"))


@register("sentiment_shares", section=S, oracle="""
SELECT avg(cast(sentiment = 'positive' AS double)) AS positive_share,
       avg(cast(sentiment = 'neutral' AS double)) AS neutral_share,
       avg(cast(sentiment = 'negative' AS double)) AS negative_share
FROM feedback""")
def q_sentiment_shares(spark, sf):
    return sentiment_shares(load(spark, sf, "feedback"))


TOTALS_SQL = """
t AS (SELECT customer_id, avg(amount) AS avg_order_value, count(*) AS order_count, sum(amount) AS total_spent,
             max(order_date) AS last_order_date
      FROM purchases GROUP BY customer_id)"""


@register("customer_features", section=S, oracle=f"""
WITH {TOTALS_SQL},
q AS (SELECT *, ntile(5) OVER (ORDER BY total_spent, customer_id) AS qn FROM t)
SELECT customer_id, avg_order_value, order_count, total_spent,
       cast(date_diff('day', last_order_date, (SELECT max(order_date) FROM purchases) + 1) AS INTEGER)
         AS days_since_last_order,
       CASE WHEN qn = 5 THEN 'high_value' WHEN order_count >= 5 THEN 'loyal' ELSE 'regular' END
         AS customer_segment
FROM q""")
def q_customer_features(spark, sf):
    return M.customer_features(load(spark, sf, "purchases"))


CONV_SQL = """
conv AS (SELECT user_id, min(CASE WHEN is_conversion THEN ts END) AS fc FROM touches GROUP BY user_id),
mf AS (SELECT channel, cast(sum(n) AS BIGINT) AS impressions, count(*) AS clicks, sum(v) AS cost,
              avg(CASE WHEN fc IS NOT NULL THEN 1.0E0 ELSE 0.0E0 END) AS conversion_rate
       FROM (SELECT channel, user_id, count(*) AS n, sum(value) AS v FROM touches GROUP BY channel, user_id) pu
       LEFT JOIN conv USING (user_id) GROUP BY channel)"""


@register("marketing_features", section=S, oracle=f"WITH {CONV_SQL} SELECT * FROM mf")
def q_marketing_features(spark, sf):
    return M.marketing_features(load(spark, sf, "touches"))


ATTR_SQL = """
fcv AS (SELECT user_id, first(ts ORDER BY ts, event_id) AS cts, first(value ORDER BY ts, event_id) AS cv
        FROM touches WHERE is_conversion GROUP BY user_id),
att AS (SELECT t.user_id, first(t.channel ORDER BY t.ts, t.event_id) AS first_touch,
               last(t.channel ORDER BY t.ts, t.event_id) AS last_touch, any_value(f.cv) AS conversion_value
        FROM touches t JOIN fcv f ON t.user_id = f.user_id WHERE t.ts < f.cts GROUP BY t.user_id)"""


@register("marketing_attribution", section="2.6", oracle=f"""
WITH {ATTR_SQL},
fa AS (SELECT first_touch AS channel, count(*) AS n FROM att GROUP BY 1),
la AS (SELECT last_touch AS channel, count(*) AS n FROM att GROUP BY 1)
SELECT coalesce(fa.channel, la.channel) AS channel,
       coalesce(fa.n, 0) AS first_touch_conversions, coalesce(la.n, 0) AS last_touch_conversions,
       coalesce(fa.n, 0) / nullif((SELECT count(*) FROM att), 0) * 100.0E0 AS first_touch_share,
       coalesce(la.n, 0) / nullif((SELECT count(*) FROM att), 0) * 100.0E0 AS last_touch_share
FROM fa FULL OUTER JOIN la ON fa.channel = la.channel""")
def q_marketing_attribution(spark, sf):
    return M.marketing_attribution(load(spark, sf, "touches"))


@register("roi_by_channel", section=S, oracle=f"""
WITH {CONV_SQL}, {ATTR_SQL},
av AS (SELECT last_touch AS channel, sum(conversion_value) AS attributed_value FROM att GROUP BY 1)
SELECT mf.channel, impressions, clicks, cost, coalesce(av.attributed_value, 0.0E0) AS attributed_value,
       (coalesce(av.attributed_value, 0.0E0) - cost) / nullif(cost, 0) AS roi,
       clicks / nullif(impressions, 0) AS click_through_rate,
       cost / nullif(clicks, 0) AS cost_per_click
FROM mf LEFT JOIN av ON mf.channel = av.channel""")
def q_roi_by_channel(spark, sf):
    return M.roi_by_channel(load(spark, sf, "touches"))


@register("behavioral_features", section=S, oracle="""
SELECT user_id, cast(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
       date_diff('microsecond', min(ts), max(ts)) / 6e7 AS engaged_minutes,
       cast(count_if(event_type = 'view') AS BIGINT) AS views, cast(count_if(event_type = 'click') AS BIGINT) AS cart_adds,
       cast(count_if(event_type = 'purchase') AS BIGINT) AS purchases, sum(value) AS total_value,
       count_if(event_type = 'click') / nullif(count_if(event_type = 'view'), 0) AS click_rate
FROM events GROUP BY user_id, cast(json_extract_string(props, '$.k') AS INTEGER)""")
def q_behavioral_features(spark, sf):
    return M.behavioral_features(table(spark, sf, "events", "user_id", "ts", "event_type", "value", "props"))


@register("cohort_retention", section="2.6", oracle=f"""
WITH p AS (SELECT customer_id, {MI.format(d='order_date')} AS m FROM purchases),
f AS (SELECT customer_id, min(m) AS cohort FROM p GROUP BY customer_id),
a AS (SELECT DISTINCT f.cohort, p.m - f.cohort AS k, p.customer_id FROM p JOIN f USING (customer_id)
      WHERE p.m - f.cohort IN (1, 3, 6)),
sz AS (SELECT cohort, count(*) AS cohort_size FROM f GROUP BY cohort),
h AS (SELECT cohort, count_if(k = 1) AS a1, count_if(k = 3) AS a3, count_if(k = 6) AS a6 FROM a GROUP BY cohort)
SELECT printf('%04d-%02d', cohort // 12, cohort % 12 + 1) AS cohort_month, cohort_size,
       CASE WHEN cohort + 1 <= (SELECT max(m) FROM p) THEN coalesce(a1, 0) / nullif(cohort_size, 0) * 100.0E0 END
         AS retention_1m,
       CASE WHEN cohort + 3 <= (SELECT max(m) FROM p) THEN coalesce(a3, 0) / nullif(cohort_size, 0) * 100.0E0 END
         AS retention_3m,
       CASE WHEN cohort + 6 <= (SELECT max(m) FROM p) THEN coalesce(a6, 0) / nullif(cohort_size, 0) * 100.0E0 END
         AS retention_6m
FROM sz LEFT JOIN h USING (cohort)""")
def q_cohort_retention(spark, sf):
    return M.cohort_retention(load(spark, sf, "purchases"))


RFM_SQL = f"""
WITH {TOTALS_SQL},
n AS (SELECT *, ntile(5) OVER (ORDER BY last_order_date, customer_id) AS r,
             ntile(5) OVER (ORDER BY order_count, customer_id) AS f,
             ntile(5) OVER (ORDER BY total_spent, customer_id) AS m FROM t),
g AS (SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'champions'
                     WHEN r >= 3 AND f >= 3 THEN 'loyal_customers'
                     WHEN r >= 3 THEN 'potential_loyalists'
                     WHEN f >= 3 THEN 'at_risk' ELSE 'hibernating' END AS segment FROM n)"""


@register("rfm_segments", section="2.6", oracle=f"""
{RFM_SQL}
SELECT segment, count(*) AS customers, avg(total_spent) AS avg_monetary FROM g GROUP BY segment""")
def q_rfm_segments(spark, sf):
    return M.rfm_segments(load(spark, sf, "purchases"))


@register("customer_ltv", section="2.11", oracle="""
SELECT count(*) AS customers, avg(ltv) AS avg_customer_ltv, sum(ltv) AS total_revenue
FROM (SELECT customer_id, sum(amount) AS ltv FROM purchases GROUP BY customer_id) t""")
def q_customer_ltv(spark, sf):
    return M.customer_ltv(load(spark, sf, "purchases"))


@register("executive_kpis", section="2.11", oracle=f"""
WITH p AS (SELECT customer_id, amount, {MI.format(d='order_date')} AS m FROM purchases),
mo AS (SELECT m, sum(amount) AS rev FROM p GROUP BY m),
nw AS (SELECT fm AS m, count(*) AS nc FROM (SELECT customer_id, min(m) AS fm FROM p GROUP BY customer_id) x
       GROUP BY fm),
j AS (SELECT mo.m, rev, nc, (SELECT max(m) - 1 FROM p) AS lf FROM mo LEFT JOIN nw ON mo.m = nw.m),
k AS (SELECT max(CASE WHEN m = lf THEN rev END) AS cur, max(CASE WHEN m = lf - 1 THEN rev END) AS prev,
             max(CASE WHEN m = lf THEN nc END) AS nc, avg(CASE WHEN m BETWEEN lf - 2 AND lf THEN rev END) AS rec,
             max(lf) AS lf FROM j)
SELECT printf('%04d-%02d', lf // 12, lf % 12 + 1) AS month, cur AS monthly_revenue,
       (cur - prev) / nullif(prev, 0) * 100.0E0 AS revenue_growth_percent,
       cur / nullif(nc, 0) AS revenue_per_new_customer, rec AS recurring_revenue
FROM k""")
def q_executive_kpis(spark, sf):
    return M.executive_kpis(load(spark, sf, "purchases"))


@register("experiment_significance", section="2.11", oracle="""
WITH g AS (SELECT channel,
                  cast(count_if(user_id % 2 = 0) AS BIGINT) AS n_a, cast(count_if(user_id % 2 = 1) AS BIGINT) AS n_b,
                  avg(CASE WHEN user_id % 2 = 0 THEN value END) AS mean_a,
                  avg(CASE WHEN user_id % 2 = 1 THEN value END) AS mean_b,
                  var_samp(CASE WHEN user_id % 2 = 0 THEN value END) AS var_a,
                  var_samp(CASE WHEN user_id % 2 = 1 THEN value END) AS var_b
           FROM touches GROUP BY channel),
z AS (SELECT *, (mean_b - mean_a) / nullif(sqrt(var_a / nullif(n_a, 0) + var_b / nullif(n_b, 0)), 0) AS z_score
      FROM g)
SELECT channel, n_a, n_b, mean_a, mean_b, z_score, abs(z_score) > 1.96 AS significant FROM z""")
def q_experiment_significance(spark, sf):
    return M.experiment_significance(load(spark, sf, "touches"))
