"""Customer and marketing analytics.

The reference only names these outputs; the definitions below are ours
and are stated in each docstring (the DuckDB oracles follow the same
text). Inputs are the ``purchases`` (orders) and ``touches`` (events)
fixtures. Per-customer and per-user work is a ``groupBy`` (partial
aggregation before the shuffle); joins back to the event rows are
key-partitioned joins that AQE can split when one key is hot; the only
global ranking goes through ``ranking.global_ntile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.semantics import safe_div
from postlens.operators.common import side_by_side
from postlens.operators.ranking import global_ntile
from postlens.operators.sessions import sessions

# Stand-in roles of the event types.
FUNNEL_STEPS = ("view", "click", "signup", "purchase")  # page view, cart, checkout, order
EMAIL_STEPS = ("view", "click", "signup")  # sent, opened, clicked


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d) - 1


# ---------------------------------------------------------------- KPI rows
def ecommerce_kpis(purchases: DataFrame) -> DataFrame:
    """orders, revenue, average order value = revenue / orders."""
    return purchases.agg(F.count_distinct("order_id").alias("total_orders"),
                         F.sum("amount").alias("total_revenue")).withColumn(
        "avg_order_value", safe_div("total_revenue", "total_orders"))


def funnel_counts(touches: DataFrame) -> DataFrame:
    """Events per funnel step and the conversion ratio of each step."""
    v, c, s, p = [F.count_if(F.col("channel") == x) for x in FUNNEL_STEPS]
    return touches.agg(v.alias("page_views"), c.alias("cart_additions"), s.alias("checkout_starts"),
                       p.alias("orders")).select(
        "*", safe_div("cart_additions", "page_views").alias("view_to_cart"),
        safe_div("checkout_starts", "cart_additions").alias("cart_to_checkout"),
        safe_div("orders", "checkout_starts").alias("checkout_to_order"))


def crm_kpis(purchases: DataFrame) -> DataFrame:
    """customers; new leads = customers whose first order is in the latest
    month of data; conversion rate % = customers with two or more orders /
    customers; mean deal size = mean order amount."""
    per = purchases.groupBy("customer_id").agg(F.min("order_date").alias("first"),
                                               F.count(F.lit(1)).alias("n"))
    last_month = purchases.agg(F.max(month_index(F.col("order_date")))).scalar()
    c = per.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(month_index(F.col("first")) == last_month).alias("new_leads"),
        (safe_div(F.count_if(F.col("n") >= 2), F.count(F.lit(1))) * 100.0).alias("conversion_rate"))
    d = purchases.agg(F.avg("amount").alias("avg_deal_size"))
    return side_by_side(c, d)


def email_kpis(touches: DataFrame) -> DataFrame:
    """sent, open rate %, click rate % (view, click, signup roles)."""
    sent, opened, clicked = [F.count_if(F.col("channel") == x) for x in EMAIL_STEPS]
    return touches.agg(sent.alias("emails_sent"), opened.alias("_o"), clicked.alias("_c")).select(
        "emails_sent", (safe_div("_o", "emails_sent") * 100.0).alias("open_rate"),
        (safe_div("_c", "emails_sent") * 100.0).alias("click_rate"))


def web_kpis(touches: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Sessions (30-minute gap), bounce rate % (one-event sessions),
    conversion rate % (sessions with a conversion), pages and seconds per
    session, most frequent exit page (ties by name)."""
    s = sessions(touches, gap_minutes)
    secs = F.timestamp_diff("MICROSECOND", F.col("session_start"), F.col("session_end")) / 1e6
    k = s.agg(F.count(F.lit(1)).alias("sessions"),
              (safe_div(F.count_if(F.col("events") == 1), F.count(F.lit(1))) * 100.0).alias("bounce_rate"),
              (safe_div(F.sum("converted"), F.count(F.lit(1))) * 100.0).alias("conversion_rate"),
              F.avg("events").alias("pages_per_session"),
              F.avg(secs).alias("avg_session_seconds"))
    exits = s.groupBy("exit_page").agg(F.count(F.lit(1)).alias("n"))
    top_exit = exits.orderBy(F.desc("n"), F.asc("exit_page")).limit(1).select(
        F.col("exit_page").alias("top_exit_page"))
    return side_by_side(k, top_exit)


def behavior_kpis(touches: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Per channel: share of sessions that used it; with the overall
    sessions and clicks per session on every row."""
    from postlens.operators.sessions import sessionize
    e = sessionize(touches, gap_minutes=gap_minutes)
    used = e.groupBy("channel", "user_id", "session_start").agg(F.count(F.lit(1)).alias("_n"))
    per_channel = used.groupBy("channel").agg(F.count(F.lit(1)).alias("sessions_using"))
    n_sessions = e.agg(F.count_if("is_session_start")).scalar()
    n_clicks = e.agg(F.count_if(F.col("channel") == "click")).scalar()
    return per_channel.select(
        "channel", "sessions_using", n_sessions.alias("sessions"),
        safe_div(n_clicks, n_sessions).alias("clicks_per_session"),
        safe_div("sessions_using", n_sessions).alias("feature_use_share"))


def social_kpis(touches: DataFrame) -> DataFrame:
    """Per network (channel): followers = distinct users, mentions =
    events, engagement % = users with two or more events / followers."""
    per_user = touches.groupBy("channel", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("channel").agg(
        F.count(F.lit(1)).alias("followers"), F.sum("n").alias("mentions"),
        (safe_div(F.count_if(F.col("n") >= 2), F.count(F.lit(1))) * 100.0).alias("engagement_rate"))


def sentiment_shares(feedback: DataFrame) -> DataFrame:
    return feedback.agg(*[F.avg((F.col("sentiment") == s).cast("double")).alias(f"{s}_share")
                          for s in ("positive", "neutral", "negative")])


# ---------------------------------------------------------------- feature tables
def customer_totals(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("customer_id").agg(
        F.avg("amount").alias("avg_order_value"), F.count(F.lit(1)).alias("order_count"),
        F.sum("amount").alias("total_spent"), F.max("order_date").alias("last_order_date"))


def customer_features(purchases: DataFrame) -> DataFrame:
    """Per customer: mean order value, orders, total, days since the last
    order (reference date = last order date in the data + 1 day); segment
    high_value when the total is in the top quintile (ntile 5 by total,
    ties by id), else loyal when orders >= 5, else regular."""
    t = customer_totals(purchases)
    t = t.withColumn("_ref", purchases.agg(F.date_add(F.max("order_date"), 1)).scalar())
    t = global_ntile(t, [F.col("total_spent").asc(), F.col("customer_id").asc()], 5, "_q")
    seg = F.when(F.col("_q") == 5, "high_value").when(F.col("order_count") >= 5, "loyal").otherwise("regular")
    return t.select("customer_id", "avg_order_value", "order_count", "total_spent",
                    F.datediff("_ref", "last_order_date").alias("days_since_last_order"),
                    seg.alias("customer_segment"))


def user_conversions(touches: DataFrame) -> DataFrame:
    """Per user: first conversion time (null when none)."""
    return touches.groupBy("user_id").agg(
        F.min(F.when(F.col("is_conversion"), F.col("ts"))).alias("first_conversion_ts"))


def marketing_features(touches: DataFrame) -> DataFrame:
    """Per channel: impressions (events), clicks (distinct users), cost
    (sum of value), conversion rate = share of the channel's users who
    ever convert."""
    conv = user_conversions(touches)
    per_user = touches.groupBy("channel", "user_id").agg(F.count(F.lit(1)).alias("n"),
                                                         F.sum("value").alias("v"))
    j = per_user.join(conv, "user_id", "left")
    return j.groupBy("channel").agg(
        F.sum("n").alias("impressions"), F.count(F.lit(1)).alias("clicks"), F.sum("v").alias("cost"),
        F.avg(F.col("first_conversion_ts").isNotNull().cast("double")).alias("conversion_rate"))


def attributed_touches(touches: DataFrame) -> DataFrame:
    """Per converting user: first and last channel touched strictly before
    the first conversion (order (ts, event_id)), with the conversion value.
    Users without such a touch are dropped.

    One scan: touches are windowed per (user, day), where the day's first
    conversion tells which of them come before it, and summed up to one row a
    day. Of a user's days those up to the first one with a conversion count (the
    ones before it have none), so a user with a third of all touches is spread
    over as many tasks as there are days, and only day rows meet per user."""
    key = F.struct(F.col("ts"), F.col("event_id"))
    by_day = Window.partitionBy("user_id", "day")
    first = F.min(F.when(F.col("is_conversion"), F.struct("ts", "event_id", "value"))).over(by_day)
    dated = touches.withColumn("day", F.to_date("ts")).withColumn("c", first)
    early = F.col("c").isNull() | (F.col("ts") < F.col("c.ts"))
    known = dated.select("user_id", "day", "c", F.when(early, F.col("channel")).alias("channel"), F.when(early, key).alias("k"))
    days = known.groupBy("user_id", "day").agg(
        F.min_by("channel", "k").alias("first_touch"), F.min("k").alias("first_key"),
        F.max_by("channel", "k").alias("last_touch"), F.max("k").alias("last_key"), F.first("c").alias("c"))
    until = F.min(F.when(F.col("c").isNotNull(), F.col("day"))).over(Window.partitionBy("user_id"))
    return (days.withColumn("until", until).where(F.col("day") <= F.col("until")).groupBy("user_id").agg(
        F.min_by("first_touch", "first_key").alias("first_touch"), F.max_by("last_touch", "last_key").alias("last_touch"),
        F.max("c.value").alias("conversion_value"), F.max("last_key").alias("k")).where("k is not null").drop("k"))


def marketing_attribution(touches: DataFrame) -> DataFrame:
    """Share of conversions (in %) credited to each channel under the
    first-touch and the last-touch model."""
    a = attributed_touches(touches)
    n = a.agg(F.count(F.lit(1))).scalar()
    first = a.groupBy(F.col("first_touch").alias("channel")).agg(F.count(F.lit(1)).alias("first_touch_conversions"))
    last = a.groupBy(F.col("last_touch").alias("channel")).agg(F.count(F.lit(1)).alias("last_touch_conversions"))
    j = first.join(last, "channel", "full").withColumn("_n", n)
    return j.select("channel",
                    F.coalesce("first_touch_conversions", F.lit(0)).alias("first_touch_conversions"),
                    F.coalesce("last_touch_conversions", F.lit(0)).alias("last_touch_conversions"),
                    (safe_div(F.coalesce("first_touch_conversions", F.lit(0)), "_n") * 100.0).alias("first_touch_share"),
                    (safe_div(F.coalesce("last_touch_conversions", F.lit(0)), "_n") * 100.0).alias("last_touch_share"))


def roi_by_channel(touches: DataFrame) -> DataFrame:
    """Per channel: (value of last-touch attributed conversions - cost) /
    cost, click-through = clicks / impressions, cost per click."""
    f = marketing_features(touches)
    a = (attributed_touches(touches).groupBy(F.col("last_touch").alias("channel"))
         .agg(F.sum("conversion_value").alias("attributed_value")))
    j = f.join(a, "channel", "left").withColumn("attributed_value", F.coalesce("attributed_value", F.lit(0.0)))
    return j.select("channel", "impressions", "clicks", "cost", "attributed_value",
                    safe_div(F.col("attributed_value") - F.col("cost"), "cost").alias("roi"),
                    safe_div("clicks", "impressions").alias("click_through_rate"),
                    safe_div("cost", "clicks").alias("cost_per_click"))


def behavioral_features(events: DataFrame) -> DataFrame:
    """Per (user, product) with product = ``k`` of the event's JSON props:
    engaged minutes (first to last event), views, cart adds (click),
    purchases, total value, click rate = cart adds / views."""
    e = events.withColumn("product_id", F.get_json_object("props", "$.k").cast("int"))
    mins = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 6e7
    g = e.groupBy("user_id", "product_id").agg(
        mins.alias("engaged_minutes"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "click").alias("cart_adds"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum("value").alias("total_value"))
    return g.withColumn("click_rate", safe_div("cart_adds", "views"))


# ---------------------------------------------------------------- cohorts, RFM, LTV
def cohort_retention(purchases: DataFrame, offsets: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """Cohort = month of first purchase; retention_k = customers with a
    purchase exactly k months later / cohort size, in %; null when month k
    lies beyond the last month of data."""
    # one row per customer and month before any join: a hot customer has few months
    p = purchases.select("customer_id", month_index(F.col("order_date")).alias("m")).distinct()
    first = p.groupBy("customer_id").agg(F.min("m").alias("cohort"))
    last = p.agg(F.max("m")).scalar()
    active = p.join(first, "customer_id").select("customer_id", "cohort", (F.col("m") - F.col("cohort")).alias("k"))
    hits = (active.where(F.col("k").isin(*offsets)).select("cohort", "k", "customer_id")
            .groupBy("cohort").agg(*[F.count_if(F.col("k") == k).alias(f"_a{k}") for k in offsets]))
    size = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    j = size.join(hits, "cohort", "left").withColumn("_last", last)
    cols = [F.format_string("%04d-%02d", (F.col("cohort") / 12).cast("int"), F.col("cohort") % 12 + 1)
            .alias("cohort_month"), "cohort_size"]
    for k in offsets:
        cols.append(F.when(F.col("cohort") + k <= F.col("_last"),
                           safe_div(F.coalesce(F.col(f"_a{k}"), F.lit(0)), "cohort_size") * 100.0)
                    .alias(f"retention_{k}m"))
    return j.select(*cols)


def rfm_scores(purchases: DataFrame) -> DataFrame:
    """r, f, m = ntile(5) with 5 best (latest last order, most orders,
    highest total), ties by customer id; then the segment, first match:
    r,f,m >= 4 champions; r,f >= 3 loyal_customers; r >= 3
    potential_loyalists; f >= 3 at_risk; else hibernating."""
    t = customer_totals(purchases)
    cid = F.col("customer_id").asc()
    t = global_ntile(t, [F.col("last_order_date").asc(), cid], 5, "r")
    t = global_ntile(t, [F.col("order_count").asc(), cid], 5, "f")
    t = global_ntile(t, [F.col("total_spent").asc(), cid], 5, "m")
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    seg = (F.when((r >= 4) & (f >= 4) & (m >= 4), "champions").when((r >= 3) & (f >= 3), "loyal_customers")
           .when(r >= 3, "potential_loyalists").when(f >= 3, "at_risk").otherwise("hibernating"))
    return t.withColumn("segment", seg)


def rfm_segments(purchases: DataFrame) -> DataFrame:
    return rfm_scores(purchases).groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("total_spent").alias("avg_monetary"))


def customer_ltv(purchases: DataFrame) -> DataFrame:
    """Mean over customers of their total amount."""
    t = purchases.groupBy("customer_id").agg(F.sum("amount").alias("ltv"))
    return t.agg(F.count(F.lit(1)).alias("customers"), F.avg("ltv").alias("avg_customer_ltv"),
                 F.sum("ltv").alias("total_revenue"))


def executive_kpis(purchases: DataFrame) -> DataFrame:
    """Last full month = the month before the month of the latest order.
    Revenue growth % of it over the month before; revenue per new
    customer (first order in that month); recurring revenue = mean
    monthly revenue of the last three full months."""
    p = purchases.withColumn("m", month_index(F.col("order_date")))
    lf = p.agg(F.max("m") - 1).scalar()
    monthly = p.groupBy("m").agg(F.sum("amount").alias("rev"))
    first = p.groupBy("customer_id").agg(F.min("m").alias("fm"))
    new = first.groupBy(F.col("fm").alias("m")).agg(F.count(F.lit(1)).alias("new_customers"))
    j = monthly.join(new, "m", "left").withColumn("lf", lf)
    k = j.agg(F.max(F.when(F.col("m") == F.col("lf"), F.col("rev"))).alias("_cur"),
              F.max(F.when(F.col("m") == F.col("lf") - 1, F.col("rev"))).alias("_prev"),
              F.max(F.when(F.col("m") == F.col("lf"), F.col("new_customers"))).alias("_new"),
              F.avg(F.when(F.col("m").between(F.col("lf") - 2, F.col("lf")), F.col("rev"))).alias("_rec"),
              F.max("lf").alias("_lf"))
    return k.select(
        F.format_string("%04d-%02d", (F.col("_lf") / 12).cast("int"), F.col("_lf") % 12 + 1).alias("month"),
        F.col("_cur").alias("monthly_revenue"),
        (safe_div(F.col("_cur") - F.col("_prev"), "_prev") * 100.0).alias("revenue_growth_percent"),
        safe_div("_cur", "_new").alias("revenue_per_new_customer"),
        F.col("_rec").alias("recurring_revenue"))


def experiment_significance(touches: DataFrame, z_crit: float = 1.96) -> DataFrame:
    """Arms A/B = user_id % 2 (0/1); per channel the Welch z of the mean
    value of B against A; significant when |z| > z_crit."""
    arm = F.col("user_id") % 2
    g = touches.groupBy("channel").agg(
        *[x for a in (0, 1) for x in (
            F.count_if(arm == a).alias(f"n_{a}"),
            F.avg(F.when(arm == a, F.col("value"))).alias(f"mean_{a}"),
            F.var_samp(F.when(arm == a, F.col("value"))).alias(f"var_{a}"))])
    se = F.sqrt(safe_div("var_0", "n_0") + safe_div("var_1", "n_1"))
    z = safe_div(F.col("mean_1") - F.col("mean_0"), se)
    return g.select("channel", F.col("n_0").alias("n_a"), F.col("n_1").alias("n_b"),
                    F.col("mean_0").alias("mean_a"), F.col("mean_1").alias("mean_b"),
                    z.alias("z_score"), (F.abs(z) > z_crit).alias("significant"))

