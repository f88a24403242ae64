"""Report assembly: one-row summaries side by side, manifests, text
rendering (SURVEY §2.2, §2.4).

Summaries are global aggregates (one row each); they are combined by
``side_by_side`` (a union and one tiny aggregate), never by a cross join.
The text report is a long (section, metric, value) frame rendered with
``format_string`` and written by Spark; nothing passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.semantics import np_round, safe_div
from postlens.operators import quality as Q
from postlens.operators import views
from postlens.operators.common import side_by_side
from postlens.operators.model_store import ModelStore
from postlens.operators.sinks import model_manifest
from postlens.plans import params as P
from postlens.sources.standins import load


def analytics_views(spark: SparkSession, sf: str, ds: str) -> dict[str, DataFrame]:
    """The four executed views by their table names."""
    return {
        "courier_performance_view": views.courier_performance_view(load(spark, sf, "deliveries"), ds),
        "department_efficiency_view": views.department_efficiency_view(load(spark, sf, "departments"), ds),
        "transport_utilization_view": views.transport_utilization_view(load(spark, sf, "transport"), ds),
        "customer_satisfaction_view": views.customer_satisfaction_view(load(spark, sf, "feedback"), ds),
    }


def load_manifest(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per view: table name, row count, status; plus a total row.
    Each count is a global aggregate of its own plan."""
    per = reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit("SUCCESS").alias("status"))
        for name, df in frames.items()])
    total = per.agg(F.sum("row_count").alias("row_count")).select(
        F.lit("total_records").alias("table_name"), "row_count", F.lit("summary").alias("status"))
    return per.unionByName(total)


def daily_report(spark: SparkSession, sf: str, ds: str) -> DataFrame:
    """Quality, business metrics, margin and loaded view records in one row."""
    d, dep, fb = load(spark, sf, "deliveries"), load(spark, sf, "departments"), load(spark, sf, "feedback")
    q = Q.quality_report(d, dep, ds).select(
        "execution_date", "overall_quality_score", F.col("status").alias("quality_status"))
    b = views.business_metrics(d, dep, fb, ds, P.REVENUE_PER_DELIVERY, P.COST_PER_DELIVERY).drop("date")
    total = load_manifest(analytics_views(spark, sf, ds)).where(F.col("table_name") == "total_records") \
        .select(F.col("row_count").alias("total_view_records"))
    row = side_by_side(q, b, total)
    margin = safe_div(F.col("total_revenue_estimated") - F.col("operational_cost_estimated"),
                      "total_revenue_estimated") * 100.0
    return row.withColumn("profit_margin_percent", np_round(margin, 1))


def model_summary(store: ModelStore) -> DataFrame:
    """The current delivery-time and satisfaction models' scores, one row."""
    at = {"delivery_time": ("mae", "r2", "within_15_minutes"), "customer_satisfaction": ("accuracy", "precision")}
    return side_by_side(*[
        store.commits(name).orderBy(F.desc("seq"), F.desc("version")).limit(1)
        .agg(*[F.first(F.element_at("scores", k)).alias(f"{name}_{k}") for k in keys]) for name, keys in at.items()])


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Number and total size of the saved models, one row."""
    saved = F.col("status") == "SUCCESS"
    return manifest.agg(F.count_if(saved).alias("models_saved"), F.max(F.when(~saved, F.col("size_mb"))).alias("models_size_mb"))


def full_report(spark: SparkSession, sf: str, ds: str, store: ModelStore) -> DataFrame:
    """The five summaries side by side: quality, business metrics, loaded
    views, model scores and the model manifest."""
    return side_by_side(daily_report(spark, sf, ds), model_summary(store), manifest_summary(model_manifest(spark, store.root)))


def model_lines() -> list[tuple[str, str, Column]]:
    """Report lines of the model scores and the manifest; a score that is
    not defined (no row was predicted positive) shows as n/a."""
    shown = lambda form, c, value: F.when(F.col(c).isNotNull(), F.format_string(form, value)).otherwise("n/a")
    percent = lambda c: shown("%.1f%%", c, np_round(F.col(c) * 100.0, 1))
    number = lambda c, digits: shown(f"%.{digits}f", c, np_round(c, digits))
    return [
        ("models", "Delivery time MAE (minutes)", number("delivery_time_mae", 2)),
        ("models", "Delivery time R2", number("delivery_time_r2", 3)),
        ("models", "Delivery time within 15 minutes", percent("delivery_time_within_15_minutes")),
        ("models", "Satisfaction accuracy", percent("customer_satisfaction_accuracy")),
        ("models", "Satisfaction precision", percent("customer_satisfaction_precision")),
        ("manifest", "Models saved", F.col("models_saved").cast("string")),
        ("manifest", "Total size (MB)", number("models_size_mb", 2)),
    ]


def satisfaction_lines() -> list[tuple[str, str, Column]]:
    return [line for line in model_lines() if line[1].startswith("Satisfaction")]


def report_lines(report: DataFrame, more: list[tuple[str, str, Column]] = ()) -> DataFrame:
    """Long (section, metric, value) rows of the daily report, formatted as
    the text report shows them (thousands separators, one-decimal %), and
    the lines of ``more``."""
    r = report
    items = [
        ("quality", "Overall quality score", F.format_string("%.1f%%", np_round("overall_quality_score", 1))),
        ("quality", "Status", F.col("quality_status")),
        ("business", "Total deliveries", F.format_number(F.col("total_deliveries"), 0)),
        ("business", "Revenue", F.concat(F.lit("$"), F.format_number(F.col("total_revenue_estimated"), 2))),
        ("business", "Operational cost", F.concat(F.lit("$"), F.format_number(F.col("operational_cost_estimated"), 2))),
        ("business", "Profit margin", F.format_string("%.1f%%", np_round("profit_margin_percent", 1))),
        ("business", "On-time delivery rate", F.format_string("%.1f%%", np_round(F.col("on_time_delivery_rate") * 100.0, 1))),
        ("business", "Average satisfaction", F.format_string("%.2f", np_round("customer_satisfaction_avg", 2))),
        ("operations", "Active couriers", F.col("active_couriers").cast("string")),
        ("operations", "Active departments", F.col("active_departments").cast("string")),
        ("operations", "Cities covered", F.col("cities_covered").cast("string")),
        ("operations", "View records loaded", F.col("total_view_records").cast("string")),
        *more,
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("line_no"), F.lit(s).alias("section"), F.lit(m).alias("metric"),
                              v.alias("value")) for i, (s, m, v) in enumerate(items)])
    return r.select(F.inline(rows))


def write_text_report(report: DataFrame, path: str, more: list[tuple[str, str, Column]] = ()) -> None:
    """Render the report as text lines and write them (one file)."""
    lines = report_lines(report, more).select(
        "line_no", F.format_string("[%s] %s: %s", "section", "metric", "value").alias("value"))
    lines.coalesce(1).sortWithinPartitions("line_no").select("value").write.mode("overwrite").text(path)
