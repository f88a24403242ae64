"""Data-quality scores and the stop-on-failure gate.

All scores are global aggregates: one partial aggregate per input
partition, then a single tiny final step. Nothing is collected except the
one-row status the gate reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.semantics import np_round, safe_div
from postlens.operators.common import side_by_side


def _present(df: DataFrame, name: str) -> Column:
    """1 when the cell is present: not null, and not NaN for floating types."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    ok = c.isNotNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        ok = ok & ~F.isnan(c)
    return ok.cast("long")


def completeness_expr(df: DataFrame) -> Column:
    """Present cells / all cells * 100 (pandas ``notna().sum().sum()/size``)."""
    present = reduce(lambda a, b: a + b, [F.sum(_present(df, c)) for c in df.columns])
    return safe_div(present, F.count(F.lit(1)) * F.lit(len(df.columns))) * 100.0


def column_completeness(df: DataFrame, table_name: str) -> DataFrame:
    return df.agg(completeness_expr(df).alias("completeness_percent")).select(
        F.lit(table_name).alias("table_name"), "completeness_percent")


def positive_duration_share(deliveries: DataFrame, col: str = "delivery_duration_minutes") -> DataFrame:
    """Share of rows with a positive duration, in %."""
    return deliveries.agg(
        (safe_div(F.count_if(F.col(col) > 0), F.count(F.lit(1))) * 100.0).alias("business_rules_score"))


def mean_range_score(deliveries: DataFrame, col: str = "delivery_duration_minutes",
                     lo: float = 30.0, hi: float = 150.0) -> DataFrame:
    """95 when lo <= mean <= hi (inclusive), else 75."""
    m = F.avg(col)
    return deliveries.agg(m.alias("mean_duration"),
                          F.when(m.between(lo, hi), 95.0).otherwise(75.0).alias("anomaly_score"))


def quality_report(deliveries: DataFrame, departments: DataFrame, ds: str) -> DataFrame:
    """Mean of four scores; each rounded 2; status by the unrounded mean:
    >= 90 PASS, >= 80 WARNING, else FAIL."""
    a = deliveries.agg(completeness_expr(deliveries).alias("cc"),
                       (safe_div(F.count_if(F.col("delivery_duration_minutes") > 0), F.count(F.lit(1))) * 100.0)
                       .alias("br"),
                       F.when(F.avg("delivery_duration_minutes").between(30.0, 150.0), 95.0)
                       .otherwise(75.0).alias("an"))
    b = departments.agg(completeness_expr(departments).alias("dc"))
    row = side_by_side(a, b)
    overall = (F.col("cc") + F.col("dc") + F.col("br") + F.col("an")) / 4.0
    return row.select(
        F.lit(ds).cast("date").alias("execution_date"),
        np_round("cc", 2).alias("courier_completeness"),
        np_round("dc", 2).alias("department_completeness"),
        np_round("br", 2).alias("business_rules_score"),
        np_round("an", 2).alias("anomaly_score"),
        np_round(overall, 2).alias("overall_quality_score"),
        F.when(overall >= 90, "PASS").when(overall >= 80, "WARNING").otherwise("FAIL").alias("status"))


class QualityGateError(ValueError):
    """Raised when the quality report's status is FAIL."""


def quality_gate(report: DataFrame) -> DataFrame:
    """Stop the run on FAIL. Reads the one-row status only."""
    row = report.select("status", "overall_quality_score").first()
    if row is not None and row["status"] == "FAIL":
        raise QualityGateError(f"Data quality check failed with score {row['overall_quality_score']}")
    return report


def _check(name: str, score: Column, pass_above: float, otherwise: str, label: str) -> list[Column]:
    return [F.lit(name).alias("check_name"), score.alias("score"),
            F.when(score > pass_above, "PASS").otherwise(otherwise).alias("status"),
            F.format_string(f"{label}: %.2f%%", score * 100.0).alias("details")]


def quality_checks(deliveries: DataFrame, routes: DataFrame) -> DataFrame:
    """Three checks as rows plus an ``overall`` row.

    completeness = share of present cells of deliveries (> .95 PASS else
    WARNING); route accuracy = mean of ``is_valid_route`` (> .90 PASS else
    FAIL); timestamp consistency = share of deliveries with issue >= receive
    (> .95 PASS else WARNING). Overall = mean, rounded 3; > .92 PASS,
    > .85 WARNING, else FAIL (on the unrounded mean).
    """
    d = deliveries.agg(
        (completeness_expr(deliveries) / 100.0).alias("comp"),
        safe_div(F.count_if(F.col("issue_datetime") >= F.col("receive_datetime")), F.count(F.lit(1))).alias("cons"))
    r = routes.agg(F.avg(F.col("is_valid_route").cast("double")).alias("acc"))
    one = side_by_side(d, r)  # each input is read once
    rows = F.array(
        F.struct(*_check("delivery_data_completeness", F.col("comp"), 0.95, "WARNING", "Delivery records completeness")),
        F.struct(*_check("route_validation_accuracy", F.col("acc"), 0.90, "FAIL", "Route validation accuracy")),
        F.struct(*_check("timestamp_consistency", F.col("cons"), 0.95, "WARNING", "Timestamp consistency")))
    m = (F.col("comp") + F.col("acc") + F.col("cons")) / 3.0
    overall = F.struct(F.lit("overall").alias("check_name"), np_round(m, 3).alias("score"),
                       F.when(m > 0.92, "PASS").when(m > 0.85, "WARNING").otherwise("FAIL").alias("status"),
                       F.format_string("Overall score: %.2f%%", m * 100.0).alias("details"))
    return one.select(F.inline(F.array_append(rows, overall)))

