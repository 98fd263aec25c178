"""Time series: resampling, ranges, seasonality."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_range(spark: SparkSession, start: str, periods: int, step: str = "1 day", name: str = "ts") -> DataFrame:
    """Regular time points, made by tasks rather than one long array."""
    return spark.range(periods).select(
        F.expr(f"TIMESTAMP_NTZ '{start}' + id * INTERVAL '{step.split()[0]}' {step.split()[1].rstrip('s')}").alias(name)
    )


def resample(
    df: DataFrame, ts: str, rule: str, aggs: Mapping[str, Column], fill_gaps: bool = False, name: str = "period"
) -> DataFrame:
    """Aggregate per day, month, year ... (any ``date_trunc`` unit); gaps can be filled with NULL rows."""
    unit = rule.rstrip("s")
    period = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    out = df.groupBy(period.alias(name)).agg(*[c.alias(n) for n, c in aggs.items()])
    if not fill_gaps:
        return out
    bounds = df.agg(
        F.date_trunc(unit, F.min(ts)).cast("timestamp_ntz").alias("lo"),
        F.date_trunc(unit, F.max(ts)).cast("timestamp_ntz").alias("hi"),
    )
    step = {"quarter": "INTERVAL 3 MONTH"}.get(unit, f"INTERVAL 1 {unit}")
    periods = bounds.select(F.explode(F.expr(f"sequence(lo, hi, {step})")).alias(name))
    return periods.join(out, name, "left")


def seasonality(df: DataFrame, date: str, value: str) -> DataFrame:
    """Mean per year and month."""
    return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.avg(value).alias("mean"))
