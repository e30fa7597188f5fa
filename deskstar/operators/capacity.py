"""Month-over-month capacity changes and calendar windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DELTA_MONTHS = (1, 2, 3, 6, 12)


def delta_name(months: int) -> str:
    return f"delta_{months}_mes" if months == 1 else f"delta_{months}_meses"


def capacity_deltas(
    sizes: DataFrame,
    server: str = "instancia",
    anomes: str = "anomes",
    size: str = "tamanho_gb",
    months: Sequence[int] = DELTA_MONTHS,
) -> DataFrame:
    """Size minus the size exactly n calendar months earlier; NULL where that month is missing.

    One row per (server, month). All distances are range frames over the same month number, so
    they share one shuffle and one sort, and a gap is never bridged.
    """
    month_number = F.floor(F.col(anomes) / 100) * 12 + F.pmod(F.col(anomes), F.lit(100))
    w = Window.partitionBy(server).orderBy("_m")

    def delta(n: int) -> Column:
        earlier = F.any_value(F.col(size)).over(w.rangeBetween(-n, -n))
        return (F.col(size) - earlier).alias(delta_name(n))

    numbered = sizes.withColumn("_m", month_number.cast("bigint"))
    return numbered.select(*sizes.columns, *[delta(n) for n in months])


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    if not 1 <= month <= 12:
        raise ValueError(f"month out of range: {month}")
    end = dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(year, month, 1), end


def windows_of_months(months: DataFrame, first_day: str) -> DataFrame:
    """Half-open 7-day windows of each month; the last one is cut at the end of the month."""
    first = F.col(first_day)
    end = F.add_months(first, 1)
    starts = F.sequence(first, F.date_sub(end, 1), F.expr("interval 7 days"))
    return months.select(F.explode(starts).alias("window_start"), end.alias("_end")).select(
        "window_start", F.least(F.date_add("window_start", 7), F.col("_end")).alias("window_end_excl")
    )


def month_week_windows(spark: SparkSession, year: int, month: int) -> DataFrame:
    """The windows of one month."""
    start, _ = month_bounds(year, month)
    return windows_of_months(spark.range(1).select(F.lit(start).alias("first")), "first")


def window_start(day: Column) -> Column:
    """Start of the 7-day window of its month that a day falls in: arithmetic, no join."""
    first = F.trunc(day, "MM")
    return F.date_add(first, (F.floor(F.datediff(day, first) / 7) * 7).cast("int"))


def bucket_into_weeks(df: DataFrame, day: Column) -> DataFrame:
    """Add the month window of each row of a dated table."""
    start = window_start(day)
    return df.withColumns(
        {
            "window_start": start,
            "window_end_excl": F.least(F.date_add(start, 7), F.add_months(F.trunc(day, "MM"), 1)),
        }
    )
