"""Dates, durations and calendar attributes as Column expressions (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import vocab
from deskstar.functions.text import dict_lookup, strip


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text or timestamp to an instant; anything else is NULL."""
    return F.try_to_timestamp(strip(c.cast("string")))


def normalise_date(c: Column) -> Column:
    return F.date_format(parse_timestamp(c), "yyyy-MM-dd")


def to_day(c: Column) -> Column:
    return parse_timestamp(c).cast("date")


def resolution_hours(created: Column, updated: Column) -> Column:
    """Elapsed hours to two decimals, half up from exact microseconds; negative is NULL."""
    micros = F.unix_micros(updated) - F.unix_micros(created)
    hours = micros.cast("decimal(20,0)") / F.lit(3_600_000_000).cast("decimal(10,0)")
    return F.when(micros >= 0, F.round(hours, 2).cast("decimal(12,2)"))


def acted_flag(created: Column, updated: Column, negative: str = "nao") -> Column:
    return F.when(updated > created, "sim").otherwise(negative)


def flag_to_int(c: Column) -> Column:
    return dict_lookup(vocab.ACTED_FLAGS, F.lower(c)).cast("smallint")


def parse_month(c: Column) -> Column:
    """``MM/YYYY`` (one-digit months too) to YYYYMM."""
    instant = F.try_to_timestamp(strip(c.cast("string")), F.lit("M/yyyy"))
    return (F.year(instant) * 100 + F.month(instant)).cast("int")


def yyyymm_to_date(c: Column) -> Column:
    """First day of a YYYYMM month; an impossible month is NULL."""
    year = F.floor(c / 100).cast("int")
    month = F.pmod(c, F.lit(100)).cast("int")
    valid = month.between(1, 12) & year.between(1, 9999)
    # The branch guards make_date, which fails on bad parts under ANSI.
    return F.when(valid, F.make_date(year, month, F.lit(1)))


def day_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in vocab.MONTH_NAMES]), F.month(day))


def calendar_attributes(days: DataFrame, day: str = "data_completa") -> DataFrame:
    """One time-dimension row per input day."""
    d = F.col(day)
    return days.select(
        day_key(d).alias("sk_tempo"),
        d.alias("data_completa"),
        F.year(d).cast("smallint").alias("ano"),
        F.month(d).cast("smallint").alias("mes"),
        F.dayofmonth(d).cast("smallint").alias("dia"),
        month_key(d).alias("anomes"),
        month_name(d).alias("nome_mes"),
        F.quarter(d).cast("smallint").alias("trimestre"),
        F.when(F.month(d) <= 6, 1).otherwise(2).cast("smallint").alias("semestre"),
    )
