"""Edge rows of the date and number operators."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from deskstar.functions import numeric, temporal
from deskstar.operators.capacity import month_bounds, month_week_windows

C = F.col


def test_resolution_and_flag(values):
    base = "2024-01-01T00:00:00Z"
    rows = [(base, base, Decimal("0.00"), "nao"), (base, "2023-12-31T23:00:00Z", None, "nao"), (None, base, None, "nao"),
            (base, None, None, "nao"), (base, "2024-01-01T00:00:18Z", Decimal("0.01"), "sim"),
            (base, "2024-01-02T00:30:00Z", Decimal("24.50"), "sim")]
    c, u = temporal.parse_timestamp(C("c")), temporal.parse_timestamp(C("u"))
    data = [r[:2] for r in rows]
    assert values(data, "c string, u string", temporal.resolution_hours(c, u)) == [r[2] for r in rows]
    assert values(data, "c string, u string", temporal.acted_flag(c, u)) == [r[3] for r in rows]


def test_dates(values):
    rows = [("2024-02-30T00:00:00Z", None), ("2024-03-05T10:11:12Z", "2024-03-05"), ("lixo", None), (None, None), (" 2024-03-05 ", "2024-03-05")]
    assert values([(r[0],) for r in rows], "s string", temporal.normalise_date(C("s"))) == [r[1] for r in rows]


def test_months(values):
    rows = {"04/2026": 202604, "4/2026": 202604, "13/2026": None, " ": None, None: None, " 12/2025 ": 202512, "2026-04": None}
    assert values([(k,) for k in rows], "s string", temporal.parse_month(C("s"))) == list(rows.values())
    days = {202604: dt.date(2026, 4, 1), 202613: None, 202600: None, None: None, 0: None}
    assert values([(k,) for k in days], "s int", temporal.yyyymm_to_date(C("s"))) == list(days.values())


def test_numbers(values):
    rows = {"1 234.5": 1234.5, "": None, "abc": None, None: None, "1,5": None, "1d": None, "-2e3": -2000.0, ".5": 0.5}
    assert values([(k,) for k in rows], "s string", numeric.normalise_number(C("s"))) == list(rows.values())


def test_flags(values):
    rows = {"Sim": 1, "NÃO": 0, "nao": 0, "talvez": None, None: None}
    assert values([(k,) for k in rows], "s string", temporal.flag_to_int(C("s"))) == list(rows.values())


def test_labels(values):
    pct = {97.99: "Crítico", 98.0: "Atenção", 99.0: "Normal", None: "Normal"}
    assert values([(k,) for k in pct], "s double", numeric.availability_label(C("s"))) == list(pct.values())
    growth = {100.01: "Crescimento elevado", 100.0: "Crescimento moderado", 50.0: "Crescimento normal", None: "Crescimento normal"}
    assert values([(k,) for k in growth], "s double", numeric.growth_label(C("s"))) == list(growth.values())


def test_exact_mean_is_rounded_once(spark):
    row = spark.range(1).select(numeric.exact_mean(F.lit(Decimal("10049996.00")), F.lit(10_000_000)).alias("m")).first()
    assert row.m == Decimal("1.00")


def test_windows(spark):
    got = [tuple(r) for r in month_week_windows(spark, 2024, 2).orderBy("window_start").collect()]
    day = lambda d, m=2: dt.date(2024, m, d)
    assert got == [(day(1), day(8)), (day(8), day(15)), (day(15), day(22)), (day(22), day(29)), (day(29), day(1, 3))]
    assert month_bounds(2024, 12) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
