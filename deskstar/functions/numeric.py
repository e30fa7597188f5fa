"""Number coercion, rounding and threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import vocab

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def normalise_number(c: Column) -> Column:
    """Number text without blanks to double; blank or unparsable text is NULL.

    The pattern test keeps out the Java float suffixes that a plain cast would accept.
    """
    text = F.regexp_replace(c.cast("string"), r"(?U)\s", "")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Coerce the listed columns, bad values become NULL."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: (
                normalise_number(F.col(name)) if types[name] == "string" else F.col(name)
            ).try_cast(to)
            for name in cols
        }
    )


def exact_mean(total: Column, count: Column, scale: int = 2) -> Column:
    """total / count rounded half up, from a wide decimal so the mean is not rounded twice."""
    mean = total.cast("decimal(38,10)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return F.round(mean, scale).cast(f"decimal(14,{scale})")


def availability_label(pct: Column) -> Column:
    label = F.lit(vocab.AVAILABILITY_DEFAULT)
    for bound, text in reversed(vocab.AVAILABILITY_LABELS):
        label = F.when(pct < bound, text).otherwise(label)
    return label


def growth_label(delta: Column) -> Column:
    label = F.lit(vocab.GROWTH_DEFAULT)
    for bound, text in reversed(vocab.GROWTH_LABELS):
        label = F.when(delta > bound, text).otherwise(label)
    return label


def case_buckets(
    df: DataFrame, pct: str = "disponibilidade_pct", delta: str = "delta_1_mes"
) -> DataFrame:
    """Add the availability and growth labels."""
    return df.withColumns(
        {
            "status_disponibilidade": availability_label(F.col(pct)),
            "status_capacity": growth_label(F.col(delta)),
        }
    )
