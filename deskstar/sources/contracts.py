"""Column contracts: presence, optional columns, coercion report, flattening and renaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A table does not have the columns a job needs."""


def quoted(name: str) -> Column:
    """Reference to a column whose name may contain dots."""
    return F.col(f"`{name}`")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ContractError(f"missing columns: {absent}")
    return df


def _coerced(name: str, to: T.DataType) -> Column:
    source = quoted(name)
    if isinstance(to, (T.TimestampType, T.DateType)):
        return F.try_to_timestamp(source.cast("string")).cast(to)
    return source.try_cast(to)


def contract_check(df: DataFrame, contract: T.StructType, strict: bool = True) -> DataFrame:
    """Per contract column: presence, filled values and values that do not coerce to its type.

    One aggregation over the data. In strict mode an absent column is an error.
    """
    absent = missing_columns(df, contract.names)
    if strict and absent:
        raise ContractError(f"missing columns: {absent}")

    def report(field: T.StructField) -> Column:
        zero = F.lit(0).cast("bigint")
        if field.name in absent:
            filled, bad = zero, zero
        else:
            source = quoted(field.name)
            filled = F.count(source)
            bad = F.count_if(source.isNotNull() & _coerced(field.name, field.dataType).isNull())
        return F.struct(
            F.lit(field.name).alias("coluna"),
            F.lit(field.name not in absent).alias("presente"),
            filled.alias("preenchidos"),
            bad.alias("invalidos"),
        )

    return df.agg(F.array(*[report(f) for f in contract.fields]).alias("r")).select(F.inline("r"))


def align_optional_columns(
    df: DataFrame,
    contract: T.StructType,
    defaults: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Columns of the contract, in its order; absent ones become NULL or their default.

    Technical columns named in ``carry`` follow if the frame has them.
    """
    defaults = defaults or {}
    present = set(df.columns)

    def pick(field: T.StructField) -> Column:
        if field.name in present:
            return quoted(field.name)
        return F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in contract.fields], *[c for c in carry if c in present])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns coerced to the contract types, bad values become NULL."""
    return df.select(*[_coerced(f.name, f.dataType).alias(f.name) for f in contract.fields])


def flatten_json(df: DataFrame, sep: str = ".", keep: Sequence[str] = ()) -> DataFrame:
    """Nested structs to top-level columns named by their path; ``keep`` stays as it is."""

    def leaves(struct: T.StructType, path: tuple[str, ...] = ()):
        for field in struct.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType) and field.name not in keep:
                yield from leaves(field.dataType, here)
            else:
                yield here

    def reference(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{part}`" for part in path)).alias(sep.join(path))

    return df.select(*[reference(p) for p in leaves(df.schema)])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def lower_names(df: DataFrame) -> DataFrame:
    return rename_columns(df, {c: c.lower() for c in df.columns})
