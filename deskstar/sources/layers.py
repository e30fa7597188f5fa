"""Lake layers as Parquet datasets partitioned by month, and delimited interchange files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskstar.sources.contracts import conform
from deskstar.sources.raw import file_order


def layer_path(root: str, layer: str, entity: str) -> str:
    return f"{root}/{layer}/{entity}"


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    entity: str,
    anomes: int | None = None,
    contract: T.StructType | None = None,
) -> DataFrame:
    """Read one month (partition pruning) or all months, coerced to the contract types."""
    df = spark.read.parquet(layer_path(root, layer, entity))
    if anomes is not None:
        df = df.where(F.col("anomes") == anomes)
    if contract is None:
        return df
    extra = [c for c in df.columns if c not in contract.names]
    carried = T.StructType([*contract.fields, *[df.schema[c] for c in extra]])
    return conform(df, carried)


def write_layer(df: DataFrame, root: str, layer: str, entity: str, anomes: int | None = None) -> str:
    """Replace the months present in ``df`` (or the given month) and leave the others alone."""
    path = layer_path(root, layer, entity)
    # Many months are gathered so that a month gets few files; one month needs no shuffle for that.
    df = df.hint("rebalance", "anomes") if anomes is None else df.withColumn("anomes", F.lit(anomes))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("anomes")
        .parquet(path)
    )
    return path


def read_delimited_auto(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_value: str | None = None,
    order_col: str | None = None,
    sep: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read a CSV written with commas, or with semicolons when commas give a single column.

    Only the header line is looked at to choose; give ``sep`` for a folder of mixed files. Quoted line breaks and doubled
    quotes are kept; without line breaks in quotes, ``multi_line=False`` lets Spark split large files.
    """
    if sep is None:
        header = spark.read.text(path).first()
        sep = "," if header and "," in header[0] else ";"
    reader = (
        spark.read.option("header", True).option("sep", sep).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"')
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = reader.csv(path)
    if order_col is not None:
        df = df.withColumn(order_col, file_order())
    if schema is None:
        return df
    present = T.StructType([f for f in schema.fields if f.name in df.columns])
    typed = conform(df, present) if order_col is None else conform(df, present.add(df.schema[order_col]))
    return typed


def load_stamp(file_name: Column) -> Column:
    """The YYYYMMDD_HHMMSS stamp in a file name, ``sem_stamp`` if there is none."""
    found = F.regexp_extract(file_name, r"(\d{8}_\d{6})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("sem_stamp"))


def load_lineage_columns(
    df: DataFrame, source: Column | None = None, load_ts: Column | None = None
) -> DataFrame:
    """Add source file, its stamp and the load time.

    Without ``source`` the frame must be a direct file scan, whose metadata names the file.
    """
    source = F.col("_metadata.file_path") if source is None else source
    return df.withColumns(
        {
            "arquivo_origem": source,
            "stamp": load_stamp(source),
            "data_carga": F.current_timestamp() if load_ts is None else load_ts,
        }
    )
