"""Raw documents: ticket pages and monitoring feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskstar import schemas
from deskstar.functions.numeric import normalise_number
from deskstar.functions.temporal import parse_month
from deskstar.operators.dedupe import keep_first
from deskstar.sources.warehouse import Warehouse


def file_order() -> Column:
    """Order of rows in the source files, whatever the split order of the scan.

    The running id only compares rows of one block, where it grows with the file offset.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


CORRUPT, FILE = "_corrupt_record", "_arquivo"
REJECTS = "raw_tickets"


def as_text(schema: T.StructType) -> T.StructType:
    """The schema with every plain field as text, and a field for lines that do not parse."""
    fields = [f if isinstance(f.dataType, T.StructType) else T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def checked_lines(
    df: DataFrame, schema: T.StructType, mode: str = "strict", warehouse: Warehouse | None = None, key: str = "id"
) -> DataFrame:
    """Rows read ``as_text`` (and ``FILE``) with the types of ``schema``.

    A line that does not parse, or a value that is not of its type, fails the job in strict mode, whatever columns are read. In quarantine it is kept
    in ``warehouse.rejected("raw_tickets")``; its row goes on if the key is there.
    """
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if not isinstance(f.dataType, T.StructType)}
    faults = [F.when(F.col(CORRUPT).isNotNull(), F.lit("line"))]
    faults += [F.when(F.col(c).isNotNull() & value.isNull(), F.lit(c)) for c, value in typed.items()]
    reason = F.concat_ws(", ", *faults)
    if mode != "strict":
        if warehouse is None:
            raise ValueError("quarantine needs a warehouse for the rejects")
        warehouse.reject(df.where(reason != "").distinct(), REJECTS, [FILE], F.concat(F.lit("unreadable: "), reason))
        df = df.where((reason == "") | typed[key].isNotNull())
    else:
        message = F.concat(F.lit("unreadable "), reason, F.lit(" in "), F.coalesce(FILE, F.lit("?")), F.lit(": "),
                           F.left(F.coalesce(CORRUPT, F.to_json(F.struct(*typed))), F.lit(200)))
        # In a filter, so that the check stays whatever columns are read afterwards.
        df = df.where(F.when(reason != "", F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    # All at once, so that each fault is judged by the texts.
    return df.withColumns(typed).drop(CORRUPT, FILE)


def read_raw_tickets(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.RAW_TICKET,
    multi_line: bool = False,
    order_col: str | None = None,
    mode: str = "strict",
    warehouse: Warehouse | None = None,
) -> DataFrame:
    """Read JSON arrays of ticket objects. See ``checked_lines`` for lines that do not parse.

    By default each line holds one array (a landed result page) or one object, so files split
    across tasks. ``multi_line=True`` reads a pretty-printed array, one file per task.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.schema(as_text(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    df = lines.option("multiLine", multi_line).json(paths).withColumn(FILE, F.col("_metadata.file_path"))
    if order_col is None:
        return checked_lines(df, schema, mode, warehouse)
    order = file_order()
    return checked_lines(df.withColumn(order_col, order), schema, mode, warehouse)


def explode_items(df: DataFrame, items: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Array of structs to rows; ``pos`` is the place in the array."""
    exploded = df.select(*keep, F.posexplode(items).alias("pos", "item"))
    return exploded.select(*keep, "pos", "item.*")


def _monitoring_documents(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool
) -> DataFrame:
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    items = F.get(F.col("results"), 0).getField("items")
    checked = F.when(
        items.isNull(), F.raise_error(F.concat(F.lit("no results[0].items in "), F.col("arquivo")))
    ).otherwise(items)
    docs = docs.withColumn("arquivo", F.col("_metadata.file_path"))
    return explode_items(docs, checked, keep=("instancia", "host_name", "arquivo"))


def _default(column: str, value: str | None) -> Column:
    return F.coalesce(F.col(column), F.lit(value).cast("string"))


def read_raw_monitoring(
    spark: SparkSession,
    path: str,
    feed: str,
    instance: str | None = None,
    host_name: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Items of ``results[0].items`` as typed rows, one document per line or per file.

    ``feed`` is ``availability`` or ``volumetry``. A document without that path fails the job.
    ``instance`` and ``host_name`` stand in where the landed document does not carry its own.
    """
    if feed == "availability":
        items = _monitoring_documents(spark, path, schemas.RAW_AVAILABILITY, multi_line)
        return items.select(
            _default("instancia", instance).alias("INSTANCIA"),
            _default("host_name", host_name).alias("HOST_NAME"),
            parse_month(F.col("anomes")).alias("ANOMES"),
            normalise_number(F.col("disponibilidade_pct")).alias("DISPONIBILIDADE_PCT"),
            normalise_number(F.col("minutos_indisponiveis")).cast("int").alias("MINUTOS_INDISPONIVEIS"),
            "pos",
            "arquivo",
        )
    if feed == "volumetry":
        items = _monitoring_documents(spark, path, schemas.RAW_VOLUMETRY, multi_line)
        deltas = {"DELTA_1_MES": "diff_1m", "DELTA_3_MESES": "diff_3m",
                  "DELTA_6_MESES": "diff_6m", "DELTA_12_MESES": "diff_12m"}
        return items.select(
            F.col("db").alias("INSTANCIA"),
            _default("host_name", host_name).alias("HOST_NAME"),
            parse_month(F.col("mes")).alias("ANOMES"),
            normalise_number(F.col("gb_total")).alias("TAMANHO_GB"),
            *[normalise_number(F.col(src)).alias(name) for name, src in deltas.items()],
            "pos",
            "arquivo",
        )
    raise ValueError(f"unknown feed {feed!r}")


def dedupe_landed_pages(
    pages: DataFrame,
    key: str = "id",
    order: Sequence[str] = ("window_start", "page", "pos"),
) -> DataFrame:
    """One row per ticket out of overlapping result pages: the first one seen."""
    return keep_first(pages, [key], [F.col(c) for c in order])
