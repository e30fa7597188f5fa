"""Warehouse tables: external Parquet tables of the catalogue, stored in folders below one root.

Every load writes new folders and switches to them afterwards: the months of a partitioned table, or the whole of another,
get the new folder as their location. Readers go through the catalogue, so they see the old rows until the switch and never
a folder that is being written. A load that dies before its switch leaves the table as it was.

What the catalogue was switched to is also appended to ``trocas/<table>``, all months of a load in one small file, so that a
catalogue that forgets its tables at the end of a session, or one whose switches broke off, can be set up from the folder.
Folders that no table points to any more can be expired once no reader is left on them.

Two more things go into that record, so that loads need not read the months they do not touch. One is the last surrogate
key in use. The other is a summary of the month's keys: the blocks of 4,096 neighbouring ids that it holds, in
``resumos/<table>/<load>``. A month without a summary counts as holding every key, and a table whose last load did not
state its last key is searched for it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from deskstar import schemas
from deskstar.functions.temporal import month_key
from deskstar.functions.text import strip
from deskstar.session import fresh_path


def partition_value(table: str) -> Column:
    """Expression of the physical partition column of a table."""
    if table in ("fato_ticket", "fato_csi"):
        return F.floor(F.col("sk_tempo_criacao") / 100).cast("int")
    if table == "fato_tickets":
        return month_key(F.col("data_criacao"))
    return F.col(schemas.PARTITION[table])


NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
WHOLE = ""  # the place of a table without partitions
SWITCHES = "particao string, local string, carga string, resumo string, ultima bigint"
SUMMARY = "particao string, bloco bigint, carga string"
BLOCK_BITS = 12  # a block of ids is 4,096 wide
LOADED = "deskstar.carga"  # the load that the catalogue was last switched to


@dataclass(frozen=True)
class Recorded:
    """What the record of switches says: folder and summary of each partition, the last load and the last key it left."""

    folders: dict[str, str] = field(default_factory=dict)
    summaries: dict[str, tuple[str, str] | None] = field(default_factory=dict)
    load: str | None = None
    last_key: int | None = None


def own_schema(root: str) -> str:
    return "deskstar_" + hashlib.md5(root.encode()).hexdigest()[:12]


class Warehouse:
    """The star and the flat tables stored below ``root`` and declared in ``schema`` of the catalogue.

    Without a schema it is the one that ``create_star`` declared over this root in the session, else one named after the root.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schema = schema

    @property
    def schema(self) -> str:
        if self._schema:
            return self._schema
        own = own_schema(self.root)
        declared = self.spark.conf.get(f"deskstar.schema.{own}", own)
        return declared if self.spark.conf.get(f"deskstar.root.{declared}", None) == self.root else own

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def name(self, table: str) -> str:
        """Name of the table in the catalogue, which is set up from the folder where it does not know the table."""
        name = f"{self.schema}.{table}"
        if not self.spark.catalog.tableExists(name):
            self.declare(table)
        return name

    def declare(self, table: str) -> None:
        """Create the table in the catalogue, types and comments included, over the folders it was last switched to."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema} LOCATION '{self.root}/catalogo'")
        columns = ", ".join(_declared(field) for field in schemas.TABLE[table].fields)
        clause, month = "", schemas.PARTITION.get(table)
        if month:
            if month not in schemas.TABLE[table].names:
                columns += f", {month} INT COMMENT 'physical partition'"
            clause = f" PARTITIONED BY ({month})"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.schema}.{table} ({columns}) USING parquet{clause} "
                       f"LOCATION '{self.path(table)}/vazia'")
        details = {row[0]: row[1] for row in self.spark.sql(f"DESCRIBE FORMATTED {self.schema}.{table}").collect()}
        if f"{self.path(table)}/".removeprefix("file:") not in details["Location"]:
            raise ValueError(f"{self.schema}.{table} is declared over {details['Location']}, not below {self.root}")
        self.repair(table)

    def recorded(self, table: str) -> Recorded:
        """The last switch of each partition."""
        stored = self._parquet(f"{self.root}/trocas/{table}", SWITCHES)
        if stored is None:
            return Recorded()
        last = F.max_by(F.struct("local", "carga", "resumo", "ultima"), "carga")
        rows = stored.groupBy("particao").agg(last.alias("troca")).select("particao", "troca.*").collect()
        newest = max(rows, key=lambda row: row["carga"])
        return Recorded(
            {row["particao"]: row["local"] for row in rows},
            {row["particao"]: (row["resumo"], row["carga"]) if row["resumo"] else None for row in rows},
            newest["carga"], newest["ultima"],
        )

    def repair(self, table: str) -> None:
        """Bring the catalogue to the last recorded switches, for instance after some of them broke off."""
        recorded = self.recorded(table)
        self._switch(table, recorded.folders, recorded.load)

    def settled(self, table: str) -> Recorded:
        """The record, once the catalogue agrees with it: a load that broke off between the two is taken to its end."""
        name, recorded = self.name(table), self.recorded(table)
        properties = {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if recorded.load and properties.get(LOADED) != recorded.load:
            self._switch(table, recorded.folders, recorded.load)
        return recorded

    def _switch(self, table: str, folders: dict[str, str], load: str | None) -> None:
        """Point partitions, or the whole table, at their new folders."""
        name, month = f"{self.schema}.{table}", schemas.PARTITION.get(table)
        if WHOLE in folders:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folders[WHOLE]}'")
        elif folders:
            def spec(value: str) -> str:
                return f"PARTITION ({month}={'NULL' if value == NO_MONTH else value})"

            known = {row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
            known = {NO_MONTH if value in ("null", NO_MONTH) else value for value in known}
            added = " ".join(f"{spec(v)} LOCATION '{folder}'" for v, folder in folders.items() if v not in known)
            if added:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
            for value in folders.keys() & known:
                self.spark.sql(f"ALTER TABLE {name} {spec(value)} SET LOCATION '{folders[value]}'")
        if load:
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LOADED}' = '{load}')")
        self.spark.catalog.refreshTable(name)

    def _publish(
        self, table: str, load: str, folders: dict[str, str], summary: str | None = None, last_key: int | None = None
    ) -> None:
        """Record the folders of a finished load in one file, then switch to them."""
        if folders:
            rows = json.dumps([{"particao": value, "local": folder, "carga": load, "resumo": summary, "ultima": last_key}
                               for value, folder in folders.items()])
            record = F.inline(F.from_json(F.lit(rows), f"array<struct<{SWITCHES}>>"))
            self.spark.range(1, numPartitions=1).select(record).write.mode("append").parquet(f"{self.root}/trocas/{table}")
            self._switch(table, folders, load)

    def last_key(self, table: str, sk: str) -> int:
        """Greatest surrogate key in use, 0 in an empty table; rows are read only where the last load did not state it."""
        last = self.settled(table).last_key
        return self.physical(table).agg(F.coalesce(F.max(sk), F.lit(0))).first()[0] if last is None else last

    def _summarise(self, table: str, load: str, folder: str) -> str | None:
        """Store the blocks of ids that each month of a written folder holds; None for tables without such an id."""
        key, month = schemas.SUMMARISED.get(table), schemas.PARTITION[table]
        if key is None:
            return None
        narrow = T.StructType([schemas.TABLE[table][key], T.StructField(month, T.IntegerType())])
        rows = self.spark.read.schema(narrow).option("basePath", folder).parquet(folder).where(F.col(key).isNotNull())
        value = F.coalesce(F.col(month).cast("string"), F.lit(NO_MONTH)).alias("particao")
        blocks = rows.select(value, F.shiftright(key, BLOCK_BITS).alias("bloco")).distinct()
        path = f"{self.root}/resumos/{table}/{load}"
        blocks.withColumn("carga", F.lit(load)).write.parquet(path)
        return path

    def months_holding(self, table: str, keys: DataFrame) -> set[int | None]:
        """Months that may hold one of the ids (one column), judged by the summaries; no other month holds any."""
        summaries = self.settled(table).summaries
        months = {value for value, summary in summaries.items() if summary is None}
        known = {value: summary for value, summary in summaries.items() if summary is not None}
        if known:
            # A load's summary counts for the months that no later load has written; both lists are of calendar months.
            current = [f"{value}/{load}" for value, (_, load) in known.items()]
            blocks = self.spark.read.schema(SUMMARY).parquet(*sorted({path for path, _ in known.values()}))
            blocks = blocks.where(F.concat_ws("/", "particao", "carga").isin(current))
            asked = keys.select(F.shiftright(keys.columns[0], BLOCK_BITS).alias("bloco")).distinct()
            hits = blocks.join(asked, "bloco", "left_semi").select("particao").distinct().collect()
            months |= {row["particao"] for row in hits}
        return {None if value == NO_MONTH else int(value) for value in months}

    def _parquet(self, path: str, schema: str | T.StructType) -> DataFrame | None:
        """The files of a folder, or None where there is no such folder."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self, table: str) -> bool:
        """Whether any load has written the table."""
        name = self.name(table)
        if schemas.PARTITION.get(table):
            return bool(self.spark.sql(f"SHOW PARTITIONS {name}").take(1))
        return bool(self.spark.table(name).inputFiles())

    def physical(self, table: str) -> DataFrame:
        """The stored rows with the technical partition column, if any."""
        return self.spark.table(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.physical(table).select(*schemas.TABLE[table].names)

    def shape(self, df: DataFrame, table: str) -> DataFrame:
        """Columns of the table in declared order and type, absent ones as NULL."""
        present = set(df.columns)
        fields = schemas.TABLE[table].fields
        shaped = df.select(
            *[
                (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields
            ]
        )
        name = schemas.PARTITION.get(table)
        if name and name not in shaped.columns:
            shaped = shaped.withColumn(name, partition_value(table))
        return shaped

    def _writer(self, df: DataFrame, table: str):
        name = schemas.PARTITION.get(table)
        if name is None:
            return df.write
        # Few files per period without one task per period: large periods are split again.
        return df.hint("rebalance", name).write.partitionBy(name)

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write to a fresh shared folder and read back, so a table can replace what it was
        computed from, and a lost executor re-reads files instead of re-running the plan."""
        path = fresh_path(self.spark, f"stage-{label}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _load(self) -> str:
        """A name that no other load has; later loads have greater ones."""
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows. Months that get some are written anew with their old rows."""
        fresh, month = self.shape(df, table), schemas.PARTITION.get(table)
        name = self.name(table)
        if month is None:
            if not self.exists(table):
                self._whole(fresh, table)
            else:
                fresh.write.insertInto(name)
            return
        fresh = self.stage(fresh, table)
        touched = F.broadcast(fresh.select(month).distinct())  # months: calendar periods
        old = self.physical(table)
        old = old.join(touched, old[month].eqNullSafe(touched[month]), "left_semi")
        self.overwrite_partitions(old.select(*fresh.columns).unionByName(fresh), table)

    def _whole(self, df: DataFrame, table: str) -> None:
        self.name(table)
        load = self._load()
        folder = f"{self.path(table)}/{load}"
        df.write.parquet(folder)
        self._publish(table, load, {WHOLE: folder})

    def overwrite_partitions(
        self, df: DataFrame, table: str, emptied: Sequence[int | None] = (), last_key: int | None = None
    ) -> None:
        """Replace the partitions present in ``df``, and those of ``emptied`` by nothing, in one switch.

        ``df`` may read the partitions it replaces, since their files stay. ``last_key`` is the greatest surrogate key of
        the whole table afterwards, if the caller knows it.
        """
        self.name(table)
        load, month = self._load(), schemas.PARTITION[table]
        folder = f"{self.path(table)}/{load}"
        shaped = self.shape(df, table) if month not in df.columns else df
        self._writer(shaped, table).parquet(folder)
        # The months come from the names of the written files.
        rest = T.StructType([f for f in shaped.schema if f.name != month])
        files = self.spark.read.schema(rest).option("basePath", folder).parquet(folder).inputFiles()
        written = {part.split("=", 1)[1] for file in files for part in file.split("/") if part.startswith(f"{month}=")}
        folders = {value: f"{folder}/{month}={value}" for value in written}
        for value in (NO_MONTH if v is None else str(v) for v in emptied):
            if value not in folders:
                folders[value] = f"{folder}/vazia"
        self._publish(table, load, folders, self._summarise(table, load, folder), last_key)

    def clear_partition(self, table: str, value: int | None) -> None:
        """Leave a partition without rows."""
        load = self._load()
        self.name(table)
        self._publish(table, load, {NO_MONTH if value is None else str(value): f"{self.path(table)}/{load}/vazia"})

    def rejects_path(self, table: str) -> str:
        return f"{self.root}/rejeitados/{table}"

    def reject(self, df: DataFrame, table: str, keys: Sequence[str], reason: Column) -> None:
        """Keep the rows a load did not take: their key, why, the whole row as JSON and the time of the load."""
        df.select(
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("chave"), reason.alias("motivo"),
            F.to_json(F.struct(*df.columns)).alias("linha"), F.current_timestamp().alias("data_carga"),
        ).write.mode("append").parquet(self.rejects_path(table))

    def rejected(self, table: str) -> DataFrame:
        """The rows that loads of a table did not take; a row rejected again shows its last load only."""
        schema = "chave string, motivo string, linha string, data_carga timestamp"
        stored = self._parquet(self.rejects_path(table), schema)
        if stored is None:
            return self.spark.createDataFrame([], schema)
        return stored.groupBy("chave", "motivo", "linha").agg(F.max("data_carga").alias("data_carga"))

    def replace(self, df: DataFrame, table: str) -> None:
        """Rewrite a whole unpartitioned table, which ``df`` may read: the old files stay."""
        self._whole(self.shape(df, table), table)

    def read_dimension(self, table: str, casefold: bool = False) -> DataFrame:
        """Surrogate and natural key only; text keys trimmed, lower-cased on request."""
        sk, nk = schemas.DIMENSION_KEYS[table]
        key = F.col(nk)
        if schemas.TABLE[table][nk].dataType == T.StringType():
            key = strip(key)
        if casefold:
            key = F.lower(key)
        return self.read(table).select(sk, key.alias(nk))

    def publish_views(self, prefix: str = "") -> None:
        """Register every stored table as a temporary view."""
        for table in schemas.TABLE:
            if self.exists(table):
                self.read(table).createOrReplaceTempView(f"{prefix}{table}")


def append_table(df: DataFrame, warehouse: Warehouse, table: str) -> DataFrame:
    """Append rows to a table and return the table."""
    warehouse.append(df, table)
    return warehouse.read(table)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    """Append rows to a database table in batches, one connection per task."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **options).mode("append").save()


def _declared(field: T.StructField) -> str:
    comment = schemas.COMMENTS.get(field.name)
    return f"{field.name} {field.dataType.simpleString()}" + (f" COMMENT '{comment}'" if comment else "")


def create_star(spark: SparkSession, root: str, schema: str = "dw", tables=schemas.STAR_TABLES) -> Warehouse:
    """Declare the schema and its tables over a warehouse, before or after loads.

    From then on warehouses over this root load and read these tables, so later loads show at once.
    """
    root = root.rstrip("/")
    spark.conf.set(f"deskstar.schema.{own_schema(root)}", schema)
    spark.conf.set(f"deskstar.root.{schema}", root)
    warehouse = Warehouse(spark, root, schema)
    for table in tables:
        warehouse.declare(table)
    return warehouse


def drop_star(spark: SparkSession, schema: str = "dw") -> None:
    """Drop facts, then dimensions; other tables of the schema and all files stay."""
    for table in reversed(schemas.STAR_TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{table}")
    spark.conf.unset(f"deskstar.root.{schema}")
