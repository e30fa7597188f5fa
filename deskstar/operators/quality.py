"""Data-quality checks: profiles, keys, constraints, domains and layer reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.operators.joins import small
from deskstar.sources.contracts import quoted


class QualityError(ValueError):
    """A check failed in strict mode."""


def top_examples(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """First ``k`` distinct values in order."""
    return df.select(*cols).distinct().orderBy(*cols).limit(k)


def _examples(df: DataFrame, cols: Sequence[str], k: int = 5) -> list[dict]:
    return [r.asDict() for r in df.select(*cols).limit(k).collect()]


# --- profiles ------------------------------------------------------------------------------------
def _percent(part: Column, total: Column) -> Column:
    share = part.cast("decimal(20,0)") * 100 / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    return F.round(share, 2).cast("decimal(5,2)")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows and percentage of NULLs, worst first. One aggregation over the data."""
    total = F.count(F.lit(1))
    cells = [
        F.struct(
            F.lit(c).alias("coluna"),
            total.alias("linhas"),
            _percent(F.count_if(quoted(c).isNull()), total).alias("pct_nulos"),
        )
        for c in df.columns
    ]
    profile = df.agg(F.array(*cells).alias("r")).select(F.inline("r"))
    return profile.orderBy(F.desc("pct_nulos"), "coluna")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows that repeat an earlier key; NULL keys count as one group."""
    groups = df.groupBy(quoted(key).alias("_k")).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return groups.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicados"))


# --- keys ----------------------------------------------------------------------------------------
def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")


def require_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return the frame, or fail with examples of repeated keys."""
    bad = _examples(repeated_keys(df, keys), [*keys, "linhas"])
    if bad:
        raise QualityError(f"key {list(keys)} is not unique, for example {bad}")
    return df


def check_unique(tables: Mapping[str, DataFrame], uniques=schemas.UNIQUE_KEYS) -> DataFrame:
    """Per table: rows, distinct keys with repeats, and rows too many."""

    def one(table: str, keys: Sequence[str]) -> DataFrame:
        # A UNIQUE constraint does not bind rows with a NULL part.
        filled = tables[table].dropna(subset=list(keys))
        return (
            repeated_keys(filled, keys)
            .agg(
                F.count(F.lit(1)).alias("chaves_repetidas"),
                F.coalesce(F.sum(F.col("linhas") - 1), F.lit(0)).alias("linhas_excedentes"),
            )
            .select(F.lit(table).alias("tabela"), F.lit(",".join(keys)).alias("chave"), "*")
        )

    return _stack([one(t, k) for t, k in uniques.items() if t in tables])


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# --- periods and surrogate keys --------------------------------------------------------------------
def split_invalid_period(df: DataFrame, period: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a period, rows without one)."""
    return df.where(F.col(period).isNotNull()), df.where(F.col(period).isNull())


def _fail_where(df: DataFrame, bad: Column, message: Column, carrier: str) -> DataFrame:
    """The frame with a check in its plan: the job that computes ``carrier`` fails on a bad row.

    The check costs no extra pass and stops the job before anything is committed.
    """
    value = F.when(bad, F.raise_error(message)).otherwise(F.col(carrier))
    return df.withColumn(carrier, value)


def reject_invalid_period(
    df: DataFrame, period: str, source: str, mode: str = "strict"
) -> DataFrame:
    """Rows whose month parses. In strict mode any other row fails the job and is named."""
    if mode != "strict":
        return split_invalid_period(df, period)[0]
    value = F.coalesce(F.col(source).cast("string"), F.lit("NULL"))
    message = F.concat(F.lit(f"invalid value in {source}: "), value)
    return _fail_where(df, F.col(period).isNull(), message, period)


def unresolved_counts(fact: DataFrame, mandatory: Mapping[str, str]) -> DataFrame:
    """Rows per mandatory surrogate key that did not resolve, in one aggregation."""
    cells = [
        F.struct(
            F.lit(sk).alias("chave"),
            F.lit(source).alias("origem"),
            F.count_if(F.col(sk).isNull()).alias("nao_resolvidas"),
        )
        for sk, source in mandatory.items()
    ]
    return fact.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def require_resolved_sk(
    fact: DataFrame, mandatory: Mapping[str, str], mode: str = "strict"
) -> tuple[DataFrame, DataFrame]:
    """(rows whose mandatory keys all resolved, the other rows with the name of the first gap).

    In strict mode the first frame fails the job that computes it on a row of the second kind.
    """
    gap = F.lit(None).cast("string")
    for sk in reversed(list(mandatory)):
        gap = F.when(F.col(sk).isNull(), F.lit(sk)).otherwise(gap)
    marked = fact.withColumn("chave_ausente", gap)
    bad = marked.where(F.col("chave_ausente").isNotNull())
    if mode != "strict":
        return marked.where(F.col("chave_ausente").isNull()).drop("chave_ausente"), bad
    origin = F.to_json(F.struct(*dict.fromkeys(mandatory.values())))
    message = F.concat(F.lit("unresolved "), gap, F.lit(" from "), origin)
    checked = fact
    for sk in mandatory:
        checked = _fail_where(checked, F.col(sk).isNull(), message, sk)
    return checked, bad


# --- constraints -----------------------------------------------------------------------------------
def check_constraints(tables: Mapping[str, DataFrame], checks=schemas.CHECKS) -> DataFrame:
    """Violations per CHECK constraint, one aggregation per table; NULL passes."""

    def one(table: str, rules: Mapping[str, str]) -> DataFrame:
        cells = [
            F.struct(
                F.lit(table).alias("tabela"),
                F.lit(name).alias("regra"),
                F.count_if(~F.expr(predicate)).alias("violacoes"),
            )
            for name, predicate in rules.items()
        ]
        return tables[table].agg(F.array(*cells).alias("r")).select(F.inline("r"))

    return _stack([one(t, rules) for t, rules in checks.items() if t in tables])


def check_foreign_keys(
    tables: Mapping[str, DataFrame], keys=schemas.FOREIGN_KEYS, parent_keys: Mapping[str, str] | None = None
) -> DataFrame:
    """Orphans per foreign key: (table, column, rows without a parent, NULLs where not allowed).

    The key columns of a table are unpivoted in the scan and counted per value before the shuffle,
    so one pass serves all foreign keys and a hot key travels once per task.
    """

    def counted(table: str, foreign) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(
                    F.lit(column).alias("coluna"),
                    F.lit(dim).alias("dimensao"),
                    F.lit(nullable).alias("anulavel"),
                    F.col(column).cast("bigint").alias("valor"),
                )
                for column, dim, nullable in foreign
            ]
        )
        return (
            tables[table].select(F.inline(pairs))
            .groupBy("coluna", "dimensao", "anulavel", "valor").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(table).alias("tabela"), "*")
        )

    parent_keys = parent_keys or {t: sk for t, (sk, _) in schemas.DIMENSION_KEYS.items()}
    used = {dim for foreign in keys.values() for _, dim, _ in foreign}
    parents = _stack(
        [
            tables[dim].select(
                F.lit(dim).alias("dimensao"),
                F.col(parent_keys[dim]).cast("bigint").alias("valor"),
                F.lit(True).alias("pai"),
            ).distinct()
            for dim in sorted(used)
        ]
    )
    values = _stack([counted(t, f) for t, f in keys.items() if t in tables])
    side = F.broadcast(parents) if small(parents) else parents
    matched = values.join(side, ["dimensao", "valor"], "left")
    orphan = F.col("valor").isNotNull() & F.col("pai").isNull()
    return matched.groupBy("tabela", "coluna", "dimensao").agg(
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orfaos"),
        F.sum(
            F.when(F.col("valor").isNull() & ~F.col("anulavel"), F.col("n")).otherwise(0)
        ).alias("nulos_indevidos"),
    )


# --- domains and conformity ------------------------------------------------------------------------
def domain_check(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct values outside the expected list, with their row count. NULL is not a value."""
    value = quoted(column).cast("string")
    return (
        df.where(value.isNotNull() & ~value.isin(*domain))
        .groupBy(value.alias("valor")).agg(F.count(F.lit(1)).alias("linhas"))
        .select(F.lit(column).alias("coluna"), "valor", "linhas")
    )


def dw_conformity(df: DataFrame, expected: Sequence[str] = vocab.AUDIT_COLUMNS) -> DataFrame:
    """Expected columns: present with the percentage of NULLs, or missing."""
    total = F.count(F.lit(1))
    cells = []
    for name in expected:
        present = name in df.columns
        share = _percent(F.count_if(quoted(name).isNull()), total) if present else F.lit(None)
        cells.append(
            F.struct(
                F.lit(name).alias("coluna"),
                F.lit("OK" if present else "FALTANDO").alias("situacao"),
                share.cast("decimal(5,2)").alias("pct_nulos"),
            )
        )
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def layer_difference(
    staging: DataFrame, curated: DataFrame, staging_key: str, curated_key: str
) -> DataFrame:
    """Ids held by one layer only. Both layers are folded by id in a single shuffle."""

    def side(df: DataFrame, key: str, flag: int) -> DataFrame:
        return df.select(
            quoted(key).cast("string").alias("id"),
            F.lit(flag).alias("s"),
            F.lit(1 - flag).alias("c"),
        )

    both = side(staging, staging_key, 1).unionAll(side(curated, curated_key, 0))
    seen = both.where("id is not null").groupBy("id").agg(F.max("s").alias("s"), F.max("c").alias("c"))
    return seen.where("s <> c").select(
        "id", F.when(F.col("s") == 1, "staging").otherwise("curated").alias("somente_em")
    )


def layer_reconciliation(
    staging: DataFrame, curated: DataFrame, staging_key: str, curated_key: str
) -> DataFrame:
    """Row counts of both layers and the number of ids only in one of them."""

    def count(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("valor")).select(F.lit(label).alias("medida"), "valor")

    only = layer_difference(staging, curated, staging_key, curated_key).agg(
        F.count_if(F.col("somente_em") == "staging").alias("st"),
        F.count_if(F.col("somente_em") == "curated").alias("cu"),
    )
    pairs = F.array(
        F.struct(F.lit("ids_apenas_staging").alias("medida"), F.col("st").alias("valor")),
        F.struct(F.lit("ids_apenas_curated").alias("medida"), F.col("cu").alias("valor")),
    )
    return _stack(
        [
            count(staging, "linhas_staging"),
            count(curated, "linhas_curated"),
            only.select(F.inline(pairs)),
        ]
    )


def audit_report(
    staging: DataFrame,
    curated: DataFrame,
    staging_key: str = "id",
    curated_key: str = "id_ticket",
    domains: Mapping[str, Sequence[str]] = vocab.AUDIT_DOMAINS,
    expected: Sequence[str] = vocab.AUDIT_COLUMNS,
) -> dict[str, DataFrame]:
    """All parts of the layer audit. Columns that a layer lacks are reported, not assumed."""
    report = {
        "perfil_staging": null_profile(staging),
        "perfil_curated": null_profile(curated),
        "duplicados_staging": duplicate_count(staging, staging_key),
        "duplicados_curated": duplicate_count(curated, curated_key),
        "reconciliacao": layer_reconciliation(staging, curated, staging_key, curated_key),
        "diferenca": layer_difference(staging, curated, staging_key, curated_key),
        "conformidade": dw_conformity(curated, expected),
    }
    for column, domain in domains.items():
        if column in curated.columns:
            report[f"dominio_{column}"] = domain_check(curated, column, domain)
    return report


def audit_rows(report: Mapping[str, DataFrame]) -> DataFrame:
    """A report as one table: parte, item (the texts of a row), medida and valor, one row per number.

    A row without numbers counts as one ``linhas``.
    """

    def long(part: str, df: DataFrame) -> DataFrame:
        texts = [c for c, kind in df.dtypes if kind == "string"]
        numbers = [c for c in df.columns if c not in texts]
        cells = [F.struct(F.lit(c).alias("medida"), F.col(c).cast("decimal(20,2)").alias("valor")) for c in numbers]
        cells = cells or [F.struct(F.lit("linhas").alias("medida"), F.lit(1).cast("decimal(20,2)").alias("valor"))]
        return df.select(F.lit(part).alias("parte"), F.concat_ws("|", *texts).alias("item"), F.inline(F.array(*cells)))

    return _stack([long(part, df) for part, df in report.items()])


# --- lineage ---------------------------------------------------------------------------------------
def measured_status(
    spark: SparkSession, tables: Mapping[str, DataFrame], matrix=vocab.TRACEABILITY,
    mapping: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """Declared against measured status of every audited column.

    ``mapping`` names the stored column behind an audited one. Measured: OK without NULLs, PARCIAL
    with NULLs, NAO_ATENDIDO without a stored column. One aggregation per table.
    """
    mapping = mapping or {}
    parts = []
    for table in dict.fromkeys(t for t, _, _ in matrix):
        source = tables.get(table)
        cells = []
        for _, column, declared in [row for row in matrix if row[0] == table]:
            stored = mapping.get((table, column), column)
            if source is None or stored not in source.columns:
                measured = F.lit("NAO_ATENDIDO")
            else:
                some = F.count_if(F.col(stored).isNull()) > 0
                measured = F.when(some, "PARCIAL").otherwise("OK")
            cells.append(
                F.struct(
                    F.lit(table).alias("tabela_dw"),
                    F.lit(column).alias("coluna_dw"),
                    F.lit(declared).alias("declarado"),
                    measured.alias("medido"),
                )
            )
        base = spark.range(1) if source is None else source
        parts.append(base.agg(F.array(*cells).alias("r")).select(F.inline("r")))
    return _stack(parts)


def lineage_coverage(status: DataFrame) -> DataFrame:
    """Columns per table and measured status, and how many disagree with the declaration."""
    return status.groupBy("tabela_dw", F.col("medido").alias("status")).agg(
        F.count(F.lit(1)).alias("colunas"),
        F.count_if(F.col("medido") != F.col("declarado")).alias("divergentes"),
    )
