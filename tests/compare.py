"""Run queries next to their SQL twins: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows) -> list[tuple]:
    def cell(v):
        if isinstance(v, float):
            return repr(round(v, 9) + 0.0)
        return repr(str(v)) if v is not None else "~null"

    return sorted(tuple(cell(v) for v in r) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    """Differences in column names, types and values."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    quoted = ", ".join(f'"{n}"' for n in names)
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(described) != names:
        return [f"columns {names} != {sorted(described)}"]
    for n, t in df.dtypes:
        want = DUCK_TYPES.get(t, t.upper())
        if described[n] != want:
            problems.append(f"type of {n}: {t} != {described[n]}")
    theirs = con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    a, b = canonical(ours), canonical(theirs)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        shown = f"only ours {sorted(sa - sb)[:2]}; only twin {sorted(sb - sa)[:2]}"[:600]
        problems.append(f"values of {names}: {shown}")
    if not a:
        problems.append("no rows")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, twins = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in chosen or queries:
        start = time.time()
        try:
            problems = compare(spark, con, name, queries[name], twins[name], sf_dir)
        except Exception as error:  # noqa: BLE001  (report and go on)
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
