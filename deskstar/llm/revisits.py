"""WARC: resolve not-modified revisits to the latest earlier full response of the same canonical URL.

The as-of join is a running last full response in two steps, per stretch of time and inside it, so a URL that holds much
of the archive is spread over its stretches. Bodies are not moved: a revisit gets the id of its response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEPT_FROM_REVISIT = ("date", "etag", "last-modified", "expires", "cache-control", "vary", "content-location")


def canonical(url: Column) -> Column:
    """Without fragment and the scheme's own default port, scheme and host in lower case, an empty path as a slash (also before a query)."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    head = F.lower(F.regexp_extract(plain, "^([a-zA-Z]+://[^/?]*)", 1))
    head = F.regexp_replace(head, "^(http://.*):80$|^(https://.*):443$", "$1$2")
    rest = F.regexp_extract(plain, "^[a-zA-Z]+://[^/?]*(.*)$", 1)
    return F.when(head == "", plain).otherwise(F.concat(head, F.when((rest == "") | rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)))


def resolve(records: DataFrame, stretch: int = 10_000) -> DataFrame:
    """Columns id, response_id and headers of each row of ``records`` (id, url, at long, revisit, etag, headers map,
    and last_modified where the table has it).

    A full response is its own. A revisit takes the latest full response of its URL before it (by ``at``, then id) if both
    have the same etag, compared weakly, or, where one of them has none, the same last_modified; else, and with a null URL
    or time, it stays unresolved (null). Headers of a
    resolved revisit are the response's, replaced by those that a not-modified answer may update; names compare without
    case and keep the spelling of the row that they come from. Among responses of one time the greatest id is the latest,
    and of repeated rows that share time and id any one counts. Rows with a null
    ``revisit`` count as full. Repeated rows stay. Other columns are ignored. An empty table gives an empty table.
    """
    weak = F.regexp_replace("etag", "^W/", "")
    modified = F.col("last_modified") if "last_modified" in records.columns else F.lit(None).cast("string")
    rows = records.select("id", canonical(F.col("url")).alias("key"), F.col("at").cast("long").alias("at"),
                          F.coalesce("revisit", F.lit(False)).alias("revisit"), weak.alias("etag"),
                          modified.alias("last_modified"), "headers",
                          F.floor(F.col("at") / stretch).alias("part"))
    usable = rows.where(F.col("key").isNotNull() & F.col("at").isNotNull())
    inside = Window.partitionBy("key", "part").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = usable.where(~F.col("revisit")).groupBy("key", "part").agg(
        F.max_by(F.struct("id", "etag", "last_modified", "headers"), F.struct("at", "id")).alias("end"))
    parts = usable.select("key", "part").distinct().join(ends, ["key", "part"], "left")
    carried = parts.select("key", "part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    slim = F.when(~F.col("revisit"), F.struct("id", "etag", "last_modified", "headers"))
    seen = usable.withColumn("near", F.last(slim, ignorenulls=True).over(inside)).join(carried, ["key", "part"])
    found = seen.withColumn("r", F.coalesce("near", "carried"))
    both = F.col("r.etag").isNotNull() & F.col("etag").isNotNull()
    match = F.when(both, F.col("r.etag") == F.col("etag")).otherwise(F.col("r.last_modified") == F.col("last_modified"))
    update = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")),
                          lambda k, _: F.lower(k).isin(*KEPT_FROM_REVISIT))
    old = F.map_filter(F.coalesce("r.headers", F.create_map().cast("map<string,string>")),
                       lambda k, _: ~F.array_contains(F.transform(F.map_keys(update), F.lower), F.lower(k)))
    out = found.select(
        "id", F.when(~F.col("revisit"), F.col("id")).when(match, F.col("r.id")).alias("response_id"),
        F.when(~F.col("revisit"), F.col("headers")).when(match, F.map_concat(old, update)).otherwise(
            F.col("headers")).alias("headers"))
    rest = rows.where(F.col("key").isNull() | F.col("at").isNull())
    return out.union(rest.select("id", F.when(~F.col("revisit"), F.col("id")), "headers"))
