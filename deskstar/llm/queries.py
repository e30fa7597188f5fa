"""The operators as named queries over the synthetic tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar.llm import collisions, divergence, language, line_dedup, mixing, near_documents, neighbours, periods, pieces, repeats, revisits, sharding, toxicity
from deskstar.llm.common import bytes_length, documents, embeddings
from deskstar.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql:
            TWINS[name] = sql
        return fn

    return register


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predicted(F.col("text"), language.learn(docs))
    return docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", F.col("p")["lang"].alias("lang_pred"), F.col("p")["score"].alias("score"))


@query("op2_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.read_vocabulary(VOCABULARY)
    found = documents(spark, sf_dir).select(
        "doc_id", "text", pieces.round_trip(spark, F.col("text"), vocabulary).alias("found"))
    ids = F.col("found")["piece_ids"]
    return found.select("doc_id", F.size(ids).cast("long").alias("n_pieces"), ids.alias("piece_ids"),
                        F.col("found")["text"].eqNullSafe(F.col("text")).alias("round_trip"))


MIXING_SQL = """
WITH words AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn
    FROM documents),
per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM words GROUP BY source),
-- The level of the water: sources that it fills take their cap. Each candidate assumes those below it are full.
tried AS (
    SELECT a.source,
           ((SELECT sum(source_size) FROM per) * 1.5::DOUBLE
            - coalesce(sum(CASE WHEN b.below THEN b.cap END), 0)) / sum(CASE WHEN NOT b.below THEN b.weight END) AS level,
           any_value(a.source_size) AS source_size, any_value(a.weight) AS weight
    FROM per a, LATERAL (
        SELECT p.weight, p.source_size * 2.0::DOUBLE AS cap,
               (p.source_size * 2.0::DOUBLE / p.weight, coalesce(p.source, chr(1114111)))
               < (a.source_size * 2.0::DOUBLE / a.weight, coalesce(a.source, chr(1114111))) AS below
        FROM per p) b
    GROUP BY a.source),
level AS (
    SELECT arg_min(level, source_size * 2.0::DOUBLE / weight) AS level FROM tried
    WHERE level * weight <= source_size * 2.0::DOUBLE),
plan AS (
    SELECT source, source_size,
           least(source_size * 2.0::DOUBLE, coalesce((SELECT level FROM level) * weight, source_size * 2.0::DOUBLE)) AS target
    FROM per),
goal AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM plan),
laid AS (
    SELECT w.doc_id, CAST(w.size AS BIGINT) AS size, g.source_size, g.target, g.whole,
           CAST(round(g.target) AS BIGINT) - g.whole * g.source_size AS rest,
           coalesce(sum(w.size) OVER (PARTITION BY g.source ORDER BY w.drawn, w.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
    FROM words w JOIN goal g ON w.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - spent)) AS BIGINT) AS taken
FROM laid
"""


@query("op4_mixing", MIXING_SQL)
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


LINES_SQL = """
WITH numbered AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
lines AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
    FROM numbered),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (
    SELECT r, count(*) AS n_lines, count(s.key) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE s.key IS NULL), '') AS text
    FROM keyed k LEFT JOIN shared s ON k.key = s.key GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256 FROM kept JOIN numbered USING (r)
"""


@query("op5_line_dedup", LINES_SQL)
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.drop_shared_lines(docs, into="kept").select(
        "doc_id", F.col("kept")["n_lines"].alias("n_lines"), F.col("kept")["n_dropped"].alias("n_dropped"),
        F.sha2(F.col("kept")["text"].cast("binary"), 256).alias("kept_sha256"))


@query("op6_permutation_index")
def permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op7_sharding")
def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        "doc_id", (bytes_length(F.col("text")) + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_collision_counting")
def collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicates(embeddings(spark, sf_dir))


@query("op10_near_documents")
def near_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents.near_duplicate_groups(documents(spark, sf_dir), floor=0.0, copies_once=True)


@query("op9_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    cut = F.col("cut")
    return repeats.drop_repeats(docs, into="cut").select(
        "doc_id", cut["n_bytes"].alias("n_bytes"), cut["n_removed"].alias("n_removed"),
        cut["n_spans"].alias("n_spans"), F.sha2(cut["kept"], 256).alias("kept_sha256"))


@query("op11_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                        toxicity.scored(F.col("text"), model)["score"].alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents),
said AS (
    SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM docs),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
spoken AS (SELECT DISTINCT lang, source FROM docs),
counted AS (
    SELECT g.lang, g.source, k.term, count(s.r) AS c
    FROM spoken g JOIN kept k ON g.lang = k.lang LEFT JOIN said s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
    GROUP BY g.lang, g.source, k.term),
shared AS (
    SELECT *, 1 + 1000000000::HUGEINT * (c + 2)
                  // (sum(c) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM counted),
whole AS (
    SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 2)
                           // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
    FROM counted GROUP BY lang, term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM spoken a JOIN spoken b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
    FROM shared JOIN whole USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(documents(spark, sf_dir))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = periods.periodic_runs(docs.select("doc_id", periods.looped(F.col("text"), F.col("doc_id")).alias("text")))
    runs = F.col("periodic")["runs"]
    top = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("least"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]))
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), top.alias("top"),
                        F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")).alias("lines"),
                        F.col("periodic")["text"].alias("text"))
    top = F.col("top")
    return rows.select(
        "doc_id", "n_runs", (-top["back"]).alias("start"), top["length"].alias("length"), (-top["least"]).alias("period"),
        F.floor(top["length"] * 1000 / -top["least"]).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


REVISITS_SQL = r"""
WITH parts AS (
    SELECT page_id AS n, k, page_id * 3 + k AS id, url, html, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
           regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS tail
    FROM pages, (VALUES (0), (1), (2)) t(k)),
records AS (
    SELECT n, k, id, k > 0 AS revisit, html,
           trim(CASE k WHEN 0 THEN url WHEN 1 THEN url || '#again'
                ELSE upper(scheme) || '://' || host || CASE WHEN (scheme = 'https') <> (n % 9 = 0) THEN ':443' ELSE ':80' END || tail
                END) AS url,
           CASE WHEN n % 5 = 0 OR k = 1 AND n % 6 = 0 THEN NULL WHEN k = 2 AND n % 4 = 0 THEN 'other'
                ELSE 'e' || (n % 7) END AS etag,
           CASE WHEN k = 2 THEN 'late' WHEN n % 3 = 0 THEN NULL ELSE 'd' || (n % 8) END AS modified
    FROM parts),
plain AS (SELECT * REPLACE (regexp_replace(url, '#.*$', '') AS url) FROM records),
heads AS (SELECT *, regexp_extract(url, '^([a-zA-Z]+://[^/?]*)', 1) AS head FROM plain),
keyed AS (
    SELECT *, CASE WHEN head = '' THEN url ELSE
           CASE WHEN lower(head) LIKE 'http://%:80' THEN lower(head[:-4]) WHEN lower(head) LIKE 'https://%:443' THEN lower(head[:-5])
                ELSE lower(head) END || CASE WHEN url[length(head) + 1:] = '' OR url[length(head) + 1:] LIKE '?%' THEN '/' ELSE '' END || url[length(head) + 1:] END AS key
    FROM heads),
paired AS (
    SELECT v.*, f.id AS response, length(f.html) AS size, f.modified AS old,
           CASE WHEN v.etag IS NOT NULL AND f.etag IS NOT NULL THEN v.etag = f.etag ELSE v.modified = f.modified END AS matches
    FROM keyed v ASOF LEFT JOIN (SELECT * FROM keyed WHERE NOT revisit) f ON v.key = f.key AND v.id > f.id)
SELECT n AS page_id, k AS capture, CASE WHEN NOT revisit THEN id WHEN matches THEN response END AS response_id,
       CAST(CASE WHEN NOT revisit THEN length(html) WHEN matches THEN size END AS VARCHAR) AS content_length,
       CASE WHEN revisit AND matches THEN coalesce(modified, old) ELSE modified END AS last_modified
FROM paired
"""


@query("op3_warc_revisits", REVISITS_SQL)
def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as three captures, in order of id: in full, and two revisits whose URL and validators are written otherwise."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    n, k = F.col("page_id"), F.col("capture")
    scheme = F.regexp_extract("url", "^([a-z]+)://", 1)
    port = F.when((scheme == "https") != (n % 9 == 0), ":443").otherwise(":80")
    again = F.concat(F.upper(scheme), F.lit("://"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), port,
                     F.regexp_extract("url", "^[a-z]+://[^/?#]*(.*)$", 1))
    url = F.when(k == 0, F.col("url")).when(k == 1, F.concat("url", F.lit("#again"))).otherwise(again)
    none = F.lit(None).cast("string")
    tag = F.when((n % 5 == 0) | (k == 1) & (n % 6 == 0), none).when((k == 2) & (n % 4 == 0), "other").otherwise(
        F.concat(F.when(k == 0, "W/e").otherwise("e"), (n % 7).cast("string")))
    modified = F.when(k == 2, "late").when(n % 3 == 0, none).otherwise(F.concat(F.lit("d"), (n % 8).cast("string")))
    headers = F.create_map(F.lit("etag"), tag, F.lit("last-modified"), modified, F.lit("content-length"),
                           F.when(k == 0, F.col("size").cast("string")))
    captures = pages.select("page_id", "url", F.length("html").alias("size"), F.explode(
        F.array(F.lit(0), F.lit(1), F.lit(2))).alias("capture"))
    records = captures.select(
        (n * 3 + k).alias("id"), url.alias("url"), (n * 3 + k).alias("at"), (k > 0).alias("revisit"), tag.alias("etag"),
        modified.alias("last_modified"), F.map_filter(headers, lambda _, v: v.isNotNull()).alias("headers"))
    found = revisits.resolve(records)
    return found.select(
        F.floor(F.col("id") / 3).alias("page_id"), (F.col("id") % 3).cast("int").alias("capture"), "response_id",
        F.col("headers")["content-length"].alias("content_length"), F.col("headers")["last-modified"].alias("last_modified"))
