"""Hierarchical facets and path functions over page addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    crate_path, depth, extension, file_name, normalise_root, parent_folder, parse_epoch_ms,
    parse_leaf, parse_size, seconds, slash_normalise, utc_minute, zulu_to_ms,
)
from ..operators.documents import facet_rows
from ..operators.filters import PathRules, capped_body
from .base import query, table

_BARE = r"^https?://"


def _page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", _BARE, "").alias("path"))


_FACET_SQL = """
    SELECT page_id, i - 1 AS level,
           concat(i - 1, '/', array_to_string(parts[1:i], '/'), '/') AS facet
    FROM (SELECT page_id, parts, unnest(generate_series(1, len(parts))) AS i
          FROM (SELECT page_id,
                       string_split(rtrim(replace(regexp_replace(url, '^https?://', ''), '"', ''), '/'), '/') AS parts
                FROM pages))
"""


@query(_FACET_SQL)
def hier_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facet_rows(_page_paths(spark, sf_dir), "page_id", "path")


@query(f"SELECT level, facet, count(*) AS n_pages FROM ({_FACET_SQL}) GROUP BY level, facet")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hier_facets(spark, sf_dir).groupBy("level", "facet").agg(F.count(F.lit(1)).alias("n_pages"))


_RULES = PathRules(
    exclude_names=(".*/es/.*", ".*spam-farm.*"), include_types=("html", "htm"), exclude_types=("htm",)
)


@query("""
    WITH p AS (
        SELECT page_id, regexp_replace(concat('/', regexp_replace(url, '^https?://', '')), '[?#].*$', '') AS path
        FROM pages),
    q AS (
        SELECT page_id, path, regexp_replace(path, '/$', '') AS trimmed FROM p),
    r AS (
        SELECT page_id, path, trimmed, string_split(trimmed, '/')[-1] AS name FROM q),
    s AS (
        SELECT *, CASE WHEN name LIKE '%.%' AND name NOT LIKE '%.' THEN string_split(name, '.')[-1] END AS ext FROM r)
    SELECT page_id, path, name, ext,
           trimmed[1:len(trimmed) - len(name) - 1] AS parent,
           len(string_split(trimmed, '/')) - 1 AS depth,
           NOT (regexp_full_match(trimmed, '.*/es/.*') OR regexp_full_match(trimmed, '.*spam-farm.*'))
               AND (ext IS NULL OR ext = 'html') AS kept
    FROM s
""")
def path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.concat(F.lit("/"), "path"), r"[?#].*$", "")
    rows = _page_paths(spark, sf_dir).select("page_id", path.alias("path"))
    trimmed = F.regexp_replace("path", r"/\z", "")
    return rows.select(
        "page_id", "path", file_name(trimmed).alias("name"), extension(trimmed).alias("ext"),
        parent_folder(trimmed).alias("parent"), depth("path").cast("bigint").alias("depth"),
        _RULES.keeps_path("path").alias("kept"),
    )


def _raw_root(url: Column) -> Column:
    """Page addresses respelled the ways a crawl root may be written."""
    bare = F.regexp_replace(url, _BARE, "")
    back = F.translate(bare, "/", "\\")
    return (
        F.when(url.startswith("http://"), F.concat(F.lit("\\\\"), back))
        .when(url.startswith("https://m."), F.concat(F.lit("smb:\\\\"), back))
        .when(url.startswith("https://www."), F.concat(F.lit("/"), bare))
        .when(url.startswith("https://blog."), F.concat(F.lit("D:\\"), back))
        .otherwise(F.concat(F.lit("smb://"), bare))
    )


@query(r"""
    WITH p AS (
        SELECT page_id, url, regexp_replace(url, '^https?://', '') AS bare FROM pages),
    q AS (
        SELECT page_id,
            CASE WHEN url LIKE 'http://%' THEN '\\' || replace(bare, '/', '\')
                 WHEN url LIKE 'https://m.%' THEN 'smb:\\' || replace(bare, '/', '\')
                 WHEN url LIKE 'https://www.%' THEN '/' || bare
                 WHEN url LIKE 'https://blog.%' THEN 'D:\' || replace(bare, '/', '\')
                 ELSE 'smb://' || bare END AS raw,
            CASE WHEN url LIKE 'http://%' THEN 'smb://' || bare
                 WHEN url LIKE 'https://m.%' THEN 'smb://' || bare
                 WHEN url LIKE 'https://www.%' THEN 'file:///' || bare
                 WHEN url LIKE 'https://blog.%' THEN 'file://D:/' || bare
                 ELSE 'smb://' || bare END AS root
        FROM p)
    SELECT page_id, raw, rtrim(root, '/') || '/' AS root,
           CASE WHEN root LIKE 'file:///%' THEN rtrim(root[8:], '/')
                WHEN root LIKE 'file://%' THEN rtrim(root[8:], '/')
                ELSE rtrim(root, '/') END AS stored,
           replace(raw, '\', '/') AS forward
    FROM q
""")
def path_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages").select("page_id", _raw_root(F.col("url")).alias("raw"))
    root = normalise_root("raw")
    return raw.select(
        "page_id", "raw", root.alias("root"), crate_path(root).alias("stored"),
        slash_normalise("raw").alias("forward"),
    )


@query("""
    SELECT p_partkey, '/parts/' || p_brand AS parent, replace(p_name, ' ', '_') AS name,
           p_partkey * 1000 AS last_modified_ms,
           CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) ELSE 0 END AS size
    FROM part
""")
def leaf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("\\parts\\"), "p_brand", F.lit("\\"), F.translate("p_name", " ", "_"))
    size = F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.lit("n/a"))
    text = F.concat_ws("_:_", path, (F.col("p_partkey") * 1000).cast("string"), size)
    parts = table(spark, sf_dir, "part").select("p_partkey", parse_leaf(text).alias("leaf"))
    return parts.select("p_partkey", "leaf.*")


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE epoch_ms(o_orderdate) END AS zulu_ms,
           CASE WHEN o_orderstatus = 'P' THEN '1970-01-01T00:00Z' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%MZ') END AS minute,
           CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey * 1001 END AS epoch_ms,
           (o_custkey * 1001) // 1000 AS epoch_s,
           CASE WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE o_custkey END AS size
    FROM orders
""")
def value_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    zulu = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    ms = (F.col("o_custkey") * 1001).cast("string")
    epoch = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(ms, F.lit("ms"))).otherwise(ms)
    size = F.col("o_custkey").cast("string")
    sized = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(size, F.lit(".5"))).otherwise(size)
    return orders.select(
        "o_orderkey", zulu_to_ms(zulu).alias("zulu_ms"), utc_minute(zulu_to_ms(zulu)).alias("minute"),
        parse_epoch_ms(epoch).alias("epoch_ms"), seconds(ms.cast("bigint")).alias("epoch_s"),
        parse_size(sized).cast("bigint").alias("size"),
    )


@query("""
    SELECT doc_id, octet_length(encode(text)) AS n_bytes,
           octet_length(encode(text)) <= 5000 AS kept,
           CASE WHEN octet_length(encode(text)) <= 5000 THEN md5(text) END AS body_md5
    FROM documents
""")
def size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = capped_body("text", 5000)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        body.isNotNull().alias("kept"), F.md5(body).alias("body_md5"),
    )


