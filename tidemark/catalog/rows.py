"""Documents made from table rows, their ids, dumps and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import doc_id, entry, merge_entries
from ..operators import documents as docs
from ..operators.incremental import null_key_count
from ..operators.incremental import usable_keys as drop_null_keys
from ..session import shared_dir
from ..sinks.output import write_documents, write_ids
from ..sources.files import list_files, read_bodies
from ..sources.messages import parse_tasks
from ..streaming.attempts import OUTCOMES, stream_attempts
from .base import query, table


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        "c_mktsegment",
    )


_CUSTOMER_SQL = """
    SELECT c_custkey::VARCHAR AS id, field, value
    FROM (SELECT c_custkey, c_custkey::VARCHAR AS k, c_name, c_nationkey::VARCHAR AS n,
                 c_acctbal::DECIMAL(18, 2)::VARCHAR AS a, c_mktsegment FROM customer)
    , LATERAL (VALUES ('c_custkey', k), ('c_name', c_name), ('c_nationkey', n), ('c_acctbal', a),
                      ('c_mktsegment', c_mktsegment)) AS v(field, value)
"""


@query(f"SELECT id, field, 0::BIGINT AS pos, value FROM ({_CUSTOMER_SQL})")
def row_to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = docs.row_documents(_customers(spark, sf_dir), ["c_custkey"], "customers", "C_NAME")
    return docs.to_long(made).withColumn("pos", F.col("pos").cast("bigint"))


@query("""
    SELECT l_orderkey || ',' || l_linenumber || ',' || l_suppkey AS id, count(*) AS n_rows
    FROM lineitem GROUP BY 1
""")
def compound_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = doc_id("l_orderkey", "l_linenumber", "l_suppkey")
    return table(spark, sf_dir, "lineitem").groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT count(*) FILTER (WHERE quality IS NULL AND toxic IS NULL) AS null_keys, count(*) AS rows
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return null_key_count(joined, ["quality", "toxic"])


@query("SELECT c_custkey::VARCHAR AS id FROM customer")
def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as text lines and read back."""
    out = shared_dir(spark, "ids")
    made = docs.row_documents(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "customers")
    write_ids(made, out)
    return spark.read.text(out).select(F.col("value").alias("id"))


@query(f"SELECT id, max(CASE WHEN field = 'c_name' THEN value END) AS name FROM ({_CUSTOMER_SQL}) GROUP BY id")
def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON messages and read back."""
    out = shared_dir(spark, "messages")
    write_documents(docs.row_documents(_customers(spark, sf_dir), ["c_custkey"], "customers"), out)
    schema = "id string, source string, fields map<string, array<string>>"
    parsed = spark.read.schema(schema).json(out)
    return parsed.select("id", F.try_element_at("fields", F.lit("c_name"))[0].alias("name"))


@query("""
    SELECT doc_id::VARCHAR AS id, field, pos, value FROM (
        SELECT doc_id, 'source' AS field, 0::BIGINT AS pos, source AS value FROM documents
        UNION ALL SELECT doc_id, 'lang', 0, lang FROM documents
        UNION ALL SELECT doc_id, 'line', i - 1, lines[i] FROM (
            SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))
""")
def document_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array(F.struct(F.lit("line").alias("name"), F.split("text", "\n").alias("values")))
    made = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "source", "lang", merge_entries(lines).alias("fields")
    )
    return docs.dump(made, ["source", "lang"]).withColumn("pos", F.col("pos").cast("bigint"))


@query("SELECT DISTINCT 'lang=' || lang || '/source=' || source AS folder FROM documents")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as a folder tree, listed as files and reduced to their folders."""
    out = shared_dir(spark, "tree")
    # Ranges that end in the id cluster each folder's rows, yet spread a folder that is hot.
    table(spark, sf_dir, "documents").select("doc_id", "lang", "source") \
        .repartitionByRange("lang", "source", "doc_id").write.partitionBy("lang", "source").parquet(out)
    listed = list_files(spark, out, "*.parquet").where("size > 0")
    tail = F.concat_ws("/", F.slice(F.split("parent", "/"), -2, 2))
    return listed.select(tail.alias("folder")).distinct()


@query("""
    SELECT lang, sum(octet_length(encode(text)) + 1) AS n_bytes FROM documents GROUP BY lang
""")
def file_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files read whole as bodies; one beyond the size cap counts with its length alone."""
    out = shared_dir(spark, "bodies")
    texts = table(spark, sf_dir, "documents").select("lang", "text")
    texts.write.option("maxRecordsPerFile", 100).partitionBy("lang").text(out)
    bodies = read_bodies(spark, out, glob="part-*")
    lang = F.regexp_extract("path", "lang=([^/]*)/", 1)
    return bodies.groupBy(lang.alias("lang")).agg(F.sum(F.coalesce(F.octet_length("content"), "length")).cast("bigint").alias("n_bytes"))


@query("""
    SELECT l.doc_id, CASE WHEN l.toxic = 0 AND octet_length(encode(d.text)) <= 5000 THEN md5(d.text) END AS body_md5
    FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
""")
def body_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("smb://server/docs/"), F.col("doc_id").cast("string"))
    wanted = table(spark, sf_dir, "labels").select(
        "doc_id", path.alias("temp_path"), F.when(F.col("toxic") == 0, "CORP").otherwise("OTHER").alias("domain")
    )
    bodies = table(spark, sf_dir, "documents").select(
        path.alias("path"), F.octet_length("text").alias("length"), F.col("text").alias("content")
    )
    joined = docs.attach_body(wanted, bodies, cap=5000, domain="domain", configured_domain="CORP")
    return joined.select("doc_id", F.md5("body").alias("body_md5"))


@query("""
    SELECT event_id, event_type NOT IN ('error', 'view', 'click') AS ok,
           CASE WHEN event_type NOT IN ('error', 'click') AND event_type <> 'view' THEN 'u' || user_id END AS id,
           CASE WHEN event_type NOT IN ('error', 'click') AND event_type <> 'view' THEN (props->>'k')::BIGINT END AS level
    FROM events
""")
def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task messages of which some are cut off, lack the id, or have a text level."""
    level = F.get_json_object("props", "$.k")
    identifier = F.concat(F.lit('"id":"u'), F.col("user_id").cast("string"), F.lit('"'))
    whole = F.concat(F.lit("{"), identifier, F.lit(',"level":'), level, F.lit("}"))
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), identifier, F.lit(',"lev')))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"level":'), level, F.lit("}")))
        .when(F.col("event_type") == "click", F.concat(F.lit("{"), identifier, F.lit(',"level":"deep"}')))
        .otherwise(whole)
    )
    messages = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    parsed = parse_tasks(messages)
    return parsed.select(
        "event_id", "ok", F.when(F.col("ok"), F.col("task.id")).alias("id"),
        F.when(F.col("ok"), F.col("task.level")).cast("bigint").alias("level"),
    )


@query("""
    WITH e AS (
        SELECT user_id::VARCHAR AS id, event_id AS seq, event_type = 'signup' AS ok, event_type AS value,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM events),
    good AS (SELECT id, min(attempt) FILTER (WHERE ok) AS n FROM e GROUP BY id)
    SELECT id, seq, attempt, CASE WHEN ok THEN 'done' WHEN attempt = 5 THEN 'dead' ELSE 'retry' END AS outcome, value
    FROM e JOIN good USING (id) WHERE attempt <= least(coalesce(n, 5), 5)
""")
def message_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts at a message for each user: three batches, a restart in between, dead after five failures."""
    base = shared_dir(spark, "attempts")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), F.col("event_id").alias("seq"),
        (F.col("event_type") == "signup").alias("ok"), F.col("event_type").alias("value"))
    thirds = events.agg(F.percentile_approx("seq", F.array(F.lit(1 / 3), F.lit(2 / 3)))).first()[0]
    bounds = [None, *(thirds or []), None]
    for low, high in zip(bounds, bounds[1:]):
        part = events
        if low is not None:
            part = part.where(F.col("seq") > low)
        if high is not None:
            part = part.where(F.col("seq") <= high)
        part.write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        stream_attempts(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(OUTCOMES).parquet(f"{base}/out")


@query("""
    SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL
""")
def usable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; rows whose key parts are all null go."""
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    return drop_null_keys(joined, ["quality", "toxic"])
