"""Index records, field mapping, header records, actions and staged processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import entry, export_mime as as_export, final_mime, is_native, merge_entries
from ..operators import documents as docs
from ..operators import headers, index, mapping
from ..plans.stages import Stage, load_stages, run_stages, terminate
from ..session import shared_dir
from ..streaming.index_stream import IndexTable, stream_actions
from .base import query, spread, table


@query("""
    SELECT doc_id::VARCHAR AS id, 'https://docs.example.com/' || doc_id AS url, 'Document ' || doc_id AS title,
           CASE WHEN lang <> 'es' THEN 'text/plain' END AS mime, source AS parent_id, n_chars AS size,
           strftime(make_timestamp(n_chars * 60000000000), '%Y-%m-%dT%H:%M:%SZ') AS last_modified_date_s,
           strftime(make_timestamp(n_chars * 60000000000), '%Y-%m-%dT%H:%M:%SZ') AS last_modified,
           'corpus' AS source, CASE WHEN lang = 'en' THEN doc_id || '-1,' || doc_id || '-2' END AS child_ids,
           CASE WHEN lang <> 'de' THEN md5(text) END AS text_md5
    FROM documents
""")
def index_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    children = F.array(F.concat(key, F.lit("-1")), F.concat(key, F.lit("-2")))
    made = table(spark, sf_dir, "documents").select(
        key.alias("id"), F.concat(F.lit("https://docs.example.com/"), key).alias("url"),
        F.concat(F.lit("Document "), key).alias("title"),
        F.when(F.col("lang") != "es", F.lit("text/plain")).alias("mime"), F.col("source").alias("parent_id"),
        F.col("n_chars").alias("size"), (F.col("n_chars") * 60000000).alias("last_modified_ms"),
        F.lit("corpus").alias("source"),
        F.when(F.col("lang") == "en", children).otherwise(F.slice(children, 1, 0)).alias("child_ids"),
        (F.col("lang") == "de").alias("is_stub"), F.col("text").alias("body"),
    )
    return index.core_record(made).withColumn("text_md5", F.md5("_text_")).drop("_text_")


@query("""
    WITH s AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT s_suppkey::VARCHAR AS id, list AS acl, pos::BIGINT AS pos, token, CASE WHEN s_acctbal > 0 THEN s_name END AS owner,
           'server1' AS servername, n_name AS sharename, s_name || '.doc' AS filename, 'doc' AS ext
    FROM s, LATERAL (VALUES ('allow_token_share', 0, n_name), ('allow_token_document', 0, n_name),
                            ('allow_token_document', 1, s_name), ('deny_token_share', 0, 'guest')) AS v(list, pos, token)
""")
def acl_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    empty = F.slice(F.array("n_name"), 1, 0)
    file = F.struct(
        F.array("n_name").alias("allow_token_share"), empty.alias("allow_token_parent"),
        F.array("n_name", "s_name").alias("allow_token_document"),
        F.array(F.lit("guest")).alias("deny_token_share"), empty.alias("deny_token_parent"),
        empty.alias("deny_token_document"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("owner"), F.lit("server1").alias("server"),
        F.col("n_name").alias("share"), F.concat("s_name", F.lit(".doc")).alias("name"), F.lit("doc").alias("extension"),
    )
    record = index.acl_record(rows.select(F.col("s_suppkey").cast("string").alias("id"), file.alias("file")))
    lists = F.create_map(*[x for name in index.ACL_LISTS for x in (F.lit(name), F.col(name))])
    scalars = ["owner", "servername", "sharename", "filename", "ext"]
    return record.select("id", *scalars, F.explode(lists).alias("acl", "_t")).select(
        "id", "acl", F.posexplode("_t").alias("pos", "token"), *scalars
    ).withColumn("pos", F.col("pos").cast("bigint"))


_ENTRIES = [
    ("label", "label", None, False),
    ("category", "category", None, True),
    ("client", "category", None, False),
    ("permissions", "ao_permission", None, True),
    ("tags", "tags", None, False),
    ("PID_*", None, "true", None),
]


def _part_documents(parts: DataFrame) -> DataFrame:
    """Parts as documents: renamed, shared, multi-valued, dynamic, facet and unmapped fields."""
    words = F.struct(F.lit("permissions").alias("name"), F.split("p_name", " ").alias("values"))
    tags = F.struct(F.lit("tags").alias("name"), F.split("p_name", " ").alias("values"))
    hier = F.struct(
        F.lit("_hier_path").alias("name"),
        F.array(F.concat(F.lit("0/"), F.col("p_type"), F.lit("/"))).alias("values"),
    )
    fields = F.array(
        entry("label", "p_name"), entry("category", "p_type"), entry("client", "p_brand"), words, tags, hier,
        entry("PID_size", "p_size"), entry("title", "p_name"), entry("unmapped", "p_type"),
    )
    return parts.select(F.col("p_partkey").cast("string").alias("id"), merge_entries(fields).alias("fields"))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts sent through a mapping that is written as a mapping file and loaded again."""
    path = shared_dir(spark, "mapping")
    entries = ", ".join(
        "named_struct('idocField', '{}', 'solrField', {}, 'dynamicSolrFieldType', {}, 'multi', {})".format(
            source, f"'{target}'" if target else "CAST(NULL AS STRING)",
            f"'{dynamic}'" if dynamic else "CAST(NULL AS STRING)", "true" if many else "false")
        for source, target, dynamic, many in _ENTRIES
    )
    spark.sql(f"SELECT array({entries}) AS iDoc2Solr").write.json(path)
    sent = mapping.map_fields(_part_documents(table(spark, sf_dir, "part")), mapping.FieldMapping.load(spark, path))
    return docs.to_long(sent, "id", "index_fields").withColumn("pos", F.col("pos").cast("bigint"))


_MAPPED_SQL = """
    SELECT p_partkey::VARCHAR AS id, v.field, v.pos::BIGINT AS pos, v.value FROM part,
    LATERAL (SELECT * FROM (VALUES ('label', 0, p_name), ('category', 0, p_type), ('category', 1, p_brand),
        ('tags', 0, replace(p_name, ' ', ',')), ('_hier_path', 0, '0/' || p_type || '/'),
        ('PID_size', 0, p_size::VARCHAR)) AS f(field, pos, value)
        UNION ALL SELECT 'ao_permission', i - 1, string_split(p_name, ' ')[i]
                  FROM generate_series(1, len(string_split(p_name, ' '))) AS g(i)) AS v
"""


@query(_MAPPED_SQL)
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir)


@query(_MAPPED_SQL)
def mapping_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from long rows and a mapping that is a table, dynamic prefixes included."""
    known = mapping.FieldMapping.of(_ENTRIES)
    targets = spark.createDataFrame(
        [(s, t, t in known.multi) for s, t in known.targets.items()], "source string, target string, multi boolean")
    prefixes = spark.createDataFrame([(p,) for p in known.prefixes], "prefix string")
    return mapping.map_table(docs.to_long(_part_documents(spread(table(spark, sf_dir, "part")))), targets, prefixes)


@query(f"SELECT * FROM ({_MAPPED_SQL}) WHERE field LIKE 'PID\\_%' ESCAPE '\\' OR field LIKE '\\_hier\\_%' ESCAPE '\\'")
def dynamic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("field")
    return _mapped(spark, sf_dir).where(name.startswith("PID_") | name.startswith("_hier_"))


@query("""
    SELECT field, target, multi, count(*) AS n_values FROM (
        SELECT v.field, v.target, v.multi FROM part, LATERAL (VALUES
            ('label', 'label', false), ('category', 'category', true), ('client', 'category', true),
            ('_hier_path', '_hier_path', true), ('PID_size', NULL, false), ('title', NULL, false),
            ('unmapped', NULL, false)) AS v(field, target, multi)
        UNION ALL SELECT v.field, v.target, v.multi FROM (SELECT unnest(string_split(p_name, ' ')) FROM part),
            (VALUES ('permissions', 'ao_permission', true), ('tags', 'tags', false)) AS v(field, target, multi))
    GROUP BY field, target, multi
""")
def mapped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form values joined to the mapping table."""
    many = {t for _, t, _, m in _ENTRIES if m}
    targets = spark.createDataFrame(
        [(s, t, t in many) for s, t, _, _ in _ENTRIES if t], "source string, target string, multi boolean"
    )
    long = docs.to_long(_part_documents(table(spark, sf_dir, "part")))
    return mapping.map_long(long, targets).groupBy("field", "target", "multi").agg(F.count(F.lit(1)).alias("n_values"))


@query("SELECT doc_id::VARCHAR AS id, md5(replace(text, chr(10), ',')) AS value_md5 FROM documents")
def multi_value_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text as values of a single-valued target."""
    lines = F.array(F.struct(F.lit("lines").alias("name"), F.split("text", "\n").alias("values")))
    made = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), merge_entries(lines).alias("fields")
    )
    sent = mapping.map_fields(made, mapping.FieldMapping.of([("lines", "content_t", None, False)]))
    return sent.select("id", F.md5(docs.first_value("index_fields", "content_t")).alias("value_md5"))


def _header_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("p_name"), F.lit("\\n"), F.col("p_type"))
    own = F.when(F.col("p_type") == "PROMO", F.lit("promo"))
    fields = F.array(
        F.struct(F.lit("word").alias("name"), F.split("p_name", " ").alias("values")),
        entry("brand", "p_brand"), entry("name", name), entry("indexname", own),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), merge_entries(fields).alias("fields"),
        (F.col("p_type") == "SMALL").alias("is_stub"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("bigint")).otherwise(0).alias("size"),
        (F.col("p_partkey") * 60000).alias("last_modified_ms"), F.col("p_name").alias("body"),
    )


@query("""
    WITH e AS (
        SELECT p_partkey, p_type, 1 AS grp, 0 AS pos, 'brand=' || p_brand AS entry FROM part
        UNION ALL SELECT p_partkey, p_type, 2, 0, 'indexname=promo' FROM part WHERE p_type = 'PROMO'
        UNION ALL SELECT p_partkey, p_type, 3, 0, 'name=' || p_name || p_type FROM part
        UNION ALL SELECT p_partkey, p_type, 4, i, 'word=' || string_split(p_name, ' ')[i] FROM (
            SELECT *, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM part)
        UNION ALL SELECT p_partkey, p_type, 5, 0,
            'indexedContent=' || (p_type <> 'SMALL' AND p_size > 10 AND p_size <= 40)::VARCHAR FROM part),
    n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY grp, pos) AS n FROM e)
    SELECT CASE WHEN p_type = 'PROMO' THEN 'promo' ELSE 'main' END AS index, p_partkey::VARCHAR AS filename,
           'meta' || n AS meta, n, entry FROM n
""")
def numbered_metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.header_entries(headers.header_records(_header_documents(spark, sf_dir), "main", cap=40))


@query("""
    SELECT CASE WHEN p_type = 'PROMO' THEN 'promo' END AS index, p_partkey::VARCHAR AS filename, 'delete' AS request,
           CASE WHEN p_type <> 'PROMO' THEN 'no index specified' END AS error FROM part
""")
def numbered_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.header_deletes(_header_documents(spark, sf_dir))


@query("""
    SELECT p_partkey::VARCHAR AS filename, strftime(make_timestamp(p_partkey * 60000000), '%Y-%m-%dT%H:%MZ') AS last_modified,
           CASE WHEN p_type <> 'SMALL' AND p_size > 10 AND p_size <= 40 THEN p_name END AS body
    FROM part
""")
def header_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = headers.header_records(_header_documents(spark, sf_dir), "main", cap=40)
    return records.select("filename", "last_modified", "body")


@query("""
    SELECT p_partkey, mime, mime LIKE 'application/vnd.google-apps.%' AS native,
           CASE kind WHEN 'document' THEN 'text/plain'
                     WHEN 'Spreadsheet' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
                     WHEN 'appscript' THEN 'application/vnd.google-apps.script+json'
                     WHEN '' THEN mime ELSE 'application/pdf' END AS export,
           CASE WHEN kind = 'document' AND p_size > 10 THEN 'text/plain' ELSE mime END AS final
    FROM (SELECT *, CASE WHEN kind = '' THEN 'text/html' ELSE 'application/vnd.google-apps.' || kind END AS mime
          FROM (SELECT *, CASE p_type WHEN 'STANDARD' THEN 'document' WHEN 'PROMO' THEN 'Spreadsheet'
                     WHEN 'LARGE' THEN 'drawing' WHEN 'SMALL' THEN 'appscript'
                     WHEN 'ECONOMY' THEN 'presentation' ELSE '' END AS kind FROM part))
""")
def export_mime(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"STANDARD": "document", "PROMO": "Spreadsheet", "LARGE": "drawing", "SMALL": "appscript", "ECONOMY": "presentation"}
    mime = F.lit("text/html")
    for part_type, kind in kinds.items():
        mime = F.when(F.col("p_type") == part_type, F.lit("application/vnd.google-apps." + kind)).otherwise(mime)
    body = F.greatest(F.col("p_size") - 10, F.lit(0))
    rows = table(spark, sf_dir, "part").select("p_partkey", mime.alias("mime"), body.alias("length"))
    return rows.select(
        "p_partkey", "mime", is_native("mime").alias("native"), as_export("mime").alias("export"),
        final_mime("mime", "length").alias("final"),
    )


@query("""
    SELECT p_partkey::VARCHAR AS id, p_type = 'PROMO' AS success,
           CASE WHEN p_type <> 'PROMO' THEN 'no index specified' ELSE 'success' END AS status FROM part
""")
def terminator_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header records written out, one status per document; a missing index is an error."""
    out = shared_dir(spark, "headers")
    return terminate(_header_documents(spark, sf_dir), headers.write_headers, {"path": out})


_CONTENT = ["event_id", "detail"]
_ORDER = ["modified", "event_id"]


def _to_actions(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    action = F.when(kind == "error", "delete").when(kind == "signup", "Insert").otherwise("UPDATE")
    return events.select(
        F.col("user_id").alias("id"), action.alias("action"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("modified"), "event_id",
        F.get_json_object("props", "$.k").alias("detail"),
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the records already in the index."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit(0).cast("bigint").alias("last_modified"),
        F.lit(-1).cast("bigint").alias("event_id"), F.col("c_name").alias("detail"),
    )


_ACTIONS_SQL = """
    WITH e AS (
        SELECT user_id AS id, event_type, epoch_us(ts) AS us, event_id, props->>'k' AS detail,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    cut AS (SELECT id, max(n) FILTER (WHERE event_type = 'error') AS gone FROM e GROUP BY id),
    live AS (SELECT e.*, gone FROM e JOIN cut USING (id) WHERE n > coalesce(gone, 0)),
    net AS (
        SELECT id, max(us) AS last_modified, min(gone) AS gone,
               max(n) FILTER (WHERE event_type = 'signup') AS ins, min(n) AS first_n FROM live GROUP BY id),
    made AS (
        SELECT net.*, live.event_id, live.detail FROM net JOIN live ON live.id = net.id AND live.n = coalesce(ins, first_n))
    SELECT coalesce(made.id, c_custkey) AS id, coalesce(made.last_modified, 0) AS last_modified,
           CASE WHEN made.id IS NULL OR (gone IS NULL AND ins IS NULL AND c_custkey IS NOT NULL)
                THEN -1 ELSE event_id END AS event_id,
           CASE WHEN made.id IS NULL OR (gone IS NULL AND ins IS NULL AND c_custkey IS NOT NULL)
                THEN c_name ELSE detail END AS detail
    FROM made FULL JOIN customer ON made.id = c_custkey
    WHERE made.id IS NOT NULL OR c_custkey NOT IN (SELECT id FROM cut)
"""


@query(_ACTIONS_SQL)
def apply_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = _to_actions(table(spark, sf_dir, "events"))
    return index.apply_actions(_stored(spark, sf_dir), actions, "id", "action", "modified", _ORDER, _CONTENT)


_ACTION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("action", T.StringType()),
    T.StructField("modified", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("detail", T.StringType()),
])
_CONTENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("detail", T.StringType())])


def _index_table(spark: SparkSession, sf_dir: str) -> tuple[IndexTable, str]:
    base = shared_dir(spark, "index")
    target = IndexTable(spark, f"{base}/index", _CONTENT_SCHEMA, _ORDER, _ACTION_SCHEMA)
    target.start_from(_stored(spark, sf_dir))
    return target, base


def _run_stream(spark: SparkSession, sf_dir: str, runs: int) -> tuple[IndexTable, list[int]]:
    target, base = _index_table(spark, sf_dir)
    schema = table(spark, sf_dir, "events").schema
    # Written as a pattern, the source may be one file or a folder of files.
    source = f"{sf_dir}/{{events.parquet}}"
    seen = []
    for _ in range(runs):
        events = spark.readStream.schema(schema).parquet(source)
        stream_actions(events, _to_actions, target, f"{base}/checkpoint").awaitTermination()
        seen.append(target.table.changes().count())
    return target, seen


@query(_ACTIONS_SQL)
def apply_actions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _run_stream(spark, sf_dir, 1)
    return target.read()


def _take_turns(spark: SparkSession, sf_dir: str, compacting: bool) -> DataFrame:
    """Two streams over the two halves of the events; the first resumes after the second."""
    target, base = _index_table(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    for name, third in (("a", 0), ("b", 1), ("a", 2)):
        events.where(F.pmod("event_id", F.lit(3)) == third).write.mode("append").parquet(f"{base}/{name}")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/{name}")
        stream_actions(stream, _to_actions, target, f"{base}/checkpoint-{name}").awaitTermination()
        if compacting:
            target.compact()
    return target.read()


@query(_ACTIONS_SQL)
def streams_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through streams that take turns on one table."""
    return _take_turns(spark, sf_dir, False)


@query(_ACTIONS_SQL)
def streams_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a compaction after every turn."""
    return _take_turns(spark, sf_dir, True)


@query(_ACTIONS_SQL)
def late_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of all events, a compaction, then the earlier half."""
    target, _ = _index_table(spark, sf_dir)
    actions = _to_actions(table(spark, sf_dir, "events"))
    middle = actions.agg(F.percentile_approx("modified", 0.5)).first()[0] or 0
    target.write(actions.where(F.col("modified") >= middle), 0)
    target.compact()
    target.write(actions.where(F.col("modified") < middle), 1)
    return target.read()


@query(_ACTIONS_SQL)
def index_leveled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, a quarter of the index's buckets a turn, with a compaction of the buckets touched after each."""
    target, _ = _index_table(spark, sf_dir)
    actions = _to_actions(table(spark, sf_dir, "events"))
    for turn in range(4):
        target.write(actions.where(F.pmod(target.table.bucket_of("id"), F.lit(4)) == turn), turn)
        target.compact()
    return target.read()


@query(_ACTIONS_SQL)
def replay_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, each written twice, the second also after a compaction."""
    target, _ = _index_table(spark, sf_dir)
    actions = _to_actions(table(spark, sf_dir, "events"))
    halves = [actions.where(F.pmod("event_id", F.lit(2)) == n) for n in range(2)]
    for batch in (0, 0, 1, 1):
        target.write(halves[batch], batch)
    target.compact()
    target.write(halves[1], 1)
    return target.read()


@query("""
    SELECT CASE WHEN p_type = 'PROMO' THEN 'promo' ELSE 'main' END AS index, p_partkey::VARCHAR AS filename,
           CASE WHEN p_type <> 'SMALL' AND p_size > 10 AND p_size <= 40 THEN p_name END AS body
    FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0
""")
def header_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header records after four runs: two of adds, one of deletes, one that adds some again."""
    records = headers.HeaderTable(spark, f"{shared_dir(spark, 'headers')}/main")
    found = _header_documents(spark, sf_dir)
    key = F.col("id").cast("bigint")
    adds = headers.header_records(found, "main", cap=40).withColumn("_key", F.col("filename").cast("bigint"))
    records.append(adds.where("_key % 2 = 1"), 1)
    records.append(adds.where("_key % 2 = 0"), 2)
    records.append(headers.header_deletes(found.where(key % 3 == 0), "main"), 3)
    records.append(adds.where("_key % 6 = 0"), 4)
    return records.read().select("index", "filename", "body")


@query("SELECT 1 AS run, count(*) AS new_actions FROM events UNION ALL SELECT 2, 0")
def refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second refresh over the same input finds nothing new."""
    _, seen = _run_stream(spark, sf_dir, 2)
    rows = [(1, seen[0]), (2, seen[1] - seen[0])]
    return spark.createDataFrame(rows, "run int, new_actions bigint")


@query("""
    SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS at
    FROM events GROUP BY user_id
""")
def latest_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_type", F.col("ts").alias("at"), "event_id"
    )
    return index.latest_action(events, "id", ["at", "event_id"]).drop("event_id")


@query("""
    SELECT c_custkey AS id FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error') ORDER BY id
""")
def delete_and_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").alias("id")).distinct()
    return index.export_scan(index.delete_ids(_stored(spark, sf_dir), gone), ["id"])


def _split_lines(df: DataFrame, settings: dict) -> DataFrame:
    """Child emission: every document also yields one child per line of its text."""
    lines = F.split("text", "\n")
    kids = F.transform(lines, lambda x, i: F.struct(
        F.concat("id", F.lit(settings["separator"]), (i + 1).cast("string")).alias("id"), x.alias("text")
    ))
    own = F.array(F.struct("id", "text"))
    return df.select(
        F.inline(F.concat(own, kids)), "action", F.col("id").alias("root"), "fields"
    )


_STAGES = """{"stages": [
    {"stage": "drop", "settings": {"field": "storage_account"}},
    {"stage": "facets", "priority": 2, "settings": {"names": "path"}},
    {"stage": "children", "priority": 1, "settings": {"separator": " -_ "}},
    {"stage": "constant", "priority": 2, "settings": {"site": "fixed"}}
]}"""


@query("""
    WITH d AS (
        SELECT doc_id::VARCHAR AS root, text, lang, CASE WHEN lang = 'de' THEN 'DELETE' ELSE 'INSERT' END AS action,
               source AS path FROM documents),
    c AS (
        SELECT root, root AS id, action, text FROM d
        UNION ALL SELECT root, root || ' -_ ' || i, action, string_split(text, chr(10))[i] FROM (
            SELECT *, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM d WHERE action = 'INSERT'))
    SELECT c.id, c.action, CASE WHEN c.action = 'DELETE' THEN NULL ELSE c.root END AS root,
           CASE WHEN c.action = 'INSERT' THEN '0/' || path || '/' END AS facet,
           CASE WHEN c.action = 'INSERT' THEN 'fixed' END AS site, md5(c.text) AS text_md5, NULL AS secret
    FROM c JOIN d ON c.root = d.root
""")
def stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the four stages of a configuration file; deletes pass around stages that do not handle them."""
    fields = F.array(entry("path", "source"), entry("storage_account", F.lit("secret")))
    made = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text",
        F.when(F.col("lang") == "de", "DELETE").otherwise("INSERT").alias("action"),
        merge_entries(fields).alias("fields"),
    )
    known = [
        Stage("drop", lambda df, s: docs.drop_field(df, s["field"]), handles_deletes=True),
        Stage("facets", lambda df, s: docs.add_hier_fields(df, s["names"])),
        Stage("children", _split_lines, settings={"separator": ":"}),
        Stage("constant", lambda df, s: docs.add_constants(df, s)),
    ]
    path = f"{shared_dir(spark, 'stages')}/stages"
    spark.createDataFrame([(_STAGES,)], "value string").write.text(path)
    done = run_stages(made, load_stages(spark, path, {s.name: s for s in known}))
    pick: dict[str, Column] = {
        "facet": docs.first_value("fields", "_hier_path"), "site": docs.first_value("fields", "site"),
    }
    return done.select(
        "id", "action", "root", *[c.alias(n) for n, c in pick.items()], F.md5("text").alias("text_md5"),
        docs.first_value("fields", "storage_account").alias("secret"),
    )
