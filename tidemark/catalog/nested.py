"""Documents with nested folders, permissions, categories, attachments and comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    category_nodes, category_values as flatten_categories, folder_chain as chain, folder_path,
    normalise_root, permission_tokens as tokens,
)
from ..operators import chains
from ..operators import documents as docs
from ..operators import incremental as inc
from ..operators.index import apply_actions
from ..operators.numbering import row_number
from ..plans.api_ingest import next_marks, of_classes, plan_api
from ..session import shared_dir
from ..sinks.output import catalogue, write_catalogue
from ..model import LIBRARY
from ..sources.api import parse_documents
from .base import query, spread, table


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation and region; Spark sizes the two small sides itself."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))


_GEO_SQL = (
    "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


def _folder(identifier: Column, parent: Column, name: Column, root: bool, below_root: bool) -> Column:
    return F.struct(
        identifier.alias("folderId"), F.lit(None).cast("string").alias("fileId"),
        parent.alias("parentFolderId"), name.alias("name"),
        F.lit(root).alias("folderIsRoot"), F.lit(below_root).alias("parentFolderIsRoot"),
    )


def _folders() -> Column:
    """Region, nation and customer as a folder chain, leaf first."""
    region = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
    nation = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    customer = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    leaf = F.concat_ws("/", "c_mktsegment", "c_name")
    return F.array(
        _folder(customer, F.lower(nation), leaf, False, False),
        _folder(nation, region, F.col("n_name"), False, True),
        _folder(region, F.lit(None).cast("string"), F.col("r_name"), True, False),
    )


@query(f"""
    SELECT c_custkey, r_name || '/' || n_name || '/' || c_mktsegment || '%2F' || c_name AS folder_path
    FROM ({_GEO_SQL})
""")
def folder_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).select("c_custkey", folder_path(chain(_folders())).alias("folder_path"))


def _category_texts() -> Column:
    """Two chains in one array, an orphan, and one bare node, as landed JSON text."""
    def node(name: str, parent: str) -> Column:
        return F.struct(F.col(name).alias("name"), F.lit(parent).alias("parentId"))

    chains = F.array(node("r_name", "0"), node("n_name", "r"), node("c_mktsegment", "0"))
    orphan = F.array(node("c_name", "x"))
    return F.array(
        F.to_json(chains), F.to_json(orphan), F.to_json(F.struct(F.col("n_name").alias("name")))
    )


@query(f"""
    SELECT c_custkey, pos, value FROM (
        SELECT c_custkey, 0::BIGINT AS pos, r_name || '/' || n_name AS value FROM ({_GEO_SQL})
        UNION ALL SELECT c_custkey, 1, c_mktsegment FROM ({_GEO_SQL})
        UNION ALL SELECT c_custkey, 2, c_name FROM ({_GEO_SQL})
        UNION ALL SELECT c_custkey, 3, n_name FROM ({_GEO_SQL}))
""")
def category_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = flatten_categories(category_nodes(_category_texts()))
    rows = _geo(spark, sf_dir).select("c_custkey", F.posexplode(values).alias("pos", "value"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def _permission(kind: Column, value: Column, *roles: str) -> Column:
    return F.struct(
        kind.alias("type"), value.alias("value"), F.array(*[F.lit(r) for r in roles]).alias("roleNames")
    )


@query("""
    WITH s AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT s_suppkey, 0::BIGINT AS pos, 'GU:EVERYONE' AS token FROM s WHERE s_acctbal < 0
    UNION ALL SELECT s_suppkey, 0, 'GG:' || n_name FROM s WHERE s_acctbal BETWEEN 0 AND 9000
    UNION ALL SELECT s_suppkey, 1, 'GU:' || s_name FROM s WHERE s_acctbal BETWEEN 0 AND 9000
    UNION ALL SELECT s_suppkey, 2, 'GU:' || s_name FROM s WHERE s_acctbal BETWEEN 0 AND 9000
""")
def permission_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users, nations as groups; null, empty and duplicate grants occur."""
    grants = F.array(
        _permission(F.lit("USER"), F.col("s_name"), "Readers"),
        _permission(F.lit("group"), F.col("n_name"), "Owners", "Readers"),
        _permission(F.lit("user"), F.col("s_name"), "Readers"),
        _permission(F.lit("USER"), F.lit("editor"), "Editors"),
        _permission(F.lit("DOMAIN"), F.lit("all"), "Readers"),
    )
    permissions = F.when(F.col("s_acctbal") < 0, F.lit(None)).when(
        F.col("s_acctbal") > 9000, F.slice(grants, 1, 0)
    ).otherwise(grants)
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    opened = rows.select("s_suppkey", F.posexplode(tokens(permissions)).alias("pos", "token"))
    return opened.withColumn("pos", F.col("pos").cast("bigint"))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lpad(F.col("turn").cast("string"), 9, "0")
    author = F.when(
        F.col("role") != "system",
        F.struct(F.lit(None).cast("string").alias("email"), F.col("role").alias("name")),
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("documentId"),
        F.array(F.struct(
            stamp.alias("createdTime"), stamp.alias("modifiedTime"), F.col("text").alias("message"),
            author.alias("author"),
        )).alias("comments"),
    )


_COMMENT_SQL = """
    SELECT conv_id, turn, lpad(turn::VARCHAR, 9, '0') AS stamp, text AS message,
           CASE WHEN role <> 'system' THEN role END AS author FROM conversations
"""


@query(f"""
    SELECT conv_id AS doc_id, count(*) AS n_values,
           string_agg(concat_ws(' _ ', coalesce(author, 'null'), 'null', stamp, stamp, message), '|' ORDER BY turn) AS comments
    FROM ({_COMMENT_SQL}) GROUP BY conv_id
""")
def comment_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of each conversation, all in one text."""
    return docs.comments_joined(docs.comment_rows(_comments(spark, sf_dir)))


@query(f"""
    SELECT c_custkey AS id, c_custkey * 1000 AS last_modified, comments FROM customer LEFT JOIN (
        SELECT conv_id,
               string_agg(concat_ws(' _ ', coalesce(author, 'null'), 'null', stamp, stamp, message), '|' ORDER BY turn) AS comments
        FROM ({_COMMENT_SQL}) GROUP BY conv_id) ON conv_id = c_custkey
""")
def document_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their whole comment text, inserted into an empty index: a record for each."""
    found = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("doc_id"))
    rows = docs.attach_comments(found, docs.comments_joined(docs.comment_rows(_comments(spark, sf_dir)))).select(
        "id", F.lit("INSERT").alias("action"), (F.col("id") * 1000).alias("modified"), "comments")
    empty = rows.select("id", F.col("modified").alias("last_modified"), "comments").limit(0)
    return apply_actions(empty, rows, "id", "action", "modified", ["modified"], ["comments"])


@query(f"""
    SELECT conv_id AS doc_id, stamp AS created,
           json_object('author', author, 'authorEmail', NULL, 'createdTime', stamp, 'modifiedTime', stamp,
                       'message', message)::VARCHAR AS json
    FROM ({_COMMENT_SQL})
""")
def comment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.comments_json(docs.comment_rows(_comments(spark, sf_dir)))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as API documents in JSON text, parsed with the API schema."""
    key = F.col("c_custkey").cast("string")
    field = F.struct(
        F.lit("f1").alias("fieldId"), F.lit("Market").alias("fieldName"), F.lit("STRING").alias("type"),
        F.array("c_mktsegment", "n_name").alias("values"),
    )
    unnamed = F.struct(
        F.lit("f2").alias("fieldId"), F.lit(None).cast("string").alias("fieldName"),
        F.lit("STRING").alias("type"), F.array("c_name").alias("values"),
    )
    place = F.struct(
        F.lit("c1").alias("fieldId"), F.lit("MARKET").alias("fieldName"),
        F.array(F.array(
            F.struct(F.col("r_name").alias("name"), F.lit("0").alias("parentId")),
            F.struct(F.col("n_name").alias("name"), F.lit("7").alias("parentId")),
        )).alias("values"),
    )
    hidden = F.struct(
        F.lit("c2").alias("fieldId"), F.lit("Folder").alias("fieldName"), place["values"].alias("values")
    )

    def attachment(suffix: str, mime: str) -> Column:
        return F.struct(
            F.concat(key, F.lit(suffix)).alias("fileId"), F.concat(F.col("c_name"), F.lit(suffix)).alias("name"),
            F.lit(mime).alias("mimeType"), F.concat(F.lit("https://files.example.com/"), key, F.lit(suffix)).alias("link"),
            F.lit("icon.png").alias("iconLink"), F.lit("12").alias("size"),
        )

    attachments = F.array(attachment("-a", "text/plain"), attachment("-b", "application/pdf"))
    text = F.to_json(F.struct(
        key.alias("id"), F.lit("example.com").alias("domainName"),
        F.col("n_nationkey").cast("string").alias("libraryId"), F.col("n_name").alias("libraryName"),
        F.col("c_name").alias("title"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("unknown"))
        .otherwise((F.col("c_custkey") * 1000).cast("string")).alias("creationDate"),
        (F.col("c_custkey") * 1000 + 500).cast("string").alias("modificationDate"),
        F.col("c_mktsegment").alias("classId"), F.lower("c_mktsegment").alias("className"),
        _folders().alias("folders"),
        F.array(_permission(F.lit("GROUP"), F.col("n_name"), "Readers")).alias("permissions"),
        F.when(F.col("c_mktsegment") != "MACHINERY", attachments)
        .otherwise(F.slice(attachments, 1, 0)).alias("attachments"),
        F.array(field, unnamed).alias("fields"), F.array(place, hidden).alias("categories"),
    ))
    # Making and parsing one text costs far more than reading its row: a customer file is one task otherwise.
    return parse_documents(spread(_geo(spark, sf_dir)).select(text.alias("json")), "json").select("doc")


_BAD_DATE = "c_mktsegment = 'FURNITURE'"
_CREATED = f"CASE WHEN {_BAD_DATE} THEN 0 ELSE c_custkey * 1000 END"
_MODIFIED = f"CASE WHEN {_BAD_DATE} THEN 0 ELSE c_custkey * 1000 + 500 END"
_PATH = "r_name || '/' || n_name || '/' || c_mktsegment || '%2F' || c_name"
_URL = (
    "'https://docs.example.com/?locale=en_US&domain=example.com#Menu_viewDoc/LibraryId_' || n_nationkey "
    "|| '/DocumentId_' || c_custkey"
)


@query(f"""
    SELECT c_custkey::VARCHAR AS doc_id, 'example.com' AS domain, c_name AS title,
           n_nationkey::VARCHAR AS library_id, n_name AS library_name, {_CREATED} AS creation_ms,
           {_MODIFIED} AS modification_ms, {_PATH} AS folder_path, 'GG:' || n_name AS readers,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN 2 ELSE 0 END AS n_attachments
    FROM ({_GEO_SQL})
""")
def api_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = docs.api_documents(_landed(spark, sf_dir))
    return typed.select(
        "doc_id", "domain", "title", "library_id", "library_name", "creation_ms", "modification_ms",
        "folder_path", F.array_join("permissions", ",").alias("readers"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
    )


_METAS_SQL = f"""
    SELECT c_custkey::VARCHAR AS doc_id, v.field, v.pos::BIGINT AS pos, v.value FROM ({_GEO_SQL}),
    LATERAL (VALUES
        ('metas_docid', 0, c_custkey::VARCHAR), ('metas_domain', 0, 'example.com'), ('metas_title', 0, c_name),
        ('metas_libraryname', 0, n_name), ('metas_libraryid', 0, n_nationkey::VARCHAR),
        ('metas_creationdate', 0, ({_CREATED})::VARCHAR), ('last_modified_date', 0, ({_MODIFIED})::VARCHAR),
        ('metas_folderpath', 0, {_PATH}), ('metas_storage_account', 0, 'storage@example.com'),
        ('metas_classid', 0, c_mktsegment), ('metas_classname', 0, lower(c_mktsegment)),
        ('metas_viewurl', 0, {_URL}), ('metas_ao_permission', 0, 'GG:' || n_name),
        ('metas_market', 0, c_mktsegment), ('metas_market', 1, n_name),
        ('metas_market', 2, r_name || '/' || n_name)) AS v(field, pos, value)
"""


@query(_METAS_SQL)
def flat_metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = docs.flat_metas(docs.api_documents(_landed(spark, sf_dir)), "storage@example.com")
    return docs.to_long(made, "doc_id").withColumn("pos", F.col("pos").cast("bigint"))


# Stored marks of two libraries (nations); every other library is read in full.
_LIBRARY_MARKS = [("3", 400500), ("7", 900000)]
_LIBRARY_MARKS_SQL = "(VALUES " + ", ".join(f"('{s}', {m})" for s, m in _LIBRARY_MARKS) + ") AS m(source, hwm)"


@query(f"""
    SELECT c_custkey || suffix AS id, c_custkey::VARCHAR AS parent_id, c_name AS title, mime,
           'https://files.example.com/' || c_custkey || suffix AS url, 12 AS size,
           'API_' || n_name AS source, 'UPSERT' AS action, {_MODIFIED} AS last_modified_ms,
           c_name || suffix AS attachment_name, 'GG:' || n_name AS reader, {_PATH} AS folder_path
    FROM ({_GEO_SQL}) LEFT JOIN {_LIBRARY_MARKS_SQL} ON m.source = n_nationkey::VARCHAR,
         (VALUES ('-a', 'text/plain'), ('-b', 'application/pdf')) AS a(suffix, mime)
    WHERE c_mktsegment <> 'MACHINERY' AND {_MODIFIED} >= coalesce(m.hwm, 0)
""")
def attachment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole API plan: documents past their library's mark, one row per attachment."""
    marks = spark.createDataFrame(_LIBRARY_MARKS, "source string, hwm bigint")
    rows = plan_api(_landed(spark, sf_dir), marks, storage_account="storage@example.com")
    pick = {"attachment_name": "metas_attachmentname", "reader": "metas_ao_permission", "folder_path": "metas_folderpath"}
    return rows.select(
        "id", "parent_id", "title", "mime", "url", F.col("size").cast("bigint").alias("size"), "source", "action",
        "last_modified_ms", *[docs.first_value("fields", f).alias(n) for n, f in pick.items()],
    )


@query("SELECT DISTINCT n_nationkey::VARCHAR AS source, 1700000000000 AS hwm FROM customer JOIN nation ON c_nationkey = n_nationkey")
def library_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next mark of every library that was read: the time its query started."""
    return next_marks(docs.api_documents(_landed(spark, sf_dir)), 1700000000000)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as messages whose links are the attachments."""
    pattern = '<a href="([^"]*)">([^<]*)</a>'
    targets = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    names = F.regexp_extract_all("html", F.lit(pattern), F.lit(2))
    mime = lambda n: F.when(n.rlike(r"[,.]\z"), F.lit("Image/png")).when(n.rlike(r"\A[a-z]+\z"), F.lit("text/html"))
    attachments = F.transform(
        F.arrays_zip(targets.alias("link"), names.alias("name")),
        lambda a: F.struct(
            mime(a["name"]).alias("mime"),
            F.when(a["name"].rlike(r"\A[A-Za-z]"), a["name"]).alias("long_name"),
            F.when(F.length(a["name"]) > 5, a["name"]).alias("short_name"),
        ),
    )
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), attachments.alias("attachments"))


_LINK_SQL = """
    SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY pos) AS ordinal FROM (
        SELECT id, i AS pos, names[i] AS name FROM (
            SELECT id, names, unnest(generate_series(1, len(names))) AS i FROM (
                SELECT page_id::VARCHAR AS id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS names
                FROM pages)))
    WHERE NOT regexp_matches(name, '[,.]$')
"""
_CHILD_SQL = f"""
    SELECT id || ' -_ ' || CASE
               WHEN regexp_matches(name, '^[A-Za-z]') OR length(name) > 5
                   THEN regexp_replace(name, '[^a-zA-Z0-9.''_-]', '_', 'g')
               ELSE ' NO FILENAME [' || ordinal || ']' END AS id,
           id AS parent_id, ordinal FROM ({_LINK_SQL})
"""


@query(_CHILD_SQL)
def child_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs.expand_attachments(_links(spark, sf_dir))
    return rows.select("id", "parent_id", F.col("ordinal").cast("bigint").alias("ordinal"))


@query(f"""
    SELECT page_id::VARCHAR AS id, count(ordinal) AS n_attachments,
           string_agg(c.id, ',' ORDER BY ordinal) AS child_ids
    FROM pages p LEFT JOIN ({_CHILD_SQL}) c ON c.parent_id = p.page_id::VARCHAR GROUP BY page_id
""")
def child_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import child_documents

    children = child_documents("id", "attachments")
    joined = F.array_join(F.transform(children, lambda c: c["child_id"]), ",")
    return _links(spark, sf_dir).select(
        "id", docs.attachment_count().cast("bigint").alias("n_attachments"),
        F.when(F.size(children) > 0, joined).alias("child_ids"),
    )


def _class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as libraries and market segments as document classes, in landed class pages."""
    item = F.struct(F.col("c_mktsegment").alias("id"), F.lower("c_mktsegment").alias("displayName"))
    missing = F.struct(F.col("c_name").alias("id"), F.lit(None).cast("string").alias("displayName"))
    pages = _geo(spark, sf_dir).select(
        F.col("n_nationkey").cast("string").alias("libraryId"), F.col("n_name").alias("library_name"),
        F.col("r_name").alias("domainName"), F.lit("storage@example.com").alias("storageAdmin"),
        F.array(item, missing).alias("items"),
    )
    return docs.class_list(pages, ["libraryId", "library_name", "domainName", "storageAdmin"])


_CLASS_SQL = f"""
    SELECT DISTINCT n_nationkey::VARCHAR AS library_id, n_name AS library_name, r_name AS domain,
           c_mktsegment AS class_id, lower(c_mktsegment) AS class_name FROM ({_GEO_SQL})
"""


@query(f"SELECT library_id, class_id, class_name, class_id || ':::' || class_name AS token FROM ({_CLASS_SQL})")
def class_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _class_rows(spark, sf_dir).select(
        F.col("libraryId").alias("library_id"), "class_id", "class_name", "token"
    )


@query(_CLASS_SQL)
def library_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested catalogue written as JSON, read back as library pages and flattened."""
    out = shared_dir(spark, "catalogue")
    write_catalogue(_class_rows(spark, sf_dir), out)
    pages = spark.read.schema(LIBRARY).json(out)
    listed = pages.select(F.array(F.struct(*pages.columns)).alias("libraries"))
    rows = docs.library_classes(docs.libraries(listed))
    return rows.select(
        F.col("libraryId").alias("library_id"), "library_name", F.col("domainName").alias("domain"),
        "class_id", "class_name",
    )


@query(f"""
    SELECT library_id, '{{"libraryId":"' || library_id || '","name":"' || min(library_name) || '","domainName":"'
           || min(domain) || '","storageAdmin":"storage@example.com","documentTypes":{{"items":['
           || string_agg('{{"name":"' || class_name || '","value":"' || class_id || '"}}', ',' ORDER BY class_name)
           || ']}}}}' AS task
    FROM ({_CLASS_SQL}) GROUP BY library_id
""")
def library_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = docs.library_json(catalogue(_class_rows(spark, sf_dir)))
    return tasks.select(F.col("libraryId").alias("library_id"), "task")


@query("""
    SELECT DISTINCT 'smb://' || host || '/' AS id, '{"id":"smb://' || host || '/","level":0}' AS task
    FROM (SELECT string_split(regexp_replace(url, '^https?://', ''), '/')[1] AS host FROM pages)
""")
def seed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hosts as share roots, one task each."""
    host = F.substring_index(F.regexp_replace("url", "^https?://", ""), "/", 1)
    roots = table(spark, sf_dir, "pages").select(normalise_root(F.concat(F.lit("\\\\"), host)).alias("id")).distinct()
    return roots.select("id", F.to_json(F.struct("id", F.lit(0).alias("level"))).alias("task"))


@query(f"""
    SELECT n_nationkey::VARCHAR AS library_id, c_mktsegment AS class_id, count(*) AS n_docs
    FROM ({_GEO_SQL}) LEFT JOIN {_LIBRARY_MARKS_SQL} ON m.source = n_nationkey::VARCHAR
    WHERE {_MODIFIED} >= coalesce(m.hwm, 0) GROUP BY 1, 2
""")
def library_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found per library and class past the library's mark."""
    marks = spark.createDataFrame(_LIBRARY_MARKS, "source string, hwm bigint")
    typed = docs.api_documents(_landed(spark, sf_dir))
    classed = typed.withColumn("class_id", F.filter("default_fields", lambda e: e["name"] == "classid")[0]["values"][0])
    return inc.count_per(inc.recent(classed, marks, "library_id", "modification_ms"), "library_id", "class_id")


@query(f"""
    SELECT c_custkey::VARCHAR AS doc_id, n_nationkey::VARCHAR AS library_id, c_mktsegment AS class_id
    FROM ({_GEO_SQL}) WHERE (n_nationkey, c_mktsegment) IN (
      SELECT c_nationkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P')
""")
def class_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the classes that the catalogue lists for their library: those with an order in progress."""
    typed = docs.api_documents(_landed(spark, sf_dir))
    classed = typed.select(
        "doc_id", "library_id",
        F.filter("default_fields", lambda e: e["name"] == "classid")[0]["values"][0].alias("class_id"),
    )
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_custkey")
    listed = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_nationkey").cast("string").alias("libraryId"), F.col("c_mktsegment").alias("class_id")).distinct()
    return of_classes(classed, listed).select("doc_id", "library_id", "class_id")


_CHAIN_SQL = """
    WITH RECURSIVE e AS (
        SELECT event_id AS id, event_type AS name,
               lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS parent FROM events),
    nodes AS (SELECT * FROM e WHERE name <> 'error'),
    walk AS (
        SELECT id, id AS root, 0::BIGINT AS depth, name AS path,
               CASE WHEN parent IS NULL THEN 'whole' ELSE 'orphan' END AS status
        FROM nodes WHERE parent IS NULL OR parent NOT IN (SELECT id FROM nodes)
        UNION ALL
        SELECT n.id, w.root, w.depth + 1, w.path || '/' || n.name, w.status FROM nodes n JOIN walk w ON n.parent = w.id)
    SELECT * FROM walk
"""


@query(_CHAIN_SQL)
def event_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event below the one before it of its user, with its full path; errors are missing, what follows one is an orphan."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")
    numbered = row_number(events, ["user_id"], ["ts", "event_id"], "n")
    earlier = numbered.select("user_id", (F.col("n") + 1).alias("n"), F.col("event_id").alias("before"))
    nodes = numbered.where("event_type <> 'error'").join(earlier, ["user_id", "n"], "left")
    found = chains.chains(nodes, "event_id", "before", "event_type")
    return found.select("id", "root", "depth", F.array_join("path", "/").alias("path"), "status")
