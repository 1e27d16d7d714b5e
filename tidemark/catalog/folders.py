"""Snapshot comparison and folder operators.

Line items act as the versions of files: the newest line of a path decides
whether the file exists (lines flagged ``N``) and how large it is. The stored
inventory is the state on a past day, the current listing the state of the
whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise_root
from ..operators import digests, intervals, recovery
from ..operators import inventory as inv
from ..operators.filters import PathRules
from ..plans.crawl import plan_crawl
from ..session import shared_dir
from ..sinks.buckets import BucketedInventory
from ..sinks.output import write_action_log
from ..streaming.folder_state import FolderState, in_slots, slot_of
from ..streaming.inventory_stream import InventoryTable, stream_listings
from ..streaming.refresh import refresh_when_idle
from .base import epoch_ms, query, table

_DAY = "1999-01-01"
_RULES = PathRules(exclude_names=(r".*/line7\.dat",), max_size=45)
_KEPT_SQL = "(NOT regexp_full_match(path, '.*/line7\\.dat') AND size < 45)"


def _path() -> Column:
    return F.concat(
        F.lit("/part/"), F.col("l_partkey").cast("string"), F.lit("/"), "l_linestatus",
        F.lit("/line"), F.col("l_linenumber").cast("string"), F.lit(".dat"),
    )


def _listing(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if until:
        lines = lines.where(F.col("l_shipdate") <= F.lit(until).cast("timestamp_ntz"))
    # Newest by time, then size, then flag. With numbers only, the aggregate stays
    # in a hash table; with structs or texts it would sort.
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    size, ms = F.col("l_quantity").cast("bigint"), epoch_ms("l_shipdate")
    version = inv.version(ms, size * 3 + flag)
    newest = lines.groupBy("l_partkey", "l_linestatus", "l_linenumber").agg(
        F.max(ms).alias("last_modified_ms"), F.max_by(size, version).alias("size"),
        F.max_by(flag, version).alias("flag"),
    )
    files = newest.where("flag = 1").select(_path().alias("path"), "last_modified_ms", "size")
    return inv.as_inventory(files)


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The listings of the past day and of now, from one pass over the lines that is written once.

    For queries that read a listing several times: each reading would aggregate all lines anew.
    """
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    size, ms = F.col("l_quantity").cast("bigint"), epoch_ms("l_shipdate")
    early = F.col("l_shipdate") <= F.lit(_DAY).cast("timestamp_ntz")
    # No row counts for an order that is null.
    orders = {"old": F.when(early, inv.version(ms, size * 3 + flag)), "new": inv.version(ms, size * 3 + flag)}
    times = {"old": F.when(early, ms), "new": ms}
    path = f"{shared_dir(spark, 'listings')}/files"
    table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linestatus", "l_linenumber").agg(*[
        c for when, order in orders.items() for c in (
            F.max(times[when]).alias(f"{when}_ms"), F.max_by(size, order).alias(f"{when}_size"),
            F.max_by(flag, order).alias(f"{when}_flag"))
    ]).where("old_flag = 1 or new_flag = 1").write.parquet(path)
    newest = spark.read.parquet(path)

    def listed(when: str) -> DataFrame:
        return inv.as_inventory(newest.where(F.col(f"{when}_flag") == 1).select(
            _path().alias("path"), F.col(f"{when}_ms").alias("last_modified_ms"), F.col(f"{when}_size").alias("size")))

    return listed("old"), listed("new")


def _listing_sql(until: str | None = None) -> str:
    where = f"WHERE l_shipdate <= TIMESTAMP '{until}'" if until else ""
    return f"""
        SELECT path, ms AS last_modified_ms, size FROM (
            SELECT *, row_number() OVER (PARTITION BY path ORDER BY ms DESC, size DESC, flag DESC) AS rn FROM (
                SELECT '/part/' || l_partkey || '/' || l_linestatus || '/line' || l_linenumber || '.dat' AS path,
                       epoch_ms(l_shipdate) AS ms, l_quantity::BIGINT AS size, l_returnflag AS flag
                FROM lineitem {where}))
        WHERE rn = 1 AND flag = 'N'"""


_PREV, _CUR = _listing_sql(_DAY), _listing_sql()

_DIFF_SQL = f"""
    SELECT path, status,
           CASE WHEN status IN ('insert', 'update', 'reject') THEN new_ms ELSE old_ms END AS last_modified_ms,
           CASE WHEN status IN ('insert', 'update', 'reject') THEN new_size ELSE old_size END AS size
    FROM (
        SELECT coalesce(p.path, c.path) AS path, p.last_modified_ms AS old_ms, p.size AS old_size,
               c.last_modified_ms AS new_ms, c.size AS new_size,
               CASE WHEN c.path IS NULL THEN 'delete'
                    WHEN NOT c.kept AND p.path IS NOT NULL THEN 'delete'
                    WHEN NOT c.kept THEN 'reject'
                    WHEN p.path IS NULL THEN 'insert'
                    WHEN p.last_modified_ms // 1000 < c.last_modified_ms // 1000 THEN 'update'
                    ELSE 'unchanged' END AS status
        FROM ({_PREV}) p FULL JOIN (SELECT *, {_KEPT_SQL} AS kept FROM ({_CUR})) c ON p.path = c.path)
"""
_APPLIED_SQL = f"""
    SELECT path, last_modified_ms, size FROM ({_DIFF_SQL}) WHERE status IN ('insert', 'update', 'unchanged')
"""


@query(_DIFF_SQL)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.diff(_listing(spark, sf_dir, _DAY), _listing(spark, sf_dir), _RULES)


@query(f"""
    SELECT upper(status) AS action, count(*) AS n_files, sum(size)::BIGINT AS total_size
    FROM ({_DIFF_SQL}) WHERE status <> 'reject' GROUP BY status
""")
def action_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows written by action and read back."""
    out = shared_dir(spark, "actions")
    changes = snapshot_diff(spark, sf_dir).where(F.col("status") != inv.REJECT)
    write_action_log(changes.withColumn("action", F.upper("status")).drop("status"), out)
    return spark.read.parquet(out).groupBy("action").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_size")
    )


@query(_APPLIED_SQL)
def inventory_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _listing(spark, sf_dir, _DAY)
    return inv.apply_changes(before, inv.diff(before, _listing(spark, sf_dir), _RULES))


@query(_APPLIED_SQL)
def inventory_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same inventory kept by a stream of listings; vanished folders arrive as empty ones."""
    return _streamed(spark, sf_dir, 1)


def _streamed(spark: SparkSession, sf_dir: str, batches: int) -> DataFrame:
    """The inventory after a stream over the listing, which arrives in so many batches of several files."""
    base = shared_dir(spark, "inventory")
    state, (before, now) = InventoryTable(spark, f"{base}/state"), _listings(spark, sf_dir)
    state.start_from(before)
    # Stored folders without a file now are listed as empty ones.
    rows = inv.complete_listing(now, "1", inv.parent_folders(before))
    files = spark.sparkContext.defaultParallelism
    rows.repartition(batches * files, "path").write.parquet(f"{base}/listing")
    listing = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/listing")
    stream_listings(listing, state, f"{base}/checkpoint", _RULES).awaitTermination()
    return state.read().select("path", "last_modified_ms", "size")


@query(_APPLIED_SQL)
def inventory_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, every folder's listing cut over three batches."""
    return _streamed(spark, sf_dir, 3)


@query(_APPLIED_SQL)
def inventory_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, kept in keyed state: three batches, every folder's listing cut over them, a restart in between."""
    base = shared_dir(spark, "inventory")
    state, (before, now) = FolderState(spark, f"{base}/state"), _listings(spark, sf_dir)
    in_slots(now, "1", state.slots, inv.parent_folders(before)).withColumn("part", slot_of("path", 3)).write.partitionBy(
        "part").parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    files = spark.sparkContext.defaultParallelism
    for parts in ([0], [1, 2]):
        for part in parts:
            rows.where(F.col("part") == part).drop("part").repartition(files).write.mode("append").parquet(f"{base}/listing")
        source = spark.readStream.schema(rows.drop("part").schema).option("maxFilesPerTrigger", files)
        state.stream(source.parquet(f"{base}/listing"), _RULES, before).awaitTermination()
    return state.read().select("path", "last_modified_ms", "size")


@query(_DIFF_SQL)
def bucketed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diff against stored files that lie in buckets: only the listing is shuffled."""
    stored = BucketedInventory(spark, shared_dir(spark, "buckets"))
    stored.save(_listing(spark, sf_dir, _DAY))
    return stored.diff(_listing(spark, sf_dir), _RULES)


@query(_APPLIED_SQL)
def bucketed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory after two partial crawls of all folders, each of which writes its own shards alone."""
    base = shared_dir(spark, "buckets")
    stored, (before, now) = BucketedInventory(spark, base), _listings(spark, sf_dir)
    stored.save(before)
    # Written once, as each half reads it several times.
    inv.complete_listing(now, "1", inv.parent_folders(before)).write.parquet(f"{base}/listing")
    rows = spark.read.parquet(f"{base}/listing")
    folder = F.when(F.col("is_dir"), F.col("path")).otherwise(F.col("parent"))
    for half in range(2):
        stored.apply(rows.where(F.pmod(stored.shard_of(folder), F.lit(2)) == half), _RULES, partial=True)
    return stored.read().select("path", "last_modified_ms", "size")


@query(_DIFF_SQL)
def digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diff with files compared only in folders whose digests differ."""
    return digests.digest_diff(*_listings(spark, sf_dir), _RULES)[0]


_STATES = [
    f"SELECT path[1:len(path) - len(string_split(path, '/')[-1]) - 1] AS folder, path, last_modified_ms // 1000 AS s, size "
    f"FROM ({listing}) WHERE {kept}" for listing, kept in ((_PREV, "true"), (_CUR, _KEPT_SQL))]


@query(f"""
    SELECT DISTINCT folder FROM (
        (({_STATES[0]}) EXCEPT ({_STATES[1]})) UNION ALL (({_STATES[1]}) EXCEPT ({_STATES[0]})))
""")
def changed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders whose own files differ from the stored ones, found from the roots downwards."""
    before, now = _listings(spark, sf_dir)
    return digests.descend(digests.own_digests(before), digests.own_digests(now.where(_RULES.keeps_entry()))).changed


_FOLDERS_SQL = f"""
    SELECT path, CASE WHEN status = 'delete' AND NOT in_now AND part_key % 3 = 0 THEN 'unchanged' ELSE status END AS status
    FROM (SELECT d.path, d.status, d.path IN (SELECT path FROM ({_CUR})) AS in_now,
                 CAST(string_split(d.path, '/')[3] AS BIGINT) AS part_key FROM ({_DIFF_SQL}) d)"""


@query(_FOLDERS_SQL)
def unreadable_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third part's folder cannot be read: stored files below it are no deletes."""
    before, now = _listing(spark, sf_dir, _DAY), _listing(spark, sf_dir).withColumn("readable", F.lit(True))
    parts = table(spark, sf_dir, "part").where("p_partkey % 3 = 0")
    closed = parts.select(
        F.concat(F.lit("/part/"), F.col("p_partkey").cast("string")).alias("path"), F.lit("/part").alias("parent"),
        F.col("p_partkey").cast("string").alias("name"), F.lit(True).alias("is_dir"),
        F.lit(0).cast("bigint").alias("last_modified_ms"), F.lit(0).cast("bigint").alias("size"),
        F.lit(False).alias("readable"),
    )
    return inv.diff(before, now.unionByName(closed), _RULES).select("path", "status")


@query(f"""
    SELECT DISTINCT folder FROM (
        SELECT path[1:len(path) - len(string_split(path, '/')[-1]) - 1] AS folder FROM ({_PREV}))
    WHERE folder NOT IN (SELECT path[1:len(path) - len(string_split(path, '/')[-1]) - 1] FROM ({_CUR}))
      AND CAST(string_split(folder, '/')[3] AS BIGINT) % 2 = 1
""")
def empty_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored folders without a file now: those of even parts are listed, empty, and so are not gone."""
    before, now = _listing(spark, sf_dir, _DAY), _listing(spark, sf_dir)
    parts = table(spark, sf_dir, "part").where("p_partkey % 2 = 0")
    listed = parts.select("p_partkey", F.explode(F.array(F.lit("F"), F.lit("O"))).alias("s"))
    folders = listed.select(
        F.concat(F.lit("/part/"), F.col("p_partkey").cast("string"), F.lit("/"), "s").alias("path"),
        F.concat(F.lit("/part/"), F.col("p_partkey").cast("string")).alias("parent"), F.col("s").alias("name"),
        F.lit(True).alias("is_dir"), F.lit(0).cast("bigint").alias("last_modified_ms"),
        F.lit(0).cast("bigint").alias("size"),
    )
    return inv.gone_folders(inv.parent_folders(before), inv.folders_of(now.unionByName(folders)))


@query(f"""
    SELECT path AS id, upper(status) AS action, string_split(path, '/')[-1] AS title,
           path[1:len(path) - len(string_split(path, '/')[-1]) - 1] AS parent_id, last_modified_ms, size
    FROM ({_DIFF_SQL}) WHERE status IN ('insert', 'update', 'delete')
""")
def crawl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document messages of one whole crawl."""
    plan = plan_crawl(_listing(spark, sf_dir), _listing(spark, sf_dir, _DAY), _RULES, "parts")
    return plan.documents.drop("source")


def _folders_sql(listing: str) -> str:
    return f"""
        SELECT DISTINCT array_to_string(parts[1:i], '/') AS folder
        FROM (SELECT parts, unnest(generate_series(2, len(parts) - 1)) AS i
              FROM (SELECT string_split(path, '/') AS parts FROM ({listing})))"""


@query(f"{_folders_sql(_CUR)} EXCEPT {_folders_sql(_PREV)}")
def new_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.new_folders(
        inv.folders_of(_listing(spark, sf_dir, _DAY)), inv.folders_of(_listing(spark, sf_dir))
    )


@query(f"{_folders_sql(_CUR)} INTERSECT {_folders_sql(_PREV)}")
def known_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.known_folders(
        inv.folders_of(_listing(spark, sf_dir, _DAY)), inv.folders_of(_listing(spark, sf_dir))
    )


@query(f"{_folders_sql(_PREV)} EXCEPT {_folders_sql(_CUR)}")
def gone_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.gone_folders(
        inv.folders_of(_listing(spark, sf_dir, _DAY)), inv.folders_of(_listing(spark, sf_dir))
    )


@query(f"SELECT '/part/' || p_partkey AS folder FROM part EXCEPT {_folders_sql(_CUR)}")
def missing_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queued part folders that the current listing no longer has."""
    roots = table(spark, sf_dir, "part").select(F.format_string("/part/%d", "p_partkey").alias("folder"))
    return inv.missing_roots(roots, inv.folders_of(_listing(spark, sf_dir)))


@query(f"""
    SELECT DISTINCT f.path FROM ({_PREV}) f
    JOIN ({_folders_sql(_PREV)} EXCEPT {_folders_sql(_CUR)}) g
      ON g.folder = regexp_replace(f.path, '/[^/]*$', '') OR g.folder = regexp_replace(f.path, '/[^/]*/[^/]*$', '')
""")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _listing(spark, sf_dir, _DAY)
    gone = inv.gone_folders(inv.folders_of(before), inv.folders_of(_listing(spark, sf_dir)))
    return inv.below(before, gone).select("path")


@query(f"""
    SELECT DISTINCT f.path FROM ({_PREV}) f
    JOIN ({_folders_sql(_PREV)} EXCEPT {_folders_sql(_CUR)}) g
      ON g.folder = regexp_replace(f.path, '/[^/]*$', '') OR g.folder = regexp_replace(f.path, '/[^/]*/[^/]*$', '')
""")
def cascade_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files under a vanished folder, by ranges of pre-order numbers."""
    before, now = _listings(spark, sf_dir)
    gone = inv.gone_folders(inv.folders_of(before), inv.folders_of(now))
    return intervals.below(before, gone).select("path")


def _entries(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """One entry per part: a folder while its newest line is open, a file once it is finished."""
    lines = table(spark, sf_dir, "lineitem")
    if until:
        lines = lines.where(F.col("l_shipdate") <= F.lit(until).cast("timestamp_ntz"))
    newest = lines.groupBy(F.format_string("/part/%d", "l_partkey").alias("path")).agg(
        F.max(F.struct(epoch_ms("l_shipdate").alias("ms"), F.col("l_linestatus").alias("s"))).alias("v")
    )
    return newest.select("path", (F.col("v.s") == "O").alias("is_dir"), F.col("v.ms").alias("last_modified_ms"))


def _entries_sql(until: str | None = None) -> str:
    where = f"WHERE l_shipdate <= TIMESTAMP '{until}'" if until else ""
    return f"""
        SELECT '/part/' || l_partkey AS path, max(l_shipdate) AS at,
               max(concat(strftime(l_shipdate, '%Y%m%d'), l_linestatus))[9:9] = 'O' AS is_dir
        FROM lineitem {where} GROUP BY l_partkey"""


@query(f"""
    SELECT c.path, epoch_ms(c.at) AS last_modified_ms,
           CASE WHEN regexp_full_match(c.path, '.*9') THEN 'REJECT' ELSE 'INSERT' END AS action
    FROM ({_entries_sql()}) c JOIN ({_entries_sql(_DAY)}) p ON c.path = p.path
    WHERE p.is_dir AND NOT c.is_dir
""")
def folder_to_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = PathRules(exclude_names=(".*9",))
    found = inv.folder_to_file(_entries(spark, sf_dir, _DAY), _entries(spark, sf_dir), rules)
    return found.select("path", "last_modified_ms", "action")


_PARENT_SQL = """
    SELECT DISTINCT regexp_replace(id, '/[^/]*$', '') AS folder
    FROM (SELECT regexp_replace(url, '[?#].*$', '') AS id FROM pages)
"""
_LEAF_SQL = f"""
    SELECT f.folder FROM ({_PARENT_SQL}) f
    WHERE NOT EXISTS (SELECT 1 FROM ({_PARENT_SQL}) g WHERE starts_with(g.folder, f.folder || '/'))
"""


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.regexp_replace("url", r"[?#].*$", "").alias("id"))


@query(_PARENT_SQL)
def parent_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.parent_folders(_index(spark, sf_dir), "id")


@query(_LEAF_SQL)
def leaf_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.leaf_folders(inv.parent_folders(_index(spark, sf_dir), "id"))


@query(f"""
    SELECT f.folder, (SELECT count(*) FROM ({_PARENT_SQL}) g
                      WHERE g.folder = f.folder OR starts_with(g.folder, f.folder || '/')) AS n_folders
    FROM ({_PARENT_SQL}) f
""")
def subtree_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders at and below each folder: the length of its interval."""
    found = intervals.labels(inv.parent_folders(_index(spark, sf_dir), "id"))
    return found.select("folder", (F.col("last") - F.col("first") + 1).alias("n_folders"))


@query(_LEAF_SQL)
def leaf_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders whose interval is one number."""
    return intervals.leaves(intervals.labels(inv.parent_folders(_index(spark, sf_dir), "id")))


@query(f"SELECT folder || '/' AS id, '{{\"id\":\"' || folder || '/\",\"level\":99}}' AS task FROM ({_LEAF_SQL})")
def recovery_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.task_json(inv.recovery_tasks(_index(spark, sf_dir)))


@query("""
    SELECT '/orders/' || o_orderkey AS id,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE epoch_ms(o_orderdate) END AS lastmod
    FROM orders
""")
def recovery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    index = table(spark, sf_dir, "orders").select(
        F.format_string("/orders/%d", "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(stamp).alias("last_modified"),
    )
    return inv.recovery_rows(index)


_INDEX_DAY = "1998-06-01"


@query(f"""
    SELECT path, kind, CASE WHEN kind IN ('lost', 'new') THEN 'INSERT' WHEN kind = 'stale' THEN 'UPDATE'
                            WHEN kind = 'ghost' THEN 'DELETE' END AS action, last_modified_ms, size
    FROM (
        SELECT coalesce(l.path, s.path, i.path) AS path,
               CASE WHEN l.path IS NOT NULL AND i.path IS NULL AND s.path IS NOT NULL THEN 'lost'
                    WHEN l.path IS NOT NULL AND i.path IS NULL THEN 'new'
                    WHEN l.path IS NOT NULL AND i.last_modified_ms // 1000 < l.last_modified_ms // 1000 THEN 'stale'
                    WHEN l.path IS NOT NULL AND s.path IS NOT NULL AND s.size = l.size
                         AND s.last_modified_ms // 1000 = l.last_modified_ms // 1000 THEN 'agreed'
                    WHEN l.path IS NOT NULL THEN 'unstored' WHEN i.path IS NOT NULL THEN 'ghost'
                    ELSE 'forgotten' END AS kind,
               coalesce(l.last_modified_ms, s.last_modified_ms, i.last_modified_ms) AS last_modified_ms,
               coalesce(l.size, s.size, 0) AS size
        FROM (SELECT * FROM ({_CUR}) WHERE {_KEPT_SQL}) l
        FULL JOIN ({_PREV}) s ON l.path = s.path
        FULL JOIN ({_listing_sql(_INDEX_DAY)}) i ON coalesce(l.path, s.path) = i.path)
""")
def recovery_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of one day, the inventory of another and today's listing, with the way in which they disagree."""
    exported = _listing(spark, sf_dir, _INDEX_DAY).select(F.col("path").alias("id"), "last_modified_ms")
    found = recovery.reconcile(exported, _listing(spark, sf_dir, _DAY), _listing(spark, sf_dir), _RULES)
    return found.merged.drop("listed")


@query(f"""
    SELECT folder || '/' AS id, len(string_split(folder, '/')) - 2 AS level FROM ({_folders_sql(_CUR)})
""")
def folder_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl tasks of every listed folder with their depth below the root."""
    tasks = inv.tasks(inv.folders_of(_listing(spark, sf_dir)), root="/part")
    return tasks.withColumn("level", F.col("level").cast("bigint"))


@query("""
    SELECT seed, count(*) AS n_tasks
    FROM (SELECT DISTINCT string_split(regexp_replace(url, '^https?://', ''), '/')[1] AS host FROM pages), range(3) AS t(seed)
    GROUP BY seed
""")
def refresh_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots seeded once and refreshed twice, each time when the stream over the tasks is idle."""
    base = shared_dir(spark, "refresh")
    host = F.substring_index(F.regexp_replace("url", "^https?://", ""), "/", 1)
    roots = table(spark, sf_dir, "pages").select(normalise_root(F.concat(F.lit("\\\\"), host)).alias("id")).distinct()

    def seed(number: int) -> int:
        tasks = roots.select("id", F.lit(0).alias("level"), F.lit(number).cast("bigint").alias("seed"))
        tasks.select(F.to_json(F.struct("id", "level", "seed")).alias("value")).coalesce(1).write.mode("append").text(f"{base}/in")
        return tasks.count()

    seed(0)
    # An idle stream says so every half second; the default is every ten.
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "500")
    messages = spark.readStream.text(f"{base}/in")
    query = messages.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option(
        "path", f"{base}/out").trigger(processingTime="200 milliseconds").start()
    try:
        refresh_when_idle(spark, query, lambda n: seed(n + 1), 2, delay=0.2, timeout=120)
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    found = spark.read.schema("value string").parquet(f"{base}/out")
    return found.groupBy(F.get_json_object("value", "$.seed").cast("bigint").alias("seed")).agg(F.count(F.lit(1)).alias("n_tasks"))
