"""Reads past a high-water mark over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental as inc
from ..plans.table_ingest import TableSource, drain, run_backlog, run_once
from ..session import shared_dir
from ..sinks.state import MarkStore
from .base import epoch_ms, query, table

_MARK, _SIZE = 500, 1000
_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderkey > {_MARK} ORDER BY o_orderkey LIMIT {_SIZE}
""")
def incremental_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.next_batch(
        table(spark, sf_dir, "orders"), "o_orderkey", _MARK, _SIZE, _COLUMNS, "o_orderstatus <> 'P'"
    )


@query(f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE l_orderkey > {_MARK} AND l_orderkey <= (
        SELECT max(l_orderkey) FROM (
            SELECT l_orderkey FROM lineitem WHERE l_orderkey > {_MARK} ORDER BY l_orderkey LIMIT {_SIZE}))
""")
def incremental_batch_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return inc.next_batch(table(spark, sf_dir, "lineitem"), "l_orderkey", _MARK, _SIZE, columns)


@query(f"""
    SELECT coalesce(max(o_orderkey), {_MARK}) AS hwm, count(*) AS rows FROM (
        SELECT o_orderkey FROM orders WHERE o_orderkey > {_MARK} ORDER BY o_orderkey LIMIT {_SIZE})
""")
def next_hwm(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = inc.next_batch(table(spark, sf_dir, "orders"), "o_orderkey", _MARK, _SIZE)
    return inc.next_mark(batch, "o_orderkey", _MARK)


@query(f"""
    SELECT batch, count(*) AS rows, min(o_orderkey) AS first_mark, max(o_orderkey) AS last_mark
    FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // {_SIZE} AS batch
          FROM orders WHERE o_orderkey > {_MARK}) GROUP BY batch
""")
def drain_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.plan_batches(table(spark, sf_dir, "orders"), "o_orderkey", _MARK, _SIZE)


@query(f"""
    SELECT batch, count(*) AS rows, min(l_orderkey) AS first_mark, max(l_orderkey) AS last_mark
    FROM (SELECT l_orderkey, (rank() OVER (ORDER BY l_orderkey) - 1) // {_SIZE} AS batch
          FROM lineitem WHERE l_orderkey > {_MARK}) GROUP BY batch
""")
def drain_batches_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.plan_batches(table(spark, sf_dir, "lineitem"), "l_orderkey", _MARK, _SIZE)


# Stored marks of three sources; the other two have none and start at 0.
_SOURCE_MARKS = [("1-URGENT", 946684800000), ("2-HIGH", 883612800000), ("5-LOW", 978307200000)]
_MARKS_SQL = "(VALUES " + ", ".join(f"('{s}', {m})" for s, m in _SOURCE_MARKS) + ") AS m(source, hwm)"
_DOCS_SQL = (
    "SELECT o_orderkey AS id, o_orderpriority AS source, o_orderstatus AS class, "
    "epoch_ms(o_orderdate) AS modified_ms FROM orders"
)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source"),
        F.col("o_orderstatus").alias("class"), epoch_ms("o_orderdate").alias("modified_ms"),
    )


def _marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_SOURCE_MARKS, "source string, hwm bigint")


@query(f"""
    SELECT d.id, d.source, d.class, d.modified_ms, coalesce(m.hwm, 0) AS hwm
    FROM ({_DOCS_SQL}) d LEFT JOIN {_MARKS_SQL} ON d.source = m.source
    WHERE d.modified_ms >= coalesce(m.hwm, 0)
""")
def recent_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.recent(_docs(spark, sf_dir), _marks(spark), "source", "modified_ms")


@query(_DOCS_SQL)
def full_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = _marks(spark).where("hwm < 0")
    return inc.recent(_docs(spark, sf_dir), none, "source", "modified_ms").drop("hwm")


@query(f"{_DOCS_SQL} ORDER BY modified_ms DESC, id LIMIT 25")
def first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.page(_docs(spark, sf_dir), "modified_ms", "id")


@query(f"{_DOCS_SQL} ORDER BY modified_ms DESC, id LIMIT 25 OFFSET 25")
def second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    last = inc.page(docs, "modified_ms", "id").tail(1)[0]
    return inc.page(docs, "modified_ms", "id", (last.modified_ms, last.id))


@query(f"""
    SELECT d.source, d.class, count(*) AS n_docs
    FROM ({_DOCS_SQL}) d LEFT JOIN {_MARKS_SQL} ON d.source = m.source
    WHERE d.modified_ms >= coalesce(m.hwm, 0) GROUP BY d.source, d.class
""")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.count_per(recent_by_source(spark, sf_dir), "source", "class")


@query("""
    SELECT 'orders' AS source, max(o_orderkey) AS hwm, count(*) AS id_count, min(o_orderkey) AS first_id
    FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 1000)
""")
def hwm_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over orders; the second starts at the mark the first one saved."""
    base = shared_dir(spark, "marks")
    marks = MarkStore(spark, f"{base}/state")
    marks.save_one("orders", 0, 0)
    source = TableSource("orders", "o_orderkey", ["o_orderkey"], ["o_orderkey", "o_orderstatus"], batch=_SIZE)
    orders = table(spark, sf_dir, "orders")
    run_once(orders, source, marks, f"{base}/out")
    middle = marks.get("orders")
    run_once(orders, source, marks, f"{base}/out")
    written = spark.read.text(f"{base}/out/orders/{middle}-*")
    ids = written.select(F.get_json_object("value", "$.id").cast("bigint").alias("id"))
    return ids.agg(F.count("id").alias("id_count"), F.min("id").alias("first_id")).select(
        F.lit("orders").alias("source"), F.lit(marks.get("orders")).cast("bigint").alias("hwm"), "id_count", "first_id"
    )


@query(f"SELECT l_orderkey || ',' || l_linenumber AS id, count(*) AS n_rows FROM lineitem WHERE l_orderkey > {_MARK} GROUP BY 1")
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items past the mark as documents, written by one job and read back."""
    base = shared_dir(spark, "backlog")
    marks = MarkStore(spark, f"{base}/state")
    marks.save_one("lines", _MARK, 0)
    source = TableSource("lines", "l_orderkey", ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber"])
    run_backlog(table(spark, sf_dir, "lineitem"), source, marks, f"{base}/out")
    written = spark.read.schema("id string").json(f"{base}/out/lines/*")
    return written.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT o_orderkey AS id, count(*) AS n_rows, (SELECT max(o_orderkey) FROM orders) AS hwm FROM orders GROUP BY o_orderkey")
def drain_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in a loop of batches until an empty one, about a third of the table each."""
    base = shared_dir(spark, "drain")
    marks = MarkStore(spark, f"{base}/state")
    orders = table(spark, sf_dir, "orders")
    source = TableSource("orders", "o_orderkey", ["o_orderkey"], ["o_orderkey"], batch=orders.count() // 3 + 1)
    drain(orders, source, marks, f"{base}/out")
    written = spark.read.schema("id string").json(f"{base}/out/orders/*")
    return written.groupBy(F.col("id").cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "hwm", F.lit(marks.get("orders")).cast("bigint"))


@query("""
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey <= (SELECT max(k) FROM (
        SELECT l_orderkey AS k FROM lineitem ORDER BY k LIMIT (SELECT count(*) // 3 + 1 FROM lineitem)))
    GROUP BY l_orderkey
""")
def third_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of a third of all line items, cut exactly without sorting them."""
    lines = table(spark, sf_dir, "lineitem")
    batch = inc.next_batch(lines, "l_orderkey", 0, lines.count() // 3 + 1, ["l_orderkey"])
    return batch.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_rows"))
