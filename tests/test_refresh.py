"""Refreshes wait for an idle stream and never pile up."""

import time

from tidemark.streaming.refresh import IdleListener, refresh_when_idle


def test_a_refresh_waits_for_the_work_before_it(spark, tmp_path):
    order = []

    def land(number):
        order.append(("seed", number))
        spark.range(5).selectExpr(f"'{number}' AS value").coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        return 5

    def work(batch, batch_id):
        time.sleep(1.0)
        order.append(("work", sorted({r.value for r in batch.collect()})))

    land("start")
    query = spark.readStream.text(f"{tmp_path}/in").writeStream.foreachBatch(work).option(
        "checkpointLocation", f"{tmp_path}/check").trigger(processingTime="100 milliseconds").start()
    try:
        assert refresh_when_idle(spark, query, land, 2, delay=0.1, timeout=60) == 2
    finally:
        query.stop()
    assert order == [("seed", "start"), ("work", ["start"]), ("seed", 0), ("work", ["0"]), ("seed", 1), ("work", ["1"])]


def test_no_roots_and_ended_queries_end_the_refreshes(spark, tmp_path):
    spark.range(1).selectExpr("'x' AS value").write.text(f"{tmp_path}/in")
    query = spark.readStream.text(f"{tmp_path}/in").writeStream.format("noop").option(
        "checkpointLocation", f"{tmp_path}/check").trigger(processingTime="100 milliseconds").start()
    try:
        assert refresh_when_idle(spark, query, lambda n: 0, 3, delay=0.0, timeout=60) == 0
    finally:
        query.stop()
    assert refresh_when_idle(spark, query, lambda n: 1, 1, delay=0.0, timeout=0.5) == 0
    assert not IdleListener().wait_idle(0, 0.1)
