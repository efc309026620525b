"""Streaming behaviour that a drained query cannot show."""

import time

from pyspark.sql import functions as F

from tilewright.streaming.manifest import STATE, barrier, publish_complete, ready_rows, run_to_table, settings, tapped_run

ARRIVAL = "id string, filename string, expected long"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, ARRIVAL).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(ARRIVAL).parquet(folder)


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_barrier_gives_up_after_the_wait(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [("a", "1", 3), ("a", "2", 3), ("a", "2", 3), ("b", "1", 2), ("b", "2", 2)]
    spark.createDataFrame(rows, "id string, filename string, expected long").coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("id string, filename string, expected long").parquet(path)
    writer = barrier(stream, "id", "filename", "expected", max_wait_secs=1).writeStream.format("memory").queryName("waits")
    with settings(spark, STATE):
        query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second").start()
    try:
        stop = time.time() + 90
        while spark.table("waits").count() < 2 and time.time() < stop:
            time.sleep(1)
        got = sorted(tuple(r) for r in spark.table("waits").collect())
    finally:
        query.stop()
    assert got == [("a", 2, "timed out"), ("b", 2, "complete")]


def test_finished_keys_leave_the_store(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def kept():
        with settings(spark, STATE):
            rows = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "arrived").load(state)
            return {r["key"]["id"] for r in rows.select("key").collect()}

    def run(*rows):
        stream = arrive(spark, folder, list(rows))
        run_to_table(barrier(stream, "id", "filename", "expected", max_wait_secs=1, keep_secs=1), target, state)

    run(("a", "1", 2), ("a", "2", 2), ("a", "2", 2), (None, "1", 1), ("n", None, 1))
    assert kept() == {"a"}
    time.sleep(3)
    run(("b", "1", None))
    assert kept() == {"b"}
    assert ids(spark.read.parquet(target), "id", "n_members", "status") == [("a", 2, "complete"), ("b", 1, "complete")]


def test_publish_reads_ready_partitions_only(spark, tmp_path, capsys):
    schema = "filename string, id string"
    staged, target = str(tmp_path / "staged"), str(tmp_path / "out")
    rows = [("1", "007"), ("2", "007"), ("1", "b c"), ("1", "x")]
    spark.createDataFrame(rows, schema).write.partitionBy("id").parquet(staged)
    table = spark.read.schema(schema).parquet(staged)
    done = spark.createDataFrame([("007", 2, "complete"), ("b c", 1, "late"), ("x", 1, "timed out")], "id string, n long, status string")
    ready_rows(table, done.where("id = '007'").select("id"), "id").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "007" in plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert ids(ready_rows(table, done.select("id"), "id", named_keys=1), "id", "filename") == sorted((i, f) for f, i in rows)
    assert ready_rows(table, done.where("false").select("id"), "id") is None
    publish = publish_complete(staged, target, "id", table.schema)
    for _ in range(2):  # a repeated batch changes nothing
        publish(done, 0)
    spark.createDataFrame([("3", "007")], schema).write.mode("append").partitionBy("id").parquet(staged)
    publish(done.where("id = '007'"), 1)
    assert ids(spark.read.schema(schema).parquet(target), "id", "filename") == [("007", "1"), ("007", "2"), ("007", "3"), ("b c", "1")]


def test_tap_tells_every_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in ([("a", "1", 2)], [("b", "1", 5), ("b", "2", None)]):
        arrive(spark, folder, part)
    stream = spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", 1).parquet(folder)
    out, seen = tapped_run(stream, str(tmp_path / "out"), str(tmp_path / "state"), {"n": F.count("*"), "most": F.max("expected")})
    assert out.count() == 3
    assert sorted(tuple(r)[1:] for r in seen.collect()) == [(1, 2), (2, 5)]
