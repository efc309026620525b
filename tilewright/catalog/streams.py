"""Streaming queries: files are staged from the given tables, drained, and returned as a table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.catalog import views as V
from tilewright.session import staging_path
from tilewright.streaming import manifest as S

SHEET_COLUMNS = ["line_no", "id", "filename", "pattern", "checksum", "uri"]


def _staged_parquet(rows: DataFrame, name: str, files: int = 4) -> str:
    path = staging_path(rows.sparkSession, name)
    rows.repartition(files).write.parquet(path)
    return path


def _parquet_stream(spark: SparkSession, path: str, per_trigger: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def stream_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "sheet-in")
    V.sheet(spark, sf_dir).select(*SHEET_COLUMNS).repartition(4).write.options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    rows = S.validated_stream(S.stream_sheet(spark, folder, SHEET_COLUMNS, per_trigger=2))
    out = S.run_to_table(rows, staging_path(spark, "sheet-out"), staging_path(spark, "sheet-state"))
    return out.select(F.col("line_no").cast("long").alias("line_no"), "id", "filename", "route")


STREAM_MANIFEST = f"""with {V.VALID}
select line_no, id, filename, case when uri <> '' then 'remote' else 'local' end as route from valid"""


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged_parquet(V.version_rows(spark, sf_dir), "versions-in")
    rows = S.distinct_stream(_parquet_stream(spark, source), ["process", "tool", "version"])
    out = S.run_to_table(rows, staging_path(spark, "versions-out"), staging_path(spark, "versions-state"))
    return out.select("process", "tool", "version")


STREAM_DISTINCT = f"with {V.VERSION_ROWS} select distinct process, tool, version from version_rows"


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    """Files of acquisitions with the number to wait for; every other acquisition waits in vain."""
    rows = V.sheet(spark, sf_dir).where("id <> '' and filename <> ''").select("id", "filename", "line_no")
    need = rows.groupBy("id").agg(F.count_distinct("filename").alias("n"), F.min("line_no").alias("first"))
    expected = F.when(F.col("first") % 2 == 0, F.col("n")).otherwise(F.col("n") + 1)
    return _staged_parquet(rows.join(need, "id").select("id", "filename", expected.alias("expected")), "arrivals", 3)


def _barrier(spark: SparkSession, path: str) -> DataFrame:
    return S.barrier(_parquet_stream(spark, path), "id", "filename", "expected")


def stream_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _barrier(spark, _arrivals(spark, sf_dir))
    return S.run_to_table(done, staging_path(spark, "barrier-out"), staging_path(spark, "barrier-state"))


_NEED = V.SHEET + """,
need as (select id, count(distinct filename) as n, min(line_no) as first from sheet where id <> '' and filename <> '' group by id)"""
STREAM_BARRIER = f"with {_NEED} select id, n as n_members, 'complete' as status from need where first % 2 = 0"


def _late_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    """Arrivals in two folders.  By its first line, an acquisition is complete with its files but
    the last one, which comes late (two of three), or waits for one more file than there is."""
    rows = V.sheet(spark, sf_dir).where("id <> '' and filename <> ''").select("id", "filename", "line_no")
    need = rows.groupBy("id").agg(
        F.count_distinct("filename").alias("n"), F.min("line_no").alias("first"), F.max("filename").alias("last")
    )
    waits = F.col("first") % 3 == 2
    late = ~waits & (F.col("filename") == F.col("last")) & (F.col("n") > 1)
    expected = F.when(waits, F.col("n") + 1).when(F.col("n") > 1, F.col("n") - 1).otherwise(1)
    every = rows.join(need, "id").select("id", "filename", expected.alias("expected"), late.alias("late"))
    parts = [_staged_parquet(every.where(c).drop("late"), "late-arrivals", 2) for c in ("not late", "late")]
    return parts[0], parts[1], every.drop("late")


def _in_turns(spark: SparkSession, sf_dir: str, start) -> DataFrame:
    """First arrivals, then, when the waits are over, the late ones; ``start`` drains the statuses each time."""
    first, second, every = _late_arrivals(spark, sf_dir)
    source = staging_path(spark, "arrivals-in")
    schema = spark.read.parquet(first).schema
    for folder in (first, second):
        spark.read.schema(schema).parquet(folder).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
        start(S.barrier(stream, "id", "filename", "expected", max_wait_secs=2))
        time.sleep(3)
    return every


def stream_barrier_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three statuses: complete, late members counted on top, and waits that end without the rest."""
    target, state = staging_path(spark, "late-out"), staging_path(spark, "late-state")
    _in_turns(spark, sf_dir, lambda statuses: S.run_to_table(statuses, target, state))
    return spark.read.parquet(target).select("id", "n_members", "status")


_TURNS = V.SHEET + """,
need as (select id, count(distinct filename) as n, min(line_no) as first, max(filename) as last
  from sheet where id <> '' and filename <> '' group by id)"""
STREAM_BARRIER_LATE = f"""with {_TURNS}
select id, n as n_members, 'timed out' as status from need where first % 3 = 2
union all select id, greatest(n - 1, 1), 'complete' from need where first % 3 <> 2
union all select id, n, 'late' from need where first % 3 <> 2 and n > 1"""


def _staged_by_key(rows: DataFrame) -> str:
    path = staging_path(rows.sparkSession, "staged")
    rows.repartition("id").write.partitionBy("id").parquet(path)
    return path


def _published(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("filename string, expected bigint, id string").parquet(target).select("id", "filename")


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each acquisition's rows published by themselves once it is complete, late members included."""
    target, state = staging_path(spark, "published"), staging_path(spark, "publish-state")
    every = _late_arrivals(spark, sf_dir)[2]
    staged = _staged_by_key(every)
    sink = S.publish_complete(staged, target, "id", every.schema)

    def publish(statuses: DataFrame) -> None:
        S.drain(spark, statuses.writeStream.foreachBatch(sink).option("checkpointLocation", state))

    _in_turns(spark, sf_dir, publish)
    return _published(spark, target)


STREAM_PUBLISH = f"""with {_TURNS}
select id, filename from sheet join need using (id) where filename <> '' and need.first % 3 <> 2"""


def stream_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tap on the trace saw, batch by batch, while a stream wrote the rows; summed over the batches."""
    source = _staged_parquet(V.run_trace(spark, sf_dir), "trace-in")
    metrics = {
        "n": F.count(F.lit(1)), "failed": F.count_if(F.col("status") == "failed"), "last_run": F.max("run_id"),
    }
    _, seen = S.tapped_run(
        _parquet_stream(spark, source), staging_path(spark, "tapped"), staging_path(spark, "tap-state"), metrics
    )
    return seen.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.max("last_run").alias("last_run"))


STREAM_TAP = f"with {V.RUN_TRACE} select count(*) as n, count(*) filter (where status = 'failed') as failed, max(run_id) as last_run from run_trace"


QUERIES = {
    "stream_manifest": (stream_manifest, STREAM_MANIFEST),
    "stream_distinct": (stream_distinct, STREAM_DISTINCT),
    "stream_barrier": (stream_barrier, STREAM_BARRIER),
    "stream_barrier_late": (stream_barrier_late, STREAM_BARRIER_LATE),
    "stream_publish": (stream_publish, STREAM_PUBLISH),
    "stream_tap": (stream_tap, STREAM_TAP),
}
