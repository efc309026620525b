"""The manifest path as Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from threading import Event
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tilewright.operators.manifest import route_remote, validate
from tilewright.options import DEFAULTS
from tilewright.session import cut_lineage


def stream_sheet(spark: SparkSession, folder: str, columns: list[str], per_trigger: int = 1000) -> DataFrame:
    """Sheet rows as files arrive."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.readStream.option("header", True).option("escape", '"').option("maxFilesPerTrigger", per_trigger).schema(schema).csv(folder)
    )
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def validated_stream(rows: DataFrame) -> DataFrame:
    """The batch operators, unchanged: stateless validation and routing."""
    return route_remote(validate(rows, strict=False))


def distinct_stream(rows: DataFrame, columns: list[str], within: tuple[str, str] | None = None) -> DataFrame:
    """Each item once.  Without ``within`` (event-time column, delay) the state keeps every item."""
    if within is None:
        return rows.dropDuplicates(columns)
    return rows.withWatermark(*within).dropDuplicatesWithinWatermark(columns)


class Arrivals(StatefulProcessor):
    """Counts a key's distinct members, and says when they are complete, timed out or late.

    The count is a value with a time to live, so the store forgets a key ``keep_ms`` after its
    last change; a timer per waiting key ends the wait.
    """

    COUNT = "n long, need long, done boolean"

    def __init__(self, key: str, wait_ms: int, keep_ms: int) -> None:
        self.columns = [key, "n_members", "status"]
        self.wait_ms, self.keep_ms = wait_ms, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("arrived", self.COUNT, self.wait_ms + self.keep_ms)

    def _row(self, key: tuple, n: int, status: str) -> pd.DataFrame:
        return pd.DataFrame([(key[0], n, status)], columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.count.exists()
        n, need, done = self.count.get() if known else (0, 0, False)
        for part in rows:
            n += int(part["n"].sum())
            need = max(need, int(part["expected"].max()))
        ready = n >= need
        self.count.update((n, need, ready))
        waits = list(self.handle.listTimers())
        if ready:
            for at in waits:
                self.handle.deleteTimer(at)
            yield self._row(key, n, "late" if done else "complete")
        elif not waits:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.count.exists():
            yield self._row(key, self.count.get()[0], "timed out")

    def close(self) -> None:
        pass


def barrier(
    rows: DataFrame,
    key: str,
    member: str,
    expected: str,
    max_wait_secs: int = DEFAULTS["barrier_max_wait_secs"],
    keep_secs: int = 7 * 86400,
    within: tuple[str, str] | None = None,
) -> DataFrame:
    """``key, n_members, status`` when ``expected`` distinct members arrived, or after the wait.

    The wait of a key begins with its first members, and begins again with members that come
    after a time-out.  A key that timed out keeps its count and is complete once the rest arrives; members
    that arrive after that give a row of status ``late`` with the new count.  Rows without a key or a
    member are no arrivals; a missing ``expected`` asks for nothing.

    A key's count leaves the store ``keep_secs`` after the longest wait from its last change; a
    member that comes later still begins a new count.  ``within`` (event-time column, delay)
    lets the members leave the store too; without it they stay, so that a repeat is never
    counted.  Members are made distinct in the state store, spread by key and member; each
    partition counts its new ones, so a key with very many members is no burden to one task.
    """
    key_type = rows.schema[key].dataType
    wanted = F.coalesce(F.col(expected).cast("long"), F.lit(0)).alias("expected")
    when = [] if within is None else [within[0]]
    there = rows.where(F.col(key).isNotNull() & F.col(member).isNotNull())
    fresh = distinct_stream(there.select(key, member, wanted, *when), [key, member], within).select(key, "expected")
    partial = T.StructType(
        [T.StructField(key, key_type), T.StructField("n", T.LongType()), T.StructField("expected", T.LongType())]
    )

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for batch in batches:
            for k, part in batch.groupby(key):
                n, e = total.get(k, (0, 0))
                total[k] = (n + len(part), max(e, int(part["expected"].max())))
        yield pd.DataFrame([(k, n, e) for k, (n, e) in total.items()], columns=[key, "n", "expected"])

    out = T.StructType(
        [T.StructField(key, key_type), T.StructField("n_members", T.LongType()), T.StructField("status", T.StringType())]
    )
    processor = Arrivals(key, max_wait_secs * 1000, keep_secs * 1000)
    return (
        fresh.mapInPandas(count, partial)
        .groupBy(key)
        .transformWithStateInPandas(processor, out, outputMode="append", timeMode="ProcessingTime")
    )


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside; a started query keeps them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Keyed state with timers and times to live is kept by RocksDB.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def publish_complete(staged_path: str, target: str, key: str, schema: T.StructType, named_keys: int = 1000):
    """``foreachBatch`` sink: the rows of keys completed (or added to) in this batch, one partition each.

    ``staged_path`` is partitioned by ``key``, and a batch reads only the partitions of its
    ready keys: up to ``named_keys`` of them are named in the filter, more are joined.
    Overwriting a key's partition makes a repeated batch harmless.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        ready = cut_lineage(batch.where("status in ('complete', 'late')").select(key).distinct())
        rows = ready_rows(batch.sparkSession.read.schema(schema).parquet(staged_path), ready, key, named_keys)
        if rows is None:
            return
        rows.repartition(key, F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(16))).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(target)

    return publish


def ready_rows(staged: DataFrame, ready: DataFrame, key: str, named_keys: int = 1000) -> DataFrame | None:
    """Rows of the ready keys, none when no key is ready; few keys become a partition filter."""
    keys = [k for (k,) in ready.limit(named_keys + 1).collect()]
    if not keys:
        return None
    if len(keys) > named_keys:
        return staged.join(ready, key, "left_semi")
    return staged.where(F.col(key).isin(keys))


def drain(spark: SparkSession, writer) -> None:
    """Process what is there, then stop.

    A processing-time timer asks for another batch after every batch, so a drained query
    would never end: batches without data are switched off for it.  Waits then end in the
    next batch with data, of this run or a later one.
    """
    with settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false", **STATE}):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def run_to_table(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drain what is there into Parquet and return it."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    drain(stream.sparkSession, writer.outputMode(mode))
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


class Progress(StreamingQueryListener):
    """The metrics of one name, a row per micro-batch, as a query's progress tells them."""

    def __init__(self, name: str) -> None:
        self.name, self.rows, self.ended = name, [], Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.rows.append((event.progress.batchId, *seen))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def tapped_run(
    stream: DataFrame, target: str, checkpoint: str, metrics: dict[str, Column], wait_secs: int = 60
) -> tuple[DataFrame, DataFrame]:
    """Drain a stream into Parquet, and what a tap saw: ``batch_id`` and ``metrics`` of every batch with rows.

    Metrics are counted where the rows pass; no row is read a second time.  The driver holds
    one row of metrics per batch of this run.
    """
    spark = stream.sparkSession
    seen = Progress(f"tap-{uuid4().hex}")
    watched = stream.observe(seen.name, F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in metrics.items()])
    spark.streams.addListener(seen)
    try:
        out = run_to_table(watched, target, checkpoint)
        if not seen.ended.wait(wait_secs):
            raise TimeoutError("no word of the query's end")
    finally:
        spark.streams.removeListener(seen)
    schema = stream.groupBy().agg(*[c.alias(n) for n, c in metrics.items()]).schema
    full = T.StructType([T.StructField("batch_id", T.LongType()), *[T.StructField(f.name, f.dataType) for f in schema]])
    rows = {r[0]: (r[0], *r[2:]) for r in seen.rows if r[1]}
    return out, spark.createDataFrame(list(rows.values()), full)


def tap(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Watch rows pass without changing them; read the metrics after the action."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen
