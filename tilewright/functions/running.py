"""Running sums whose order runs across more rows than one task should hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sum(
    df: DataFrame, keys: list[str], order: str, values: dict[str, str], chunk: int = 1 << 16
) -> DataFrame:
    """``values``: output name -> input column; inclusive running sums by ``order`` (a non-negative integer, unique per key).

    Two levels: inside chunks of the order, then over one total per chunk.  No task sees
    more than ``chunk`` rows of a key, plus one row per chunk.
    """
    part = F.floor(F.col(order) / chunk)
    rows = df.withColumn("_chunk", part)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_chunk").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in values.items()])
    totals = totals.select(
        *keys, "_chunk",
        *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in values],
    )
    sums = rows.select("*", *[F.sum(c).over(inside).alias(f"_i_{o}") for o, c in values.items()])
    joined = sums.join(totals, [*keys, "_chunk"])
    return joined.select(*df.columns, *[(F.col(f"_i_{o}") + F.col(f"_b_{o}")).alias(o) for o in values])


def file_row_numbers(df: DataFrame, name: str = "line_no", first: int = 1, across_files: bool = False) -> DataFrame:
    """Number rows in file order without sorting them into one task.

    ``df`` must carry ``_file`` and ``_start`` (file name and split start of each row, from
    ``_metadata``).  Rows of one split keep their read order; splits are numbered by their
    place in the file, or through all files by name with ``across_files``.  What is ranked
    is one row per split, not one per line.
    """
    rows = df.withColumn("_seq", F.monotonically_increasing_id())
    # Within a split ids are consecutive, so the offset from the split's first id is exact.
    splits = rows.groupBy("_file", "_start").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    window = Window.orderBy("_file", "_start") if across_files else Window.partitionBy("_file").orderBy("_start")
    before = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("_file", "_start", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.join(splits, ["_file", "_start"])
    number = F.col("_seq") - F.col("_first") + F.col("_before") + F.lit(first)
    return numbered.select(*df.columns, number.cast("long").alias(name))
