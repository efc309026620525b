"""Versions files as text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.running import file_row_numbers
from tilewright.operators.report import parse_versions


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """``file, process, tool, version`` of every versions file below a path."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )
    numbered = file_row_numbers(lines, "line_no").withColumnRenamed("_file", "file")
    return parse_versions(numbered.select("file", "line_no", "value"))
