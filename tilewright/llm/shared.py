"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.session import shared_dir, ship_package, staging_path

#: The white space of the word rule, for Java and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"


#: Most rows and bytes of one Arrow batch: texts are long, and tasks hold a batch or two.
BATCH_ROWS, BATCH_BYTES = 4000, 16 << 20


def prepare(spark: SparkSession) -> None:
    """Package for the Python workers, and Arrow batches that are small enough for long texts."""
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        known = spark.conf.get(name, None)
        now = int(known) if known and known.lstrip("-").isdigit() else 0
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A job that runs inside leaves no shuffle files: they go when it ends, not when the driver's collector finds them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later plans start from the files."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or what it takes behind it to be no column of ``df``, in any case of letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(column, modulus: int, remainder: int):
    """crc32 of the id as text falls on the remainder; a null id is not held out."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


__all__ = ["SPACE", "free_name", "held_out", "prepare", "shared_dir", "shuffles_dropped", "staging_path", "stored", "table"]
