"""Block tables on disk, one directory per acquisition and channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = ["acq_id", "channel"]
ATTRIBUTES = {"n5": "2.2.0"}  # Fixed values: root attributes of a block container.


def write_blocks(blocks: DataFrame, path: str, extra_partition: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write boxes below ``path/blocks`` and a one-row attributes table beside them.

    Blocks of one channel are spread over many files, so a hot channel is not one task's work:
    the shuffle key includes the block's place.
    """
    partition = [*PARTITION, *extra_partition]
    place = [c for c in ("tile_index", "cz", "cy", "cx") if c in blocks.columns] or ["z0", "y0", "x0"]
    writer = blocks.repartition(*partition, *place).write.mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(f"{path}/blocks")
    spark = blocks.sparkSession
    spark.createDataFrame(list(ATTRIBUTES.items()), "name string, value string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/attributes")


def read_blocks(
    spark: SparkSession, path: str, acq_id: str | None = None, channel: int | None = None
) -> DataFrame:
    """Blocks of an acquisition or channel; the filters prune directories."""
    blocks = spark.read.parquet(f"{path}/blocks")
    if acq_id is not None:
        blocks = blocks.where(F.col("acq_id") == acq_id)
    if channel is not None:
        blocks = blocks.where(F.col("channel") == channel)
    return blocks


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, value string").json(f"{path}/attributes")


def write_field(field: DataFrame, path: str) -> None:
    """Flatfield boxes; an earlier result of the same acquisition and channel is replaced."""
    field.repartition(*PARTITION, "cy").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITION).parquet(path)


def write_pyramid(levels: DataFrame, path: str) -> None:
    """All levels of the export, one directory per acquisition, channel and level."""
    write_blocks(levels, path, ("level",))


def planes_from_files(spark: SparkSession, folder: str, shape: tuple[int, int], glob: str = "*.raw") -> DataFrame:
    """Raw little-endian uint16 planes as boxes: ``<acq>_t<tile>_c<channel>_z<plane>.raw``.

    Samples pass from the reader to the box column as they are; the names carry the place.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    part = lambda n: F.regexp_extract(name, r"^(.*)_t(\d+)_c(\d+)_z(\d+)\.", n)
    ny, nx = shape
    wrong = F.raise_error(F.concat(F.lit("unexpected size of "), F.col("path")))
    return files.select(
        part(1).alias("acq_id"),
        part(2).cast("long").alias("tile_index"),
        part(3).cast("int").alias("channel"),
        part(4).cast("long").alias("z0"),
        F.lit(0).cast("long").alias("y0"),
        F.lit(0).cast("long").alias("x0"),
        F.lit(1).alias("nz"),
        F.lit(ny).alias("ny"),
        F.lit(nx).alias("nx"),
        F.when(F.col("length") == ny * nx * 2, F.col("content")).otherwise(wrong.cast("binary")).alias("data"),
    )
