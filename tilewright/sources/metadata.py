"""Tile metadata: stage XML, tile JSON, per-channel JSON, final positions."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import vectors

TILE_SCHEMA = (
    "acq_id string, tile_index bigint, pos_z double, pos_y double, pos_x double, "
    "size_z int, size_y int, size_x int, file string"
)
CHANNEL_SCHEMA = (
    "acq_id string, channel int, n_tiles bigint, n_blocks bigint, size_z bigint, size_y bigint, size_x bigint, n_bytes bigint"
)
#: Tiles in one file of positions.
TILES_PER_FILE = 1 << 18
POSITION_SCHEMA = "acq_id string, channel int, tile_index bigint, pos_z double, pos_y double, pos_x double"


def read_stage_metadata(spark: SparkSession, path: str, attributes: dict[str, str] | None = None) -> DataFrame:
    """One row per ``<Data>`` element: ``acq_id, tile_index, stage`` (x, y, z).

    ``attributes`` maps stage axis to XML attribute.  Tiles without an ``Index`` attribute
    are not guessed: their order in a split file is not stable.
    """
    names = {"x": "PositionX", "y": "PositionY", "z": "PositionZ", "index": "Index", "acq": "Acquisition"}
    names.update(attributes or {})
    schema = ", ".join(
        [f"_{names['acq']} string", f"_{names['index']} bigint", *[f"_{names[a]} double" for a in ("x", "y", "z")]]
    )
    rows = spark.read.format("xml").option("rowTag", "Data").schema(schema).load(path)
    return rows.select(
        F.col(f"_{names['acq']}").alias("acq_id"),
        F.col(f"_{names['index']}").alias("tile_index"),
        F.array(*[f"_{names[a]}" for a in ("x", "y", "z")]).alias("stage"),
    )


def parse_tiles(stage: DataFrame, resolution: str, axis_mapping: str) -> DataFrame:
    """Stage coordinates to pixel positions, from each acquisition's low corner.

    The minimum is a partial aggregate joined back, so one large acquisition is not one task.
    """
    pos = vectors.stage_to_pixel(F.col("stage"), vectors.parse_axes(F.lit(axis_mapping)), vectors.parse_vector(F.lit(resolution)))
    placed = stage.withColumn("pos", pos)
    low = placed.groupBy("acq_id").agg(*[F.min(F.col("pos")[k]).alias(f"low_{a}") for k, a in enumerate("xyz")])
    return placed.join(low, "acq_id").select(
        *[c for c in stage.columns if c != "stage"],
        *[(F.col("pos")[k] - F.col(f"low_{a}")).alias(f"pos_{a}") for k, a in enumerate("xyz")],
    )


def attach_files(tiles: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """The image file of each tile: the pattern with the tile's number, or the pattern itself."""
    return tiles.join(acquisitions.select("acq_id", "pattern"), "acq_id").select(
        *tiles.columns, F.expr("format_string(pattern, tile_index)").alias("file")
    )


def write_tile_metadata(tiles: DataFrame, path: str) -> None:
    tiles.write.mode("overwrite").json(path)


def read_tile_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TILE_SCHEMA).json(path)


def write_channel_metadata(channels: DataFrame, folder: str) -> None:
    """``<acquisition>/c<N>-n5.json`` below ``folder``, one directory per acquisition and channel."""
    _write_by_channel(channels, folder, "-n5.json", F.lit(0))


def read_channel_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``c*-n5.json``; final results (``c*-n5-final.json``) do not match."""
    return spark.read.schema(CHANNEL_SCHEMA).json(f"{folder}/*/c*-n5.json")


def write_positions(positions: DataFrame, channels: DataFrame, folder: str) -> None:
    """``<acquisition>/c<N>-n5-final.json``: the solved positions once per channel."""
    per_channel = channels.select("acq_id", "channel").distinct().join(positions, "acq_id")
    wanted = [c.split()[0] for c in POSITION_SCHEMA.split(", ")]
    _write_by_channel(per_channel.select(*wanted), folder, "-n5-final.json", F.floor(F.col("tile_index") / TILES_PER_FILE))


def read_positions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(POSITION_SCHEMA).json(f"{folder}/*/c*-n5-final.json")


def _write_by_channel(rows: DataFrame, folder: str, suffix: str, file_no: Column) -> None:
    """One partitioned write for all acquisitions and channels, then a rename for each of them.

    A channel's rows are spread over files by ``file_no``.  Renames happen after the whole write, so a failed job
    leaves earlier results as they are; a channel that is written again is replaced.
    """
    spark = rows.sparkSession
    staged = f"{folder}/_staged-{uuid4().hex}"
    named = rows.withColumns({"of_acq": F.col("acq_id"), "of_channel": F.col("channel")})
    named.repartition("acq_id", "channel", file_no).write.partitionBy("of_acq", "of_channel").json(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(path(f"{staged}/of_acq=*/of_channel=*")):
        written = status.getPath()
        acq, channel = (p.getName().split("=", 1)[1] for p in (written.getParent(), written))
        target = path(path(folder, acq), f"c{channel}{suffix}")
        system.mkdirs(target.getParent())
        system.delete(target, True)
        if not system.rename(written, target):
            raise OSError(f"can't move {written} to {target}")
    system.delete(path(staged), True)


def write_solve_log(log: DataFrame, path: str) -> None:
    """The optimiser log as text lines in round order."""
    lines = log.orderBy("acq_id", "iteration").select(
        F.format_string(
            "%s iteration=%d links=%d mean=%.6f max=%.6f", "acq_id", F.col("iteration").cast("long"), F.col("n_links"), "mean_err", "max_err"
        ).alias("value")
    )
    lines.write.mode("overwrite").text(path)
