"""Tile planes to chunked blocks, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators.boxes import merge_cells, split_to_grid

TILE = ["acq_id", "tile_index", "channel"]


def convert_to_blocks(planes: DataFrame, cell: tuple[int, int, int]) -> DataFrame:
    """One box per (tile, channel, block); the last block of an axis is truncated."""
    return merge_cells(split_to_grid(planes, cell, TILE), TILE)


def channel_metadata(blocks: DataFrame) -> DataFrame:
    """One row per acquisition and channel: extent, tiles, blocks and bytes.

    Only the box columns are read; ``length(data)`` is the one use of the payload, so it is
    taken from the shape instead.
    """
    voxels = F.col("nz").cast("long") * F.col("ny") * F.col("nx")
    return blocks.groupBy("acq_id", "channel").agg(
        F.count_distinct("tile_index").alias("n_tiles"),
        F.count("*").alias("n_blocks"),
        F.max(F.col("z0") + F.col("nz")).alias("size_z"),
        F.max(F.col("y0") + F.col("ny")).alias("size_y"),
        F.max(F.col("x0") + F.col("nx")).alias("size_x"),
        F.sum(voxels * 2).alias("n_bytes"),
    )


def tile_sizes(blocks: DataFrame) -> DataFrame:
    """``acq_id, tile_index, size_z, size_y, size_x`` from the blocks' extents."""
    return blocks.groupBy("acq_id", "tile_index").agg(
        *[F.max(F.col(f"{a}0") + F.col(f"n{a}")).alias(f"size_{a}") for a in ("z", "y", "x")]
    )
