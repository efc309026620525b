"""Fuse placed tiles into one block grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.operators.boxes import (
    BOX_FIELDS,
    CELL,
    CELL_FIELDS,
    ORIGIN,
    SHAPE,
    cells_covered,
    fields_of,
    pixels,
    reduce_boxes,
    split_to_grid,
    to_bytes,
)
from tilewright.session import cut_lineage

AXES = ("z", "y", "x")
KEYS = ["acq_id", "channel"]
# How many contributions one output block takes in one group before its tiles are salted.
GROUP_LIMIT = 64


def placed_tiles(tiles: DataFrame, positions: DataFrame, cell: tuple[int, int, int], reach: DataFrame | None = None) -> DataFrame:
    """Tiles at integer positions from the acquisition's low corner, its extent, and a salt count.

    ``salts`` is 1 unless many tiles pile up on one output block; then its tiles spread over
    about ``n / max(GROUP_LIMIT, sqrt(n))`` groups whose partial sums are merged afterwards.
    With ``reach``, sizes as the tiles' samples fill them, the extent ends with the last sample.
    """
    placed = tiles.select("acq_id", "tile_index", *[f"size_{a}" for a in AXES]).join(
        positions.select(
            "acq_id", "tile_index",
            *[F.floor(F.col(f"pos_{a}") + 0.5).cast("long").alias(f"p_{a}") for a in AXES],
        ),
        ["acq_id", "tile_index"],
    )
    ends = [F.col(f"size_{a}").alias(f"reach_{a}") for a in AXES]
    # A tile without samples counts with its place only.
    reached = (
        placed.select("*", *ends)
        if reach is None
        else placed.join(reach.select("acq_id", "tile_index", *ends), ["acq_id", "tile_index"], "left")
    )
    extent = reached.groupBy("acq_id").agg(
        *[F.min(f"p_{a}").alias(f"min_{a}") for a in AXES],
        *[F.max(F.col(f"p_{a}") + F.col(f"reach_{a}")).alias(f"max_{a}") for a in AXES],
    )
    placed = placed.join(extent, "acq_id").select(
        "acq_id", "tile_index",
        *[(F.col(f"p_{a}") - F.col(f"min_{a}")).alias(f"at_{a}") for a in AXES],
        *[F.col(f"size_{a}").cast("long").alias(f"tn_{a}") for a in AXES],
        *[(F.col(f"max_{a}") - F.col(f"min_{a}")).alias(f"ext_{a}") for a in AXES],
        *[f"min_{a}" for a in AXES],
    )
    cells = placed.select("acq_id", "tile_index", *[f"at_{a}" for a in AXES], *[f"tn_{a}" for a in AXES])
    for a, c, name in zip(AXES, cell, CELL):
        cells = cells.withColumn(name, F.explode(cells_covered(f"at_{a}", F.col(f"at_{a}") + F.col(f"tn_{a}"), c)))
    load = cells.groupBy("acq_id", *CELL).agg(F.count("*").alias("n")).where(F.col("n") > GROUP_LIMIT)
    if load.isEmpty():
        return placed.withColumn("salts", F.lit(1).cast("long"))
    group = F.greatest(F.lit(float(GROUP_LIMIT)), F.ceil(F.sqrt("n")))
    salts = (
        cells.join(load, ["acq_id", *CELL])
        .groupBy("acq_id", "tile_index")
        .agg(F.max(F.ceil(F.col("n") / group)).cast("long").alias("salts"))
    )
    return placed.join(salts, ["acq_id", "tile_index"], "left").withColumn(
        "salts", F.coalesce("salts", F.lit(1).cast("long"))
    )


def _ramp(lo: int, n: int, size: int) -> np.ndarray:
    """Linear weight along one tile axis: distance to the nearer border, plus one."""
    at = np.arange(lo, lo + n, dtype="int64")
    return np.minimum(at, size - 1 - at) + 1


class _Blend:
    """Running ``sum w v`` and ``sum w``; merging two of them is addition."""

    def __init__(self, shape):
        self.arrays = [np.zeros(shape, "<i8"), np.zeros(shape, "<i8")]

    def add(self, where, values, weights, tile):
        self.arrays[0][where] += weights * values
        self.arrays[1][where] += weights

    def merge(self, where, parts):
        for mine, other in zip(self.arrays, parts):
            mine[where] += other

    def result(self, fill):
        total, weight = self.arrays
        return np.where(weight > 0, (2 * total + weight) // np.maximum(2 * weight, 1), fill)


class _MaxWeight:
    """Value of the heaviest tile, ties to the lowest tile; merging keeps the heavier."""

    def __init__(self, shape):
        self.arrays = [np.zeros(shape, "<i8"), np.full(shape, np.iinfo("int64").max, "<i8"), np.zeros(shape, "<i8")]

    def add(self, where, values, weights, tile):
        self.merge(where, [weights, np.full(weights.shape, tile, "<i8"), values])

    def merge(self, where, parts):
        weight, tile, value = (a[where] for a in self.arrays)
        better = (parts[0] > weight) | ((parts[0] == weight) & (parts[1] < tile))
        for mine, other in zip((weight, tile, value), parts):
            mine[better] = other[better]

    def result(self, fill):
        return np.where(self.arrays[0] > 0, self.arrays[2], fill)


def fuse(
    blocks: DataFrame,
    tiles: DataFrame,
    positions: DataFrame,
    cell: tuple[int, int, int],
    blending: bool = True,
    fill: bool = True,
    reach: DataFrame | None = None,
) -> DataFrame:
    """Output blocks ``acq_id, channel, cell, box`` over the whole extent of each acquisition.

    Output coordinates start at the acquisition's low corner.  With ``fill``, voxels that no
    tile covers take the channel's background (its 1st percentile sample), otherwise 0.
    ``reach``: how far each tile's samples go, where the extent shall end with the last of them (``tile_sizes``).
    """
    placed = cut_lineage(placed_tiles(tiles, positions, cell, reach))
    facts = placed.agg(F.max("salts").alias("salts"), F.count("*").alias("n")).first()
    partial = (facts["salts"] or 1) > 1
    # Tile rows are metadata; they are broadcast to the blocks while their counted size is small.
    placed_side = F.broadcast(placed) if facts["n"] * 160 <= 256 << 20 else placed
    located = blocks.join(placed_side, ["acq_id", "tile_index"])
    for a in AXES:
        # Remember where the block lies inside its tile: the weights depend on it.
        located = located.withColumn(f"{a}0", F.col(f"{a}0") + F.col(f"at_{a}"))
    salt = F.pmod(F.xxhash64("tile_index"), F.col("salts"))
    located = located.withColumn("salt", salt)
    at = [f"at_{a}" for a in AXES]
    size = [f"tn_{a}" for a in AXES]
    extent = [f"ext_{a}" for a in AXES]
    crops = split_to_grid(located, cell, [*KEYS, "salt", "tile_index", *at, *size, *extent])

    channels = blocks.select(*KEYS).distinct()
    grid = placed.select("acq_id", *extent).distinct().join(channels, "acq_id")
    for a, c, name in zip(AXES, cell, CELL):
        grid = grid.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), ((F.col(f"ext_{a}") - 1) / c).cast("long"))))
    if fill:
        grid = grid.join(background(blocks), KEYS)
    else:
        grid = grid.withColumn("background", F.lit(0).cast("long"))

    kind = _Blend if blending else _MaxWeight
    n_arrays = 2 if blending else 3

    def frame(key_cell, ext):
        lo = [k * c for k, c in zip(key_cell, cell)]
        shape = [min(o + c, e) - o for o, c, e in zip(lo, cell, ext)]
        return lo, shape

    def spot(row, lo):
        return tuple(slice(getattr(row, o) - l, getattr(row, o) - l + getattr(row, n)) for o, n, l in zip(ORIGIN, SHAPE, lo))

    def accumulate(rows, cell_key):
        state, fill_value = None, 0
        for row in rows:
            if state is None:
                lo, shape = frame(cell_key, [getattr(row, e) for e in extent])
                state = kind(shape)
            if row.data is None:
                fill_value = row.background
                continue
            values = pixels(row.data, row.nz, row.ny, row.nx).astype("int64")
            ramps = [
                _ramp(getattr(row, o) - getattr(row, t), getattr(row, n), getattr(row, s))
                for o, t, n, s in zip(ORIGIN, at, SHAPE, size)
            ]
            weights = ramps[0][:, None, None] * ramps[1][None, :, None] * ramps[2][None, None, :]
            state.add(spot(row, lo), values, weights, row.tile_index)
        return state, lo, shape, fill_value

    # One row without samples per output block brings its extent and fill value.
    rows = crops.withColumn("background", F.lit(0).cast("long")).unionByName(
        grid.select(
            *[
                c if c in grid.columns else F.lit(None if c == "data" else 0).cast(crops.schema[c].dataType).alias(c)
                for c in crops.columns
            ],
            "background",
        )
    )
    out_fields = [*fields_of(crops, KEYS), *CELL_FIELDS, *BOX_FIELDS]
    out_schema = T.StructType(out_fields)

    def fuse_block(key, rows):
        state, lo, shape, value = accumulate(rows, key[len(KEYS) :])
        yield (*key, *lo, *shape, to_bytes(state.result(value)))

    if not partial:
        return reduce_boxes(rows, [*KEYS, *CELL], fuse_block, out_schema)

    part_names = [f"part_{i}" for i in range(n_arrays)]
    part_schema = T.StructType(
        [
            *fields_of(crops, KEYS), *CELL_FIELDS, T.StructField("background", T.LongType()),
            *BOX_FIELDS[:-1], *[T.StructField(p, T.BinaryType()) for p in part_names],
        ]
    )

    def partial_block(key, rows):
        state, lo, shape, value = accumulate(rows, key[len(KEYS) : -1])
        yield (*key[:-1], value, *lo, *shape, *[to_bytes(a, "<i8") for a in state.arrays])

    def merge_block(key, rows):
        state, value = None, 0
        for row in rows:
            shape, lo = (row.nz, row.ny, row.nx), (row.z0, row.y0, row.x0)
            state = state or kind(shape)
            value = max(value, row.background)
            parts = [pixels(getattr(row, p), *shape, "<i8") for p in part_names]
            state.merge(tuple(slice(0, n) for n in shape), parts)
        yield (*key, *lo, *shape, to_bytes(state.result(value)))

    parts = reduce_boxes(rows, [*KEYS, *CELL, "salt"], partial_block, part_schema)
    return reduce_boxes(parts, [*KEYS, *CELL], merge_block, out_schema)


def sample_counts(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, v, n``: how often each sample value occurs; counted per batch before the shuffle."""
    schema = T.StructType([*fields_of(blocks, keys), T.StructField("v", T.LongType()), T.StructField("n", T.LongType())])
    names = schema.fieldNames()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, rows in batch.groupby(keys, sort=False):
                n = np.bincount(np.concatenate([np.frombuffer(d, "<u2") for d in rows["data"]]))
                hit = np.flatnonzero(n)
                out.append(pd.DataFrame({**dict(zip(keys, key)), "v": hit, "n": n[hit]}, columns=names))
            if out:
                yield pd.concat(out, ignore_index=True)

    return blocks.select(*keys, "data").mapInPandas(count, schema).groupBy(*keys, "v").agg(F.sum("n").alias("n"))


def background(blocks: DataFrame, share: float = 0.01) -> DataFrame:
    """The channel's sample at rank ``ceil(share * n)``; at most 65,536 values per channel are ranked."""
    from pyspark.sql import Window

    counts = sample_counts(blocks, KEYS)
    upto = Window.partitionBy(*KEYS).orderBy("v")
    ranked = counts.select(
        *KEYS, "v", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy(*KEYS)).alias("total")
    )
    return ranked.where(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy(*KEYS).agg(
        F.min("v").cast("long").alias("background")
    )
