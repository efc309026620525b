"""Multi-resolution pyramid of a fused block table."""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.operators.boxes import BOX_FIELDS, CELL, CELL_FIELDS, ORIGIN, SHAPE, broadcast_if_bounded, fields_of, held_parts, map_boxes, paste_held, pixels, plane_runs, reduce_boxes, to_bytes
from tilewright.session import cut_lineage

KEYS = ["acq_id", "channel"]


def level_factors(
    size: tuple[int, int, int], resolution: tuple[float, float, float], block: tuple[int, int, int]
) -> list[tuple[int, int, int]]:
    """Per level above 0, the z,y,x factor against the level before it.

    x and y halve every time; z halves too when that brings its sample spacing nearer to
    that of x.  Stops when every axis fits one block.
    """
    sz, _, sx = resolution
    size, factors = list(size), []
    while any(n > b for n, b in zip(size, block)):
        sx *= 2
        halve_z = size[0] > 1 and abs(2 * sz - sx) < abs(sz - sx)
        if halve_z:
            sz *= 2
        step = (2 if halve_z else 1, 2, 2)
        smaller = [-(-n // f) for n, f in zip(size, step)]
        if smaller == size:
            break
        size = smaller
        factors.append(step)
    return factors


STEP = ["fz", "fy", "fx"]


def acquisition_factors(extents: DataFrame, resolution: tuple[float, float, float], block: tuple[int, int, int]) -> DataFrame:
    """``acq_id, level, fz, fy, fx, sz, sy, sx``: every acquisition's own levels.

    ``f*`` is the factor against the level before, ``s*`` against level 0; an acquisition that fits one block has no row.
    """
    longs = [T.StructField(c, T.LongType()) for c in ("level", *STEP, "sz", "sy", "sx")]
    schema = T.StructType([*fields_of(extents, ["acq_id"]), *longs])

    def plan(row):
        total = (1, 1, 1)
        for number, step in enumerate(level_factors((row.ext_z, row.ext_y, row.ext_x), resolution, block), start=1):
            total = tuple(t * s for t, s in zip(total, step))
            yield (row.acq_id, number, *step, *total)

    return map_boxes(extents.select("acq_id", "ext_z", "ext_y", "ext_x"), plan, schema)


def _reduce_blocks(boxes: DataFrame, cell: tuple[int, int, int], dtype: str) -> DataFrame:
    """Sum groups of ``fz, fy, fx`` samples (columns) inside each block, before any shuffle.

    Groups lie on the grid of the whole volume: where a block begins or ends inside a group, it
    gives a part of its sum.  What a block gives is cut along the cells of the level.

    ``held`` counts the samples of level 0 in each sum; null where all have their ``full`` number, ``was`` at the level before.
    """
    schema = T.StructType([*fields_of(boxes, KEYS), *CELL_FIELDS, *BOX_FIELDS, HELD, T.StructField("full", T.LongType())])

    def shrink(row):
        block = pixels(row.data, row.nz, row.ny, row.nx, dtype).astype("int64")
        held = _held(row.held, block.shape, row.was)
        lo = []
        for axis, (name, f) in enumerate(zip(ORIGIN, (row.fz, row.fy, row.fx))):
            lo.append(getattr(row, name) // f)
            if f > 1:
                at = np.arange(block.shape[axis])
                first = at[(at == 0) | ((at + getattr(row, name)) % f == 0)]
                block, held = np.add.reduceat(block, first, axis=axis), np.add.reduceat(held, first, axis=axis)
        cuts = []
        for o, n, c in zip(lo, block.shape, cell):
            cuts.append([(k, max(o, k * c), min(o + n, (k + 1) * c)) for k in range(o // c, (o + n - 1) // c + 1)])
        for where in product(*cuts):
            place = tuple(slice(a - o, b - o) for (_, a, b), o in zip(where, lo))
            piece = block[place]
            start = [a for _, a, _ in where]
            box = (*start, *piece.shape, to_bytes(piece, "<i8"), _packed(held[place], row.full))
            yield (row.acq_id, row.channel, *[k for k, _, _ in where], *box, row.full)

    return map_boxes(boxes.select(*KEYS, *ORIGIN, *SHAPE, "data", "held", "was", "full", *STEP), shrink, schema)


HELD = T.StructField("held", T.BinaryType())


def _held(held: bytes | None, shape: tuple[int, ...], full: int) -> np.ndarray:
    return np.full(shape, full, "<i8") if held is None else pixels(held, *shape, "<i8")


def _packed(held: np.ndarray, full: int) -> bytes | None:
    return None if (held == full).all() else to_bytes(held, "<i8")


def _added(parts: DataFrame) -> DataFrame:
    """The parts of each cell added up, sums and counts; where a cell lacks samples, boxes that cover the others."""
    schema = T.StructType([*fields_of(parts, KEYS), *CELL_FIELDS, *BOX_FIELDS, HELD])

    def add(key, rows):
        for run in plane_runs(list(rows)):
            run = [r._replace(held=to_bytes(_held(r.held, (r.nz, r.ny, r.nx), r.full), "<i8")) for r in run]
            sums, some, origin = paste_held(run, "<i8", add=True)
            counts = paste_held(run, "<i8", add=True, column="held")[0]
            for part in held_parts(some):
                piece = sums[part]
                box = (*[o + s.start for o, s in zip(origin, part)], *piece.shape, to_bytes(piece, "<i8"))
                yield (*key, *box, _packed(counts[part], run[0].full))

    return reduce_boxes(parts, [*KEYS, *CELL], add, schema)


def _factor_rows(base: DataFrame, factors: list[tuple[int, int, int]]) -> DataFrame:
    """The same levels for every acquisition."""
    rows, total = [], (1, 1, 1)
    for number, step in enumerate(factors, start=1):
        total = tuple(t * s for t, s in zip(total, step))
        rows.append((number, *step, *total))
    names = ["level", *STEP, "sz", "sy", "sx"]
    levels = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(names, row)]) for row in rows])
    return base.select("acq_id").distinct().select("acq_id", F.inline(levels))


def pyramid(
    base: DataFrame,
    factors: list[tuple[int, int, int]] | DataFrame,
    cell: tuple[int, int, int],
) -> DataFrame:
    """All levels above 0: ``acq_id, channel, level, cell, box`` with int64 sample sums, and ``held``.

    ``held`` counts the samples of level 0 in each sum (int64); it is null where no sum lacks any, as inside the volume.

    ``factors``: a list for all acquisitions, or a row per acquisition and level (``acquisition_factors``);
    an acquisition takes part until its own last level.  Level L+1 sums the sums of level L, so no
    rounding adds up; ``level_means`` divides.  Blocks shrink where they are, wherever they
    begin; only the smaller sums are shuffled.
    """
    if isinstance(factors, list):
        if not factors:
            raise ValueError("the volume already fits one block")
        factors = _factor_rows(base, factors)
    factors = cut_lineage(factors)
    levels = []
    current, dtype = base.withColumn("held", F.lit(None).cast("binary")), "<u2"
    whole = F.col("sz") * F.col("sy") * F.col("sx")
    factors = factors.withColumn("full", whole).withColumn("was", F.expr("full div (fz * fy * fx)"))
    for number in range(1, (factors.agg(F.max("level")).first()[0] or 0) + 1):
        step = broadcast_if_bounded(factors.where(F.col("level") == number).select("acq_id", *STEP, "was", "full"), row_bytes=80)
        shrunk = _reduce_blocks(current.join(step, "acq_id"), cell, dtype)
        current, dtype = cut_lineage(_added(shrunk)), "<i8"
        levels.append(current.withColumn("level", F.lit(number)))
    if not levels:
        raise ValueError("every volume already fits one block")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select(*KEYS, "level", *CELL, *ORIGIN, *SHAPE, "data", "held")


def export_levels(base: DataFrame, extents: DataFrame, resolution: tuple[float, float, float], cell: tuple[int, int, int]) -> DataFrame:
    """``acq_id, channel, level, cell, box``: the fused blocks as level 0 and the rounded means of every level above.

    Each acquisition has as many levels as its own extent needs; one that fits a block has level 0 only.
    """
    factors = cut_lineage(acquisition_factors(extents, resolution, cell))
    out = base.select(*KEYS, F.lit(0).alias("level"), *CELL, *ORIGIN, *SHAPE, "data")
    return out if factors.isEmpty() else out.unionByName(level_means(pyramid(base, factors, cell), extents, factors))


def level_means(levels: DataFrame, extents: DataFrame, factors: list[tuple[int, int, int]] | DataFrame) -> DataFrame:
    """Rounded means (uint16 boxes) of pyramid sums; every sum is divided by the samples it holds.

    ``extents``: acq_id of the volumes, with their level-0 size; ``factors`` as in ``pyramid``.
    """
    if isinstance(factors, list):
        factors = _factor_rows(extents, factors)
    total = ["sz", "sy", "sx"]
    sizes = extents.select("acq_id").distinct().join(factors.select("acq_id", F.col("level").cast("int").alias("level"), *total), "acq_id")
    rows = levels.join(broadcast_if_bounded(cut_lineage(sizes), row_bytes=96), ["acq_id", "level"])
    keep = [*KEYS, "level", *CELL]
    schema = T.StructType([*fields_of(levels, keep), *BOX_FIELDS])

    def divide(row):
        sums = pixels(row.data, row.nz, row.ny, row.nx, "<i8")
        count = _held(row.held, sums.shape, row.sz * row.sy * row.sx)
        mean = (2 * sums + count) // (2 * count)
        yield (*[getattr(row, c) for c in keep], row.z0, row.y0, row.x0, *mean.shape, to_bytes(mean))

    return map_boxes(rows.select(*keep, *ORIGIN, *SHAPE, "data", "held", *total), divide, schema)
