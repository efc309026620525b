"""Pixel boxes: rows that carry a dense sub-volume and where it lies.

A box row has ``z0,y0,x0`` (origin), ``nz,ny,nx`` (shape) and ``data`` (little-endian
samples, C order).  Image operators differ only in which boxes meet: Spark routes crops to
a key, a small numpy step pastes or reduces what arrives there.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ORIGIN = ("z0", "y0", "x0")
SHAPE = ("nz", "ny", "nx")
CELL = ("cz", "cy", "cx")

BOX_FIELDS = [
    *(T.StructField(c, T.LongType()) for c in ORIGIN),
    *(T.StructField(c, T.IntegerType()) for c in SHAPE),
    T.StructField("data", T.BinaryType()),
]
CELL_FIELDS = [T.StructField(c, T.LongType()) for c in CELL]


def pixels(data: bytes, nz: int, ny: int, nx: int, dtype: str = "<u2") -> np.ndarray:
    return np.frombuffer(data, dtype=dtype).reshape(nz, ny, nx)


def to_bytes(array: np.ndarray, dtype: str = "<u2") -> bytes:
    return np.ascontiguousarray(array, dtype=dtype).tobytes()


def fields_of(df: DataFrame, names) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def cells_covered(lo: str | Column, hi: str | Column, cell: int | Column, halo: int = 0) -> Column:
    """Grid cell numbers that the half-open range ``[lo - halo, hi + halo)`` touches."""
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    size = F.lit(cell) if isinstance(cell, int) else cell
    first = F.floor((lo - halo) / size)
    last = F.floor((hi - 1 + halo) / size)
    return F.sequence(first.cast("long"), last.cast("long"))


# Output rows are handed back in Arrow batches of about this many payload bytes.
BATCH_BYTES = 16 << 20


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Named rows, one Arrow batch in memory at a time."""
    row = None
    for batch in batches:
        row = row or namedtuple("Box", batch.schema.names)
        for values in zip(*[column.to_pylist() for column in batch.columns]):
            yield row(*values)


def _batches_of(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes)) + 64
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def map_boxes(boxes: DataFrame, step: Callable[[tuple], Iterable[tuple]], schema: T.StructType) -> DataFrame:
    """``step(row)`` yields output tuples; rows stream through in Arrow batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of((out for row in _rows_of(batches) for out in step(row)), arrow)

    return boxes.mapInArrow(run, schema)


def reduce_boxes(
    boxes: DataFrame, keys: list[str], step: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: T.StructType
) -> DataFrame:
    """``step(key, rows)`` yields output tuples; a group's rows stream, they are not gathered first."""
    arrow = to_arrow_schema(schema)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of(step(tuple(k.as_py() for k in key), _rows_of(batches)), arrow)

    # AQE merges partitions by bytes, but kernels cost CPU per group: keep the set number.
    n = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return boxes.repartition(n, *keys).groupBy(*keys).applyInArrow(run, schema)


def split_to_grid(
    boxes: DataFrame,
    cell: tuple[int, int, int],
    keep: list[str],
    halo: tuple[int, int, int] = (0, 0, 0),
    dtype: str = "<u2",
) -> DataFrame:
    """Cut every box along a grid; one row per grid cell (grown by ``halo``) it touches.

    Each payload enters Python once, whatever the number of cells it is cut into.
    """
    schema = T.StructType([*fields_of(boxes, keep), *CELL_FIELDS, *BOX_FIELDS])

    def cut(row):
        shape = (row.nz, row.ny, row.nx)
        origin = (row.z0, row.y0, row.x0)
        block = pixels(row.data, *shape, dtype)
        spans = []
        for o, n, c, h in zip(origin, shape, cell, halo):
            axis = []
            for k in range((o - h) // c, (o + n - 1 + h) // c + 1):
                lo, hi = max(o, k * c - h), min(o + n, (k + 1) * c + h)
                if lo < hi:
                    axis.append((k, lo, hi))
            spans.append(axis)
        kept = tuple(getattr(row, c) for c in keep)
        for kz, zl, zh in spans[0]:
            for ky, yl, yh in spans[1]:
                for kx, xl, xh in spans[2]:
                    piece = block[
                        zl - origin[0] : zh - origin[0],
                        yl - origin[1] : yh - origin[1],
                        xl - origin[2] : xh - origin[2],
                    ]
                    yield (*kept, kz, ky, kx, zl, yl, xl, *piece.shape, to_bytes(piece, dtype))

    return map_boxes(boxes.select(*dict.fromkeys([*keep, *ORIGIN, *SHAPE, "data"])), cut, schema)


def crop_boxes(boxes: DataFrame, keep: list[str], dtype: str = "<u2") -> DataFrame:
    """Cut every box to the range ``lo_z,hi_z,lo_y,hi_y,lo_x,hi_x`` on its own row."""
    schema = T.StructType([*fields_of(boxes, keep), *BOX_FIELDS])
    limits = ["lo_z", "hi_z", "lo_y", "hi_y", "lo_x", "hi_x"]

    def cut(row):
        block = pixels(row.data, row.nz, row.ny, row.nx, dtype)
        zl, zh = max(row.z0, row.lo_z), min(row.z0 + row.nz, row.hi_z)
        yl, yh = max(row.y0, row.lo_y), min(row.y0 + row.ny, row.hi_y)
        xl, xh = max(row.x0, row.lo_x), min(row.x0 + row.nx, row.hi_x)
        if zl < zh and yl < yh and xl < xh:
            piece = block[zl - row.z0 : zh - row.z0, yl - row.y0 : yh - row.y0, xl - row.x0 : xh - row.x0]
            yield (*[getattr(row, c) for c in keep], zl, yl, xl, *piece.shape, to_bytes(piece, dtype))

    return map_boxes(boxes.select(*dict.fromkeys([*keep, *ORIGIN, *SHAPE, "data", *limits])), cut, schema)


def paste(rows: Iterable[tuple], dtype: str = "<u2", add: bool = False) -> tuple[np.ndarray, tuple[int, int, int]]:
    """Paste rows into one array over their common bounds, which they must fill.

    A sample that no row has is an error, and so is one that several have, unless they are
    parts of a sum (``add``): the result never depends on the order of the rows.
    """
    out, held, origin = paste_held(rows, dtype, add)
    if not held.all():
        raise ValueError(f"{int((~held).sum())} samples are missing at {origin}, shape {out.shape}")
    return out, origin


def paste_held(
    rows: Iterable[tuple], dtype: str = "<u2", add: bool = False, bounds: tuple[tuple, tuple] | None = None, column: str = "data"
) -> tuple[np.ndarray, np.ndarray, tuple[int, int, int]]:
    """As ``paste``, and which samples some row has; the others are 0.  ``bounds``: origin and shape to paste into."""
    rows = list(rows)
    if bounds is None:
        origin = tuple(min(getattr(r, c) for r in rows) for c in ORIGIN)
        bounds = origin, tuple(max(getattr(r, c) + getattr(r, n) for r in rows) - o for c, n, o in zip(ORIGIN, SHAPE, origin))
    origin, shape = bounds
    out = np.zeros(shape, dtype=dtype)
    held = np.zeros(shape, dtype=bool)
    for r in rows:
        z, y, x = (r.z0 - origin[0], r.y0 - origin[1], r.x0 - origin[2])
        place = np.s_[z : z + r.nz, y : y + r.ny, x : x + r.nx]
        if not add and held[place].any():
            raise ValueError(f"boxes overlap at {origin}, shape {shape}")
        out[place] += pixels(getattr(r, column), r.nz, r.ny, r.nx, dtype)
        held[place] = True
    return out, held, origin


def _runs(same: Iterable[bool]) -> Iterator[tuple[int, int]]:
    """Half-open ranges; ``same`` tells of every place but the first whether it continues the one before."""
    start, at = 0, 0
    for at, goes_on in enumerate(same, start=1):
        if not goes_on:
            yield start, at
            start = at
    yield start, at + 1


def held_parts(held: np.ndarray) -> Iterator[tuple[slice, slice, slice]]:
    """Boxes that cover the held samples once: one when none is missing, else runs of equal planes, lines and samples."""
    if held.all():
        yield tuple(slice(0, n) for n in held.shape)
        return
    for zl, zh in _runs((held[1:] == held[:-1]).all(axis=(1, 2))):
        plane = held[zl]
        for yl, yh in _runs((plane[1:] == plane[:-1]).all(axis=1)):
            line = plane[yl]
            for xl, xh in _runs(line[1:] == line[:-1]):
                if line[xl]:
                    yield slice(zl, zh), slice(yl, yh), slice(xl, xh)


def plane_runs(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows whose z ranges touch, run by run: a missing plane stays a gap between two boxes."""
    run, end = [], None
    for row in sorted(rows, key=lambda r: (r.z0, r.y0, r.x0)):
        if run and row.z0 > end:
            yield run
            run, end = [], None
        run.append(row)
        end = row.z0 + row.nz if end is None else max(end, row.z0 + row.nz)
    if run:
        yield run


def merge_cells(crops: DataFrame, keys: list[str], dtype: str = "<u2", add: bool = False) -> DataFrame:
    """Paste (or ``add``) the crops of each (keys, cell) into one box; a cell bounds the group's size.

    Where samples are missing, as at a ragged side of an image, a cell gives boxes that cover the others.
    """
    schema = T.StructType([*fields_of(crops, keys), *CELL_FIELDS, *BOX_FIELDS])

    def merge(key, rows):
        for run in plane_runs(list(rows)):
            block, held, origin = paste_held(run, dtype, add)
            for part in held_parts(held):
                piece = block[part]
                yield (*key, *[o + s.start for o, s in zip(origin, part)], *piece.shape, to_bytes(piece, dtype))

    return reduce_boxes(crops, [*keys, *CELL], merge, schema)


def to_scanlines(boxes: DataFrame, keep: list[str], dtype: str = "<u2") -> DataFrame:
    """One row per image line: ``z, y, x0, values``; the JVM-side view of box rows."""
    value = T.DoubleType() if dtype == "<f8" else T.LongType()
    schema = T.StructType(
        [
            *fields_of(boxes, keep),
            T.StructField("z", T.LongType()),
            T.StructField("y", T.LongType()),
            T.StructField("x0", T.LongType()),
            T.StructField("values", T.ArrayType(value)),
        ]
    )

    def lines(row):
        block = pixels(row.data, row.nz, row.ny, row.nx, dtype)
        kept = tuple(getattr(row, c) for c in keep)
        for z in range(row.nz):
            for y in range(row.ny):
                yield (*kept, row.z0 + z, row.y0 + y, row.x0, block[z, y].tolist())

    return map_boxes(boxes.select(*dict.fromkeys([*keep, *ORIGIN, *SHAPE, "data"])), lines, schema)


def broadcast_if_bounded(df: DataFrame, row_bytes: int, limit_bytes: int = 256 << 20) -> DataFrame:
    """Hint a broadcast only after counting rows; otherwise leave the join to AQE."""
    return F.broadcast(df) if df.count() * row_bytes <= limit_bytes else df
