"""Gaussian blur of block tables, with halos exchanged between neighbouring blocks."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.operators.boxes import BOX_FIELDS, CELL, broadcast_if_bounded, fields_of, held_parts, paste_held, reduce_boxes, split_to_grid, to_bytes


def kernel_weights(sigma: float) -> np.ndarray:
    """Normalised weights of radius ``ceil(3 * sigma)``."""
    radius = math.ceil(3 * sigma)
    x = np.arange(-radius, radius + 1)
    w = np.exp(-(x * x) / (2.0 * sigma * sigma))
    return w / w.sum()


def gaussian_blur(
    blocks: DataFrame,
    sizes: DataFrame,
    cell: tuple[int, int, int],
    sigma: float,
    keys: list[str],
    axes: tuple[int, ...] = (0, 1, 2),
) -> DataFrame:
    """Separable blur along ``axes`` (0=z); image borders are mirrored about the edge sample.

    ``sizes``: keys[0..] of an image with ``size_z,size_y,size_x``; ``keys`` names one image
    (for example acquisition, tile, channel).  Output samples are float64.
    Samples that no block has add nothing and get none; x is blurred first, then y, then z.
    """
    weights = kernel_weights(sigma)
    radius = len(weights) // 2
    halo = tuple(radius if a in axes else 0 for a in range(3))
    # A mirrored border reads at most `radius` samples back inside, which the halo covers.
    on = [k for k in keys if k in sizes.columns]
    size_cols = ["size_z", "size_y", "size_x"]
    # Sizes are metadata: they join the whole blocks, once, and no payload moves for them when they are few.
    sized = blocks.join(broadcast_if_bounded(sizes.select(*on, *size_cols), row_bytes=64), on)
    crops = split_to_grid(sized, cell, [*keys, *size_cols], halo)
    schema = T.StructType([*fields_of(blocks, keys), *BOX_FIELDS])

    def blur(key, rows):
        rows = list(rows)
        size = tuple(getattr(rows[0], c) for c in size_cols)
        lo = [k * c for k, c in zip(key[len(keys) :], cell)]
        hi = [min(o + c, s) for o, c, s in zip(lo, cell, size)]
        origin = [max(o - h, 0) for o, h in zip(lo, halo)]
        shape = [min(e + h, s) - o for e, h, s, o in zip(hi, halo, size, origin)]
        block, held, _ = paste_held(rows, bounds=(origin, shape))
        out, whole = block.astype("float64"), held.all()
        for axis in (2, 1, 0):
            start, stop = lo[axis], hi[axis]
            if axis not in axes:
                continue
            at = np.arange(start, stop)[:, None] + np.arange(-radius, radius + 1)[None, :]
            period = max(2 * (size[axis] - 1), 1)
            at = np.abs(at) % period
            at = np.where(at >= size[axis], period - at, at) - origin[axis]
            out = np.moveaxis(np.moveaxis(out, axis, -1)[..., at] @ weights, -1, axis)
            held = held.take(range(start - origin[axis], stop - origin[axis]), axis)
            if not whole:
                out = np.where(held, out, 0.0)
        for part in held_parts(held):
            piece = out[part]
            yield (*key[: len(keys)], *[o + s.start for o, s in zip(lo, part)], *piece.shape, to_bytes(piece, "<f8"))

    # Cells that only receive halo from a neighbour lie outside the image.
    starts = [(F.col(c) >= 0) & (F.col(c) * n < F.col(s)) for c, n, s in zip(CELL, cell, size_cols)]
    inside = crops.where(starts[0] & starts[1] & starts[2])
    return reduce_boxes(inside, [*keys, *CELL], blur, schema)
