"""Flatfield: per-block histograms, brightfield/offset estimate, correction.

Model ``observed = S * true + T``.  For each pixel the samples of the stack are ordered;
``M_k`` is the mean over pixels of the k-th smallest; ``S`` and ``T`` are the least-squares
line of a pixel's ordered samples on ``M``.  (``mean(S) = 1`` and ``mean(T) = 0`` over
pixels follow from ``M`` being the mean.)

The image plane is cut into cells.  A task counts the samples of a cell in one buffer, z and tiles
pooled, and sends it as one packed row; a cell's rows are added up into its histogram.  Cells then
give their part of the channel's curve (a value per rank), the curves are added up, and every cell is
fitted against the curve of its channel.  No pixel and no sample is a row of a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilewright.operators.boxes import BOX_FIELDS, broadcast_if_bounded, fields_of, map_boxes, pixels, reduce_boxes, to_bytes
from tilewright.session import cut_lineage

CHANNEL = ["acq_id", "channel"]
CELL_YX = ["cy", "cx"]
#: Entries that a task holds before it sends its buffers.
HELD = 4 << 20


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal codes added up, in order."""
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, "int64")
    return code[first], np.add.reduceat(count, first) if len(code) else count


def cell_histograms(
    blocks: DataFrame, cell_yx: tuple[int, int], bins: int | None = None, low: int = 0, high: int = 65536
) -> DataFrame:
    """``acq_id, channel, cy, cx, codes, counts``: one packed histogram per channel and cell of the plane.

    A code is ``place in the cell * 65536 + value`` (int64), its count an int64.  With ``bins``, values
    are the lower bounds of equal bins of ``[low, high)`` (samples outside go to the end bins), so a
    cell's size has a bound that the depth of the stack doesn't change.
    """
    ch, cw = cell_yx
    fields = [*fields_of(blocks, CHANNEL), *[T.StructField(c, T.LongType()) for c in CELL_YX]]
    schema = T.StructType([*fields, T.StructField("codes", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    value = np.arange(65536, dtype="int64")
    if bins is not None:
        bin_no = np.clip((value - low) * bins // (high - low), 0, bins - 1)
        value = bin_no * (high - low) // bins + low

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for key, (codes, counts) in held.items():
            code, count = _merged(codes, counts)
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (*key, code.tobytes(), count.tobytes())))], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for row in batch.to_pylist():
                stack = np.frombuffer(row["data"], "<u2").reshape(-1, row["ny"], row["nx"])
                y0, x0 = row["y0"], row["x0"]
                for cy in range(y0 // ch, (y0 + row["ny"] - 1) // ch + 1):
                    for cx in range(x0 // cw, (x0 + row["nx"] - 1) // cw + 1):
                        top, left = max(0, cy * ch - y0), max(0, cx * cw - x0)
                        part = stack[:, top : (cy + 1) * ch - y0, left : (cx + 1) * cw - x0]
                        y = np.arange(part.shape[1]) + y0 + top - cy * ch
                        x = np.arange(part.shape[2]) + x0 + left - cx * cw
                        code = (((y[:, None] * cw + x) << 16)[None] + value[part]).reshape(-1)
                        codes, counts = held.setdefault((row["acq_id"], row["channel"], cy, cx), ([], []))
                        one, n = np.unique(code, return_counts=True)
                        codes.append(one)
                        counts.append(n)
                        size += len(one)
                if size > HELD:
                    # a cell's planes repeat their values: adding up makes room first
                    held = {key: tuple([part] for part in _merged(*parts)) for key, parts in held.items()}
                    size = sum(len(codes[0]) for codes, _ in held.values())
                    if size > HELD // 2:
                        yield from rows(held)
                        held, size = {}, 0
        yield from rows(held)

    counted = blocks.select(*CHANNEL, "y0", "x0", "ny", "nx", "data").mapInArrow(count, schema)

    def add(key, parts):
        codes, counts = np.zeros(0, "int64"), np.zeros(0, "int64")
        for r in parts:
            codes, counts = _merged([codes, np.frombuffer(r.codes, "int64")], [counts, np.frombuffer(r.counts, "int64")])
        yield (*key, codes.tobytes(), counts.tobytes())

    return reduce_boxes(counted, [*CHANNEL, *CELL_YX], add, schema)


def histogram_rows(histograms: DataFrame, cell_yx: tuple[int, int]) -> DataFrame:
    """``acq_id, channel, y, x, v, n``: the histograms in long form, as the last step before a report."""
    ch, cw = cell_yx
    schema = T.StructType([*fields_of(histograms, CHANNEL), *[T.StructField(c, T.LongType()) for c in ("y", "x", "v", "n")]])

    def explode(row):
        code, count = np.frombuffer(row.codes, "int64"), np.frombuffer(row.counts, "int64")
        place = code >> 16
        columns = (place // cw + row.cy * ch, place % cw + row.cx * cw, code & 0xFFFF, count)
        for values in zip(*(c.tolist() for c in columns)):
            yield (row.acq_id, row.channel, *values)

    return map_boxes(histograms, explode, schema)


def _by_pixel(codes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places that have samples, and how many each has."""
    code, count = np.frombuffer(codes, "int64"), np.frombuffer(counts, "int64")
    place, first = np.unique(code >> 16, return_index=True)
    return place, np.add.reduceat(count, first) if len(first) else count


def _ordered(codes: bytes, counts: bytes, depth: int) -> np.ndarray:
    """pixels x depth: every pixel's samples in rising order; fewer samples are spread evenly over the ranks."""
    values = np.repeat(np.frombuffer(codes, "int64") & 0xFFFF, np.frombuffer(counts, "int64"))
    _, depths = _by_pixel(codes, counts)
    if (depths == depth).all():
        return values.reshape(-1, depth)
    first = np.cumsum(depths) - depths
    return values[first[:, None] + (2 * np.arange(depth) + 1)[None, :] * depths[:, None] // (2 * depth)]


def curves(histograms: DataFrame) -> DataFrame:
    """``acq_id, channel, n_px, depth, q``: per channel the sums over pixels of the k-th smallest samples (int64 bytes).

    Every pixel of a channel must have the same number of samples, unless ``deepest`` (a column of the
    histograms) says to how many ranks the samples of the others are spread.
    """
    schema = T.StructType(
        [
            *fields_of(histograms, CHANNEL),
            T.StructField("n_px", T.LongType()),
            T.StructField("depth", T.LongType()),
            T.StructField("q", T.BinaryType()),
        ]
    )
    uneven = "every pixel of a channel needs the same number of samples"
    spread = "deepest" in histograms.columns

    def part(row):
        place, depths = _by_pixel(row.codes, row.counts)
        if len(place):
            depth = row.deepest if spread else int(depths[0])
            if not spread and depths.min() != depths.max():
                raise ValueError(uneven)
            q = _ordered(row.codes, row.counts, depth).sum(axis=0)
            yield (row.acq_id, row.channel, len(place), depth, q.tobytes())

    def add(key, parts):
        n_px, depth, q = 0, None, 0
        for r in parts:
            if depth not in (None, r.depth):
                raise ValueError(uneven)
            n_px, depth, q = n_px + r.n_px, r.depth, q + np.frombuffer(r.q, "int64")
        yield (*key, n_px, depth, q.tobytes())

    parts = map_boxes(histograms, part, schema)
    return reduce_boxes(parts, CHANNEL, add, schema)


def _deepest(histograms: DataFrame) -> DataFrame:
    """``acq_id, channel, deepest``: the most samples that a pixel has."""
    schema = T.StructType([*fields_of(histograms, CHANNEL), T.StructField("deepest", T.LongType())])

    def depth(row):
        depths = _by_pixel(row.codes, row.counts)[1]
        if len(depths):
            yield (row.acq_id, row.channel, int(depths.max()))

    return map_boxes(histograms, depth, schema).groupBy(*CHANNEL).agg(F.max("deepest").alias("deepest"))


def estimate(histograms: DataFrame, cell_yx: tuple[int, int], uneven: bool = False) -> DataFrame:
    """``acq_id, channel, cy, cx, y0, x0, fy, fx, s, t``: fields as float64 planes, one box per cell of the histograms.

    Pixels with fewer samples than others, as where tiles lack some, are an error unless ``uneven`` allows them; then their
    order statistics are spread over the ranks of the deepest.
    """
    ch, cw = cell_yx
    # Counting reads all samples; both later steps read the histograms.
    histograms = cut_lineage(histograms)
    ranked = histograms.join(broadcast_if_bounded(cut_lineage(_deepest(histograms)), row_bytes=64), CHANNEL) if uneven else histograms
    curve = cut_lineage(curves(ranked))
    # A curve is 8 bytes per rank: as large as the deepest stack, of which the count is taken first.
    deepest = curve.agg(F.max("depth")).first()[0] or 0
    met = histograms.join(broadcast_if_bounded(curve, row_bytes=8 * deepest + 64), CHANNEL)
    longs = [T.StructField(c, T.LongType()) for c in (*CELL_YX, "y0", "x0", "fy", "fx")]
    planes = [T.StructField(c, T.BinaryType()) for c in ("s", "t")]
    schema = T.StructType([*fields_of(histograms, CHANNEL), *longs, *planes])

    def fit(row):
        place, _ = _by_pixel(row.codes, row.counts)
        mean = np.frombuffer(row.q, "int64") / row.n_px
        centred = mean - mean.mean()
        spread = float(centred @ centred)
        v = _ordered(row.codes, row.counts, row.depth).astype("float64")
        # A stack without any spread carries no shading: S = 1.
        s = v @ centred / spread if spread > 0 else np.ones(len(v))
        t = v.mean(axis=1) - s * mean.mean()
        y, x = place // cw, place % cw
        top, left = int(y.min()), int(x.min())
        fy, fx = int(y.max()) + 1 - top, int(x.max()) + 1 - left
        scale, shift = np.ones((fy, fx)), np.zeros((fy, fx))
        scale[y - top, x - left], shift[y - top, x - left] = s, t
        yield (
            row.acq_id, row.channel, row.cy, row.cx, row.cy * ch + top, row.cx * cw + left, fy, fx,
            to_bytes(scale, "<f8"), to_bytes(shift, "<f8"),
        )

    return map_boxes(met, fit, schema)


def rounded(field: DataFrame, s_digits: int, t_digits: int) -> DataFrame:
    """The field with ``s`` and ``t`` rounded, so that corrected samples don't hang on a last digit."""
    names = field.columns
    digits = {"s": s_digits, "t": t_digits}

    def step(row):
        yield tuple(
            to_bytes(np.round(np.frombuffer(getattr(row, c), "<f8"), digits[c]), "<f8") if c in digits else getattr(row, c) for c in names
        )

    return map_boxes(field, step, field.schema)


def field_rows(field: DataFrame) -> DataFrame:
    """``acq_id, channel, y, x, s, t`` of every pixel of the field boxes."""
    schema = T.StructType(
        [
            *fields_of(field, CHANNEL),
            *[T.StructField(c, T.LongType()) for c in ("y", "x")],
            *[T.StructField(c, T.DoubleType()) for c in ("s", "t")],
        ]
    )

    def explode(row):
        s, t = (np.frombuffer(p, "<f8") for p in (row.s, row.t))
        for k, (a, b) in enumerate(zip(s.tolist(), t.tolist())):
            yield (row.acq_id, row.channel, row.y0 + k // row.fx, row.x0 + k % row.fx, a, b)

    return map_boxes(field, explode, schema)


def apply_field(blocks: DataFrame, field: DataFrame, cell_yx: tuple[int, int]) -> DataFrame:
    """Corrected blocks: ``(v - T) / S``, never below 0, rounded half up.

    ``cell_yx`` is the grid that both the blocks and the field's boxes lie on.

    The field is small (one image per channel) next to the blocks; it is broadcast when its
    counted size allows, so the blocks are not shuffled.
    """
    ch, cw = cell_yx
    # Counted and used: written once, so the field is not fitted twice.
    boxes_side = broadcast_if_bounded(cut_lineage(field).withColumnsRenamed({"y0": "top", "x0": "left"}), row_bytes=16 * ch * cw)
    keyed = blocks.withColumn("cy", F.floor(F.col("y0") / ch)).withColumn("cx", F.floor(F.col("x0") / cw))
    names = blocks.columns
    met = keyed.join(boxes_side, [*CHANNEL, *CELL_YX])

    def correct(row):
        block = pixels(row.data, row.nz, row.ny, row.nx).astype("float64")
        y, x = row.y0 - row.top, row.x0 - row.left
        s = np.frombuffer(row.s, "<f8").reshape(row.fy, row.fx)[y : y + row.ny, x : x + row.nx]
        t = np.frombuffer(row.t, "<f8").reshape(row.fy, row.fx)[y : y + row.ny, x : x + row.nx]
        true = np.clip(np.floor((block - t) / np.where(s > 0, s, 1.0) + 0.5), 0, 65535)
        yield tuple(to_bytes(true) if c == "data" else getattr(row, c) for c in names)

    return map_boxes(met, correct, blocks.schema)


def channel_average(blocks: DataFrame) -> DataFrame:
    """Mean over channels of each tile block, rounded half up, as channel -1.

    Blocks of one tile region meet once; they are summed as they stream in.
    """
    keys = ["acq_id", "tile_index", "z0", "y0", "x0", "nz", "ny", "nx"]
    schema = T.StructType(
        [*fields_of(blocks, ["acq_id", "tile_index"]), T.StructField("channel", T.IntegerType()), *BOX_FIELDS]
    )

    def average(key, rows):
        total, n = None, 0
        for row in rows:
            block = np.frombuffer(row.data, "<u2").astype("int64")
            total = block if total is None else total + block
            n += 1
        mean = (2 * total + n) // (2 * n)
        yield (*key[:2], -1, *key[2:], to_bytes(mean))

    return reduce_boxes(blocks.select(*keys, "data"), keys, average, schema)
