"""Pairwise shifts between overlapping tiles, matched window by window.

The overlap of a pair is cut along a fixed grid into windows.  A window's samples of one tile meet those
of the other tile around it, as far as the search radius reaches, in one group of bounded size.  Windows
give sums: the correlation surface inside the search range, and for a shift the moments of the samples that it
brings together.  Sums of all windows of a pair are what the whole overlap would give, so the normalised
cross-correlation of a shift is exact, however large the overlap.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.operators.boxes import (
    BOX_FIELDS,
    CELL,
    broadcast_if_bounded,
    crop_boxes,
    fields_of,
    map_boxes,
    paste_held,
    pixels,
    reduce_boxes,
    split_to_grid,
    to_bytes,
)
from tilewright.session import cut_lineage

AXES = ("z", "y", "x")
PAIR = ["acq_id", "i", "j"]
SHIFT = [f"d{a}" for a in AXES]
HELD = T.StructField("held", T.BinaryType())
#: Windows (z, y, x) in which overlaps are matched.
WINDOW = (64, 128, 128)


def pair_crops(
    blocks: DataFrame,
    tiles: DataFrame,
    pairs: DataFrame,
    search: tuple[int, int, int],
    channel: int | None = None,
    dtype: str = "<u2",
) -> DataFrame:
    """Both tiles' samples around each pair's overlap, in nominal global coordinates.

    The overlap is grown by the search radius (inside each tile) so that a shifted match
    still finds its partner.  One equi-join on (acquisition, tile) with a box filter; places are
    broadcast while their counted size allows, so blocks move only as crops.
    """
    wanted = []
    for side, tile in (("i", "i"), ("j", "j")):
        wanted.append(
            pairs.select(
                "acq_id", "i", "j", F.lit(side).alias("side"), F.col(tile).alias("tile_index"),
                *[(F.col(f"lo_{a}") - s).alias(f"glo_{a}") for a, s in zip(AXES, search)],
                *[(F.col(f"hi_{a}") + s).alias(f"ghi_{a}") for a, s in zip(AXES, search)],
            )
        )
    wanted = wanted[0].unionByName(wanted[1])
    placed = wanted.join(tiles.select("acq_id", "tile_index", *[f"pos_{a}" for a in AXES]), ["acq_id", "tile_index"])
    placed = placed.select(
        "acq_id", "tile_index", "i", "j", "side",
        *[F.col(f"pos_{a}").cast("long").alias(f"pos_{a}") for a in AXES],
        *[(F.col(f"glo_{a}") - F.col(f"pos_{a}")).cast("long").alias(f"lo_{a}") for a in AXES],
        *[(F.col(f"ghi_{a}") - F.col(f"pos_{a}")).cast("long").alias(f"hi_{a}") for a in AXES],
    )
    if channel is not None:
        blocks = blocks.where(F.col("channel") == channel)
    hit = blocks.join(broadcast_if_bounded(cut_lineage(placed), row_bytes=192), ["acq_id", "tile_index"])
    for a in AXES:
        hit = hit.where(
            (F.col(f"{a}0") < F.col(f"hi_{a}")) & (F.col(f"{a}0") + F.col(f"n{a}") > F.col(f"lo_{a}"))
        )
    crops = crop_boxes(hit, ["acq_id", "i", "j", "side", "pos_z", "pos_y", "pos_x"], dtype)
    for a in AXES:
        crops = crops.withColumn(f"{a}0", F.col(f"{a}0") + F.col(f"pos_{a}"))
    return crops.drop("pos_z", "pos_y", "pos_x")


def window_pairs(crops: DataFrame, search: tuple[int, int, int], cell: tuple[int, int, int] = WINDOW, dtype: str = "<u2") -> DataFrame:
    """One row per pair and window: the samples of tile i in it, and those of tile j within the search radius of it.

    Columns are ``acq_id, i, j``, the window, the box of i, and the box of j with a ``b_`` before its names.
    ``held`` (a byte per sample) tells which samples the tile has; it is null when none is missing.
    """
    keep = [*PAIR, "side"]
    near = [
        split_to_grid(crops.where(F.col("side") == side), cell, keep, halo, dtype)
        for side, halo in (("i", (0, 0, 0)), ("j", search))
    ]
    fields = [*fields_of(crops, PAIR), *[T.StructField(c, T.LongType()) for c in CELL], *BOX_FIELDS, HELD]
    schema = T.StructType([*fields, *[T.StructField(f"b_{f.name}", f.dataType) for f in (*BOX_FIELDS, HELD)]])

    def meet(key, rows):
        rows = list(rows)
        sides = [[r for r in rows if r.side == side] for side in ("i", "j")]
        if all(sides):
            boxes = [paste_held(side, dtype) for side in sides]
            mask = lambda held: None if held.all() else held.tobytes()
            yield (*key, *itertools.chain(*[(*at, *block.shape, to_bytes(block, dtype), mask(held)) for block, held, at in boxes]))

    # Both sides of a window travel in one shuffle, told apart by `side`.
    return reduce_boxes(near[0].unionByName(near[1]), [*PAIR, *CELL], meet, schema)


def _sides(row, dtype: str) -> tuple:
    a = pixels(row.data, row.nz, row.ny, row.nx, dtype)
    b = pixels(row.b_data, row.b_nz, row.b_ny, row.b_nx, dtype)
    return a, b, (row.z0, row.y0, row.x0), (row.b_z0, row.b_y0, row.b_x0)


def _masks(row, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Which samples of a window both tiles have; None when they have all."""
    if row.held is None and row.b_held is None:
        return None
    return tuple(np.ones(v.shape, bool) if h is None else pixels(h, *v.shape, "?") for h, v in ((row.held, a), (row.b_held, b)))


def _shared(a, b, oa, ob, shift):
    """The parts of ``a`` and of ``b`` moved by ``shift`` that cover the same voxels."""
    lo = [max(p, q + s) for p, q, s in zip(oa, ob, shift)]
    hi = [min(p + n, q + s + m) for p, n, q, s, m in zip(oa, a.shape, ob, shift, b.shape)]
    if any(l >= h for l, h in zip(lo, hi)):
        return None, None
    va = a[tuple(slice(l - p, h - p) for l, h, p in zip(lo, hi, oa))]
    vb = b[tuple(slice(l - q - s, h - q - s) for l, h, q, s in zip(lo, hi, ob, shift))]
    return va, vb


def _search_range(search) -> list[tuple[int, ...]]:
    return list(itertools.product(*[range(-s, s + 1) for s in search]))


def _phase_surface(a, b, oa, ob, search, masks=None) -> np.ndarray:
    """Phase correlation at the shifts of the search range, times the window's samples; missing ones are as the mean."""
    span = [n + m for n, m in zip(a.shape, b.shape)]
    size = [1 << (s - 1).bit_length() if s > 2 else s for s in span]
    level = lambda v, m: v - v.mean() if masks is None else np.where(m, v - v[m].mean(), 0.0)
    ma, mb = masks or (None, None)
    fa = np.fft.rfftn(level(a, ma), s=size, axes=(0, 1, 2))
    fb = np.fft.rfftn(level(b, mb), s=size, axes=(0, 1, 2))
    power = fa * np.conj(fb)
    surface = np.fft.irfftn(power / np.maximum(np.abs(power), 1e-12), s=size, axes=(0, 1, 2))
    # A peak at p means: sample q of b lies at sample q + p of a (cyclic in each axis).
    grids = [(np.arange(-s, s + 1) + q - p) % n for p, q, s, n in zip(oa, ob, search, size)]
    return surface[np.ix_(*grids)] * (a.size if masks is None else int(ma.sum()))


def phase_peaks(windows: DataFrame, search: tuple[int, int, int], top: int, dtype: str = "<u2") -> DataFrame:
    """``acq_id, i, j, dz, dy, dx, score, rank``: the highest places of the windows' surfaces, added up per pair."""
    schema = T.StructType([*fields_of(windows, PAIR), T.StructField("surface", T.ArrayType(T.DoubleType()))])

    def surface(row):
        a, b, oa, ob = _sides(row, dtype)
        found = _phase_surface(a.astype("float64"), b.astype("float64"), oa, ob, search, _masks(row, a, b))
        yield (row.acq_id, row.i, row.j, found.reshape(-1).tolist())

    summed = (
        map_boxes(windows, surface, schema)
        .select(*PAIR, F.posexplode("surface").alias("at", "score"))
        .groupBy(*PAIR, "at")
        .agg(F.sum("score").alias("score"))
    )
    # windows are added in any order: equal places must not differ by their last digits
    at, placed = F.col("at"), [*PAIR]
    wide = [2 * s + 1 for s in search]
    for axis, s in enumerate(search):
        below = int(np.prod(wide[axis + 1 :]))
        placed.append((F.floor(at / below) % wide[axis] - s).cast("long").alias(SHIFT[axis]))
    return top_per_pair(summed.select(*placed, F.round("score", 9).alias("score")), PAIR, "score", top)


def shift_moments(windows: DataFrame, shifts: DataFrame | None, search: tuple[int, int, int], dtype: str = "<u2") -> DataFrame:
    """``acq_id, i, j, dz, dy, dx, n, a, b, aa, bb, ab``: sums of the samples that each shift brings together.

    ``shifts``: the shifts to try of each pair; None: all of the search range.  Integer samples give exact sums.
    """
    value = T.DoubleType() if dtype == "<f8" else T.LongType()
    number = "float64" if dtype == "<f8" else "int64"
    sums = ["a", "b", "aa", "bb", "ab"]
    schema = T.StructType(
        [
            *fields_of(windows, PAIR),
            *[T.StructField(c, T.LongType()) for c in (*SHIFT, "n")],
            *[T.StructField(c, value) for c in sums],
        ]
    )
    every = _search_range(search) if shifts is None else None
    if shifts is not None:
        listed = cut_lineage(shifts.groupBy(*PAIR).agg(F.collect_list(F.struct(*SHIFT)).alias("shifts")))
        windows = windows.join(broadcast_if_bounded(listed, row_bytes=64 + 32 * 16), PAIR)

    def moments(row):
        a, b, oa, ob = _sides(row, dtype)
        a, b = a.astype(number), b.astype(number)
        masks = _masks(row, a, b)
        for shift in every or [tuple(s[c] for c in SHIFT) for s in row.shifts]:
            va, vb = _shared(a, b, oa, ob, shift)
            if va is not None and masks is not None:
                both = np.logical_and(*_shared(*masks, oa, ob, shift))
                va, vb = va[both], vb[both]
            if va is not None and va.size:
                found = (va.sum(), vb.sum(), (va * va).sum(), (vb * vb).sum(), (va * vb).sum())
                yield (row.acq_id, row.i, row.j, *shift, va.size, *[v.item() for v in found])

    return map_boxes(windows, moments, schema).groupBy(*PAIR, *SHIFT).agg(*[F.sum(c).alias(c) for c in ("n", *sums)])


def correlation(exact: bool):
    """Normalised cross-correlation of summed moments; constant input has no correlation and counts as -1."""
    # integers of 38 digits: the difference of two large products loses nothing
    term = lambda c: F.col(c).cast("decimal(19,0)") if exact else F.col(c)
    spread = lambda p, q, pq: (term("n") * term(pq) - term(p) * term(q)).cast("double")
    norm = F.sqrt(spread("a", "a", "aa")) * F.sqrt(spread("b", "b", "bb"))
    return F.when(norm > 0, spread("a", "b", "ab") / norm).otherwise(F.lit(-1.0))


def pair_shifts(
    crops: DataFrame,
    search: tuple[int, int, int],
    method: str = "phase",
    threshold: float = 0.3,
    min_overlap: int = 64,
    top_peaks: int = 5,
    dtype: str = "<u2",
    cell: tuple[int, int, int] = WINDOW,
) -> DataFrame:
    """The shift of tile j against its nominal place relative to tile i.

    ``phase``: the peaks of the phase correlation inside the search range, each tested by the NCC
    of the true overlap.  ``ncc``: every integer shift of the range.  Of equal ones, the shortest shift
    is taken.  A pair none of whose shifts brings ``min_overlap`` samples together is invalid, with ncc -2.
    ``pos_j - pos_i = nominal + (dz, dy, dx)``.
    """
    if method not in ("phase", "ncc"):
        raise ValueError(f"unknown matching method {method!r}")
    # Windows hold the payload: they are written once, later steps read them in place.
    windows = cut_lineage(window_pairs(crops, search, cell, dtype))
    peaks = phase_peaks(windows, search, top_peaks, dtype) if method == "phase" else None
    tried = shift_moments(windows, peaks, search, dtype).where(F.col("n") >= min_overlap)
    score = correlation(exact=dtype != "<f8")
    length = F.col("dz") * F.col("dz") + F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    order = F.struct((-F.round("ncc", 12)).alias("order"), length.alias("length"), *SHIFT, "ncc", "n")
    best = tried.withColumn("ncc", score).groupBy(*PAIR).agg(F.min(order).alias("best"))
    pairs = windows.select(*PAIR).distinct().join(best, PAIR, "left")
    ncc = F.coalesce("best.ncc", F.lit(-2.0))
    return pairs.select(
        *PAIR,
        *[F.coalesce(f"best.{c}", F.lit(0).cast("long")).alias(c) for c in SHIFT],
        ncc.alias("ncc"),
        F.coalesce("best.n", F.lit(0).cast("long")).alias("n_px"),
        (ncc >= threshold).alias("valid"),
    )


def to_links(tiles: DataFrame, shifts: DataFrame, acquisition_keys=("acq_id",)) -> DataFrame:
    """Valid matches as displacement constraints ``pos_j - pos_i = d`` weighted by NCC."""
    at = lambda t: tiles.select(
        *acquisition_keys, F.col("tile_index").alias(t), *[F.col(f"pos_{a}").alias(f"{t}_{a}") for a in AXES]
    )
    met = shifts.where("valid").join(at("i"), [*acquisition_keys, "i"]).join(at("j"), [*acquisition_keys, "j"])
    return met.select(
        *acquisition_keys, "i", "j",
        *[(F.col(f"j_{a}") - F.col(f"i_{a}") + F.col(f"d{a}")).cast("double").alias(f"d{a}") for a in AXES],
        F.col("ncc").alias("w"),
    )


def top_per_pair(scores: DataFrame, pair: list[str], score: str, k: int) -> DataFrame:
    """The ``k`` best candidates of each pair, ties broken by the remaining columns."""
    rest = [c for c in scores.columns if c not in (*pair, score)]
    rank = F.row_number().over(Window.partitionBy(*pair).orderBy(F.desc(score), *rest))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)
