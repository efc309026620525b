"""Which tiles overlap: a box range join expressed as an equi-join on grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


def overlap_pairs(
    tiles: DataFrame,
    padding: tuple[int, int, int] = (0, 0, 0),
    min_overlap: int = 1,
) -> DataFrame:
    """Pairs ``i < j`` of one acquisition whose padded boxes intersect on every axis.

    ``tiles``: acq_id, tile_index, pos_{z,y,x}, size_{z,y,x}; padding in z,y,x order.
    A pair is reported only in the cell that holds the low corner of its intersection, so
    no pair is produced twice and none has to be removed afterwards.  Cells are as wide as
    the acquisition's typical (median) padded box: usual boxes touch two cells per axis, a wide
    one covers many, and does not bring all others into its own.
    """
    boxes = tiles.select(
        "acq_id",
        "tile_index",
        *[(F.col(f"pos_{a}") - p).cast("long").alias(f"lo_{a}") for a, p in zip(AXES, padding)],
        *[(F.col(f"pos_{a}") + F.col(f"size_{a}") + p).cast("long").alias(f"hi_{a}") for a, p in zip(AXES, padding)],
    )
    width = lambda a: F.percentile_approx(F.col(f"hi_{a}") - F.col(f"lo_{a}"), 0.5)
    typical = boxes.groupBy("acq_id").agg(*[F.greatest(width(a), F.lit(1)).alias(f"cell_{a}") for a in AXES])
    covered = boxes.join(typical, "acq_id")
    for a in AXES:
        lo, hi, cell = F.col(f"lo_{a}"), F.col(f"hi_{a}"), F.col(f"cell_{a}")
        first, last = F.floor(lo / cell).cast("long"), F.floor((hi - 1) / cell).cast("long")
        covered = covered.withColumn(f"c{a}", F.explode(F.sequence(first, last)))
    left = covered.select(
        "acq_id", "cz", "cy", "cx", F.col("tile_index").alias("i"),
        *[F.col(f"{e}_{a}").alias(f"{e}i_{a}") for a in AXES for e in ("lo", "hi")],
        *[f"cell_{a}" for a in AXES],
    )
    right = covered.select(
        "acq_id", "cz", "cy", "cx", F.col("tile_index").alias("j"),
        *[F.col(f"{e}_{a}").alias(f"{e}j_{a}") for a in AXES for e in ("lo", "hi")],
    )
    met = left.join(right, ["acq_id", "cz", "cy", "cx"]).where("i < j")
    for a in AXES:
        met = met.withColumn(f"lo_{a}", F.greatest(f"loi_{a}", f"loj_{a}")).withColumn(
            f"hi_{a}", F.least(f"hii_{a}", f"hij_{a}")
        )
        met = met.where(
            (F.col(f"lo_{a}") < F.col(f"hi_{a}"))
            & (F.floor(F.col(f"lo_{a}") / F.col(f"cell_{a}")) == F.col(f"c{a}"))
        )
    volume = (F.col("hi_z") - F.col("lo_z")) * (F.col("hi_y") - F.col("lo_y")) * (F.col("hi_x") - F.col("lo_x"))
    return met.withColumn("overlap", volume).where(F.col("overlap") >= min_overlap).select(
        "acq_id", "i", "j", *[f"{e}_{a}" for a in AXES for e in ("lo", "hi")], "overlap"
    )
