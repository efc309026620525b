"""Acquisition tables to a stitched pyramid, stage by stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import flatfield as FF
from tilewright.operators.blocks import TILE, convert_to_blocks, tile_sizes
from tilewright.operators.blur import gaussian_blur
from tilewright.operators.boxes import CELL
from tilewright.operators.fuse import fuse
from tilewright.operators.manifest import channel_number, select_channel
from tilewright.operators.overlap import overlap_pairs
from tilewright.operators.pyramid import export_levels
from tilewright.operators.register import WINDOW, pair_crops, pair_shifts, to_links
from tilewright.operators.report import append_trace
from tilewright.operators.solve import solve_with_pruning
from tilewright.options import channel_list, int_vector, options_of, stage_options
from tilewright.session import cut_lineage
from tilewright.sources.blocks import read_blocks, write_blocks, write_field, write_pyramid
from tilewright.sources.metadata import parse_tiles


def pairs_to_match(
    tiles: DataFrame, accepted: DataFrame | None, mode: str, padding=(0, 0, 0), min_overlap: int = 1
) -> DataFrame:
    """``full``: every overlapping pair; ``incremental``: those without an accepted link."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    pairs = overlap_pairs(tiles, padding, min_overlap)
    if mode == "full" or accepted is None:
        return pairs
    return pairs.join(accepted.select("acq_id", "i", "j"), ["acq_id", "i", "j"], "left_anti")


def stitch(
    blocks: DataFrame,
    tiles: DataFrame,
    mode: str = "incremental",
    padding: tuple[int, int, int] = (0, 0, 0),
    search: tuple[int, int, int] = (4, 4, 4),
    method: str = "phase",
    threshold: float = 0.3,
    min_overlap: int = 64,
    max_error: float = 1.0,
    max_rounds: int = 10,
    dtype: str = "<u2",
    window: tuple[int, int, int] = WINDOW,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Match and solve until the links no longer change.

    ``blocks`` hold one channel: the chosen one, or the average (``matching_blocks``).
    Returns positions, links and the solve log.  ``full`` matches all pairs again from the
    current positions in every round; ``incremental`` only pairs that have no link yet.  Links
    that still change after ``max_rounds`` are an error.
    """
    nominal = cut_lineage(tiles)
    current, accepted, log, known = nominal, None, None, None
    axes = ("z", "y", "x")
    for round_no in range(max_rounds):
        pairs = pairs_to_match(current, accepted, mode, padding, min_overlap)
        crops = pair_crops(blocks, current, pairs, search, dtype=dtype)
        found = to_links(current, pair_shifts(crops, search, method, threshold, min_overlap, dtype=dtype, cell=window))
        links = found if accepted is None or mode == "full" else accepted.unionByName(found)
        positions, kept, round_log = solve_with_pruning(nominal, links, max_error)
        round_log = round_log.withColumn("round", F.lit(round_no))
        log = round_log if log is None else log.unionByName(round_log)
        # the same links, not only as many
        mark = tuple(kept.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("acq_id", "i", "j", "dz", "dy", "dx"))).first())
        accepted = kept
        current = cut_lineage(
            nominal.drop(*[f"pos_{a}" for a in axes]).join(
                positions.select(
                    "acq_id", "tile_index",
                    *[F.floor(F.col(f"pos_{a}") + 0.5).cast("long").alias(f"pos_{a}") for a in axes],
                ),
                ["acq_id", "tile_index"],
            )
        )
        if mark == known:
            return positions, accepted, log
        known = mark
    raise RuntimeError(f"the links still changed after {max_rounds} rounds")


def matching_blocks(
    blocks: DataFrame, sizes: DataFrame, channel: str = "all", sigma: float = 0, cell: tuple[int, int, int] = (64, 128, 128)
) -> tuple[DataFrame, str]:
    """The one channel that tiles are matched by, and its sample type.

    ``channel``: ``all`` for the average of all channels, or a name whose number is chosen; then blurred
    with ``sigma``, each tile by itself.
    """
    one = FF.channel_average(blocks) if channel_number(channel) is None else select_channel(blocks, channel)
    if not sigma:
        return one, "<u2"
    return gaussian_blur(one, sizes, cell, sigma, TILE), "<f8"


@dataclass
class Reconstruction:
    """What the stages left below one folder; stages that the options leave out have no table."""

    spark: SparkSession
    folder: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, str] = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"no stage of this run wrote {name!r}")
        path = self.tables[name]
        # Acquisition names may look like numbers: the schema is the writer's, not guessed from directories.
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def stage(self, name: str, result: DataFrame, write: Callable[[DataFrame, str], None] | None = None, below: str = "") -> DataFrame:
        """Write what a stage gives, add its rows per acquisition to the trace, and read it back."""
        path = f"{self.folder}/{name}"
        started = self._now()
        (write or (lambda df, to: df.write.mode("overwrite").parquet(to)))(result, path)
        ended = self._now()
        self.tables[name], self.schemas[name] = path + below, result.schema
        written = self.table(name)
        # A block that lacks samples is several boxes, and one row of the trace.
        place = [c for c in ("tile_index", "channel", "level", *CELL) if c in written.columns]
        count = F.count_distinct(*place) if {*CELL} <= {*place} else F.count(F.lit(1))
        rows = written.groupBy("acq_id").agg(count.alias("rows"))
        trace = rows.select(
            F.lit(self.run_id).alias("run_id"), F.lit(name).alias("stage"), "acq_id",
            F.lit(started).alias("started"), F.lit(ended).alias("ended"), "rows", F.lit("ok").alias("status"),
        )
        append_trace(trace, f"{self.folder}/trace")
        return written

    def _now(self):
        return self.spark.range(1).select(F.current_timestamp()).first()[0]

    def trace(self) -> DataFrame:
        """The rows that this run's stages wrote."""
        return self.spark.read.parquet(f"{self.folder}/trace").where(F.col("run_id") == self.run_id)


def reconstruct(spark: SparkSession, planes: DataFrame, stage: DataFrame, folder: str, **options) -> Reconstruction:
    """Planes and stage coordinates to a multi-resolution export below ``folder``, as the options say.

    ``planes``: boxes of whole or partial planes per tile and channel; ``stage``: acq_id, tile_index, stage, and
    ``size_z, size_y, size_x`` when the samples may not reach the tiles' ends.
    Stages: parse, convert, flatfield (if asked for), matching (channel choice or average, blur), stitch, export.
    Every stage writes a table that the next ones read, and a trace row per acquisition.  All
    options are checked before any data is read.
    """
    options = stage_options(**options)
    o = {name: options_of(name, options) for name in ("parse", "convert", "flatfield", "matching", "stitch", "export")}
    zyx = lambda text: int_vector(text)[::-1]
    run = Reconstruction(spark, folder.rstrip("/"))

    wanted = planes.where(F.col("channel").isin(channel_list(o["convert"]["channels"])))
    cell = zyx(o["convert"]["stitching_block_size"])
    blocks = run.stage("blocks", convert_to_blocks(wanted, cell), write_blocks, "/blocks")

    positions = parse_tiles(stage, o["parse"]["resolution"], o["parse"]["axis_mapping"])
    given = ["acq_id", "tile_index", *[f"size_{a}" for a in ("z", "y", "x")]]
    sizes = cut_lineage(stage.select(*given) if {*given} <= {*stage.columns} else tile_sizes(blocks))
    on_grid = [F.floor(F.col(f"pos_{a}") + 0.5).cast("long").alias(f"pos_{a}") for a in ("z", "y", "x")]
    tiles = run.stage("tiles", positions.select("acq_id", "tile_index", *on_grid).join(sizes, ["acq_id", "tile_index"]))

    if o["flatfield"]["flatfield_correction"]:
        counted = FF.cell_histograms(blocks, cell[1:], o["flatfield"]["flatfield_bins"])
        fitted = run.stage("field", FF.estimate(counted, cell[1:], uneven=True), write_field)
        blocks = run.stage("corrected", FF.apply_field(blocks, fitted, cell[1:]), write_blocks, "/blocks")

    matching, dtype = matching_blocks(blocks, sizes, o["matching"]["stitching_channel"], o["matching"]["stitching_blur_sigma"], cell)
    matching = run.stage("matching", matching, write_blocks, "/blocks")
    s = o["stitch"]
    solved, links, log = stitch(
        matching, tiles, s["stitching_mode"], zyx(s["stitching_padding"]), zyx(s["search_radius"]), s["matching_method"],
        min_overlap=s["min_overlap"], max_error=s["max_link_error"], dtype=dtype, window=cell,
    )
    solved = run.stage("positions", solved)
    run.stage("links", links)
    run.stage("solve_log", log)

    e = o["export"]
    out_cell = (cell[0], e["final_block_size_xy"], e["final_block_size_xy"])
    base = run.stage("fused", fuse(blocks, tiles, solved, out_cell, blending=e["blending"], fill=e["fill"]), write_blocks, "/blocks")
    extents = base.groupBy("acq_id").agg(*[F.max(F.col(f"{a}0") + F.col(f"n{a}")).alias(f"ext_{a}") for a in ("z", "y", "x")])
    resolution = tuple(float(v) for v in reversed(e["resolution"].split(",")))
    run.stage("export", export_levels(base, extents, resolution, out_cell), write_pyramid, "/blocks")
    return run
