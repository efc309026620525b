"""Image queries: each with the DuckDB text that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.catalog import views as V
from tilewright.functions import vectors
from tilewright.operators import blocks as B
from tilewright.operators import flatfield as FF
from tilewright.operators.blur import gaussian_blur, kernel_weights
from tilewright.operators.boxes import to_scanlines
from tilewright.operators.fuse import fuse
from tilewright.operators.overlap import overlap_pairs
from tilewright.operators.pyramid import level_factors, level_means, pyramid
from tilewright.operators.register import pair_crops, pair_shifts, phase_peaks, to_links, top_per_pair, window_pairs
from tilewright.operators.solve import components, solve_positions, solve_with_pruning
from tilewright.session import cut_lineage

SEARCH = (0, 4, 4)
MIN_OVERLAP = 128
OUT_CELL = (1, 32, 32)
FIELD_CELL = (8, 8)
HIST_BINS, HIST_LOW, HIST_HIGH = 256, 0, 2048


def _lines(boxes: DataFrame, keep: list[str]) -> DataFrame:
    """Image lines as text, so whole sample values are compared."""
    return to_scanlines(boxes, keep).select(*keep, "z", "y", "x0", F.array_join("values", ",").alias("line"))


# --- tiles and blocks --------------------------------------------------------------------


def stage_to_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage coordinates through the default axis map and resolution, from the low corner."""
    from tilewright.sources.metadata import parse_tiles

    stage = V.tiles(spark, sf_dir).select(
        "acq_id", "tile_index",
        F.array(
            F.col("pos_x").cast("double") * 0.5, F.col("pos_y").cast("double") * 0.25, F.col("pos_z").cast("double")
        ).alias("stage"),
    )
    placed = parse_tiles(stage, "0.25,0.5,1", "-y,x,z")
    return placed.select(
        "tile_index", *[F.round(f"pos_{a}", 6).alias(f"pos_{a}") for a in ("x", "y", "z")]
    )


STAGE_TO_PIXEL = f"""with {V.TILES},
p as (select tile_index, -(pos_y * 0.25) / 0.25 as x, pos_x * 0.5 / 0.5 as y from tile)
select tile_index, round(x - min(x) over (), 6) as pos_x, round(y - min(y) over (), 6) as pos_y,
       cast(0 as double) as pos_z from p"""


def channel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the channel that the option names, by partition-style filter."""
    from tilewright.operators.manifest import select_channel

    chosen = select_channel(V.stack(spark, sf_dir), "ch3")
    rows = FF.histogram_rows(FF.cell_histograms(chosen, FIELD_CELL), FIELD_CELL)
    return rows.groupBy("channel", "y", "x").agg(
        F.sum("n").alias("n"), F.sum(F.col("v") * F.col("n")).alias("sum_v")
    )


CHANNEL_FILTER = f"""with {V.STACK}
select channel, y, x, count(*) as n, cast(sum(v) as bigint) as sum_v from stack where channel = 3 group by all"""


def axis_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector and signed-axis strings of every settings row, parsed."""
    s = V.settings(spark, sf_dir).withColumns(
        {
            "v": vectors.parse_vector("resolution"),
            "a": vectors.parse_axes(F.when(F.col("cluster"), "-x,y,z").otherwise("z,-y,x")),
        }
    )
    return s.select(
        "c_custkey",
        *[F.col("v")[k].alias(f"r{k}") for k in range(3)],
        F.array_join(F.transform("a", lambda p: F.concat(p["axis"], p["sign"].cast("string"))), " ").alias("axes"),
    )


AXIS_WORDS = f"""with {V.SETTINGS}
select c_custkey, cast(split_part(resolution, ',', 1) as double) as r0, cast(split_part(resolution, ',', 2) as double) as r1,
       cast(split_part(resolution, ',', 3) as double) as r2,
       case when cluster then 'x-1 y1 z1' else 'z1 y-1 x1' end as axes from settings"""


def blocks_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.convert_to_blocks(V.voxel(spark, sf_dir), (16, 4, 4))
    lines = to_scanlines(out, ["cz", "cy", "cx"])
    return (
        lines.select("cz", "cy", "cx", "z", "y", "x0", F.posexplode("values").alias("k", "v"))
        .groupBy("cz", "cy", "cx")
        .agg(
            F.count("*").alias("n"), F.sum("v").alias("sum_v"),
            F.sum(F.col("v") * (F.col("x0") + F.col("k") + 10 * F.col("y") + 100 * F.col("z"))).alias("moment"),
        )
    )


BLOCKS_SPLIT = f"""with {V.STACK}
select z // 16 as cz, y // 4 as cy, x // 4 as cx, count(*) as n, cast(sum(v) as bigint) as sum_v,
  cast(sum(v * (x + 10 * y + 100 * z)) as bigint) as moment
from stack group by all"""


def blocks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written partitioned by channel, read back with pruning, as image lines."""
    from tilewright.session import staging_path
    from tilewright.sources.blocks import read_blocks, write_blocks

    path = staging_path(spark, "blocks")
    write_blocks(B.convert_to_blocks(V.stack(spark, sf_dir), (16, 8, 8)), path)
    return _lines(read_blocks(spark, path, channel=3), ["channel"]).drop("x0")


BLOCKS_ROUNDTRIP = f"""with {V.STACK}
select 3 as channel, z, y, string_agg(cast(v as varchar), ',' order by x) as line from stack where channel = 3 group by z, y"""


def channel_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.channel_metadata(V.multichannel(spark, sf_dir)).drop("acq_id")


CHANNEL_METADATA = """select vec_id % 4 as channel, count(distinct vec_id // 4) as n_tiles, count(*) as n_blocks,
       1::bigint as size_z, 8::bigint as size_y, 8::bigint as size_x, count(*) * 128 as n_bytes from embeddings group by 1"""


# --- flatfield ---------------------------------------------------------------------------


def pixel_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = FF.cell_histograms(V.stack(spark, sf_dir), FIELD_CELL, HIST_BINS, HIST_LOW, HIST_HIGH)
    width = (HIST_HIGH - HIST_LOW) // HIST_BINS
    bin_no = F.floor((F.col("v") - HIST_LOW) / width).alias("bin")
    return FF.histogram_rows(counted, FIELD_CELL).select("channel", "y", "x", bin_no, "n")


PIXEL_HISTOGRAM = f"""with {V.STACK}
select channel, y, x, cast(least(greatest(v * 256 // 2048, 0), 255) as bigint) as bin, count(*) as n from stack group by all"""


def flatfield_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = FF.estimate(FF.cell_histograms(V.stack(spark, sf_dir), FIELD_CELL), FIELD_CELL)
    return FF.field_rows(field).select("channel", "y", "x", F.round("s", 6).alias("s"), F.round("t", 4).alias("t"))


_FIELD = """ranked as (select *, row_number() over (partition by channel, y, x order by v) as k from {src}),
ref as (select channel, k, sum(v) as q, count(*) as np from ranked group by all),
fit as (
  select r.channel, r.y, r.x, count(*) as n, cast(sum(r.v) as double) as sv, cast(sum(q) as double) as sq,
         cast(sum(r.v * q) as double) as svq, cast(sum(q * q) as double) as sqq, max(np) as np
  from ranked r join ref using (channel, k) group by all),
slope as (select *, (n * svq - sv * sq) / (n * sqq - sq * sq) * np as s from fit),
field as (select channel, y, x, s, (sv - s * sq / np) / n as t from slope)"""
FLATFIELD_FIELDS = f"""with {V.STACK}, {_FIELD.format(src='stack')}
select channel, y, x, round(s, 6) as s, round(t, 4) as t from field"""


def flatfield_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large-stack variant: order statistics from 256 bins."""
    counted = FF.cell_histograms(V.stack(spark, sf_dir), FIELD_CELL, HIST_BINS, HIST_LOW, HIST_HIGH)
    return FF.field_rows(FF.estimate(counted, FIELD_CELL)).select("channel", "y", "x", F.round("s", 6).alias("s"), F.round("t", 4).alias("t"))


FLATFIELD_BINNED = f"""with {V.STACK},
binned as (select channel, z, y, x, (v * 256 // 2048) * 8 as v from stack), {_FIELD.format(src='binned')}
select channel, y, x, round(s, 6) as s, round(t, 4) as t from field"""


def flatfield_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = V.stack(spark, sf_dir)
    # Rounding the field keeps the corrected integers free of last-digit noise.
    field = FF.rounded(FF.estimate(FF.cell_histograms(stack, FIELD_CELL), FIELD_CELL), 6, 4)
    return _lines(FF.apply_field(stack, field, FIELD_CELL), ["channel"]).drop("x0")


FLATFIELD_APPLIED = f"""with {V.STACK}, {_FIELD.format(src='stack')}
select channel, z, y, string_agg(cast(cast(greatest(floor((v - round(t, 4)) / round(s, 6) + 0.5), 0) as bigint) as varchar), ',' order by x) as line
from stack join field using (channel, y, x) group by channel, z, y"""


def channel_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(FF.channel_average(V.multichannel(spark, sf_dir)), ["tile_index"]).drop("x0", "z")


CHANNEL_AVERAGE = f"""with {V.EMB_PX},
m as (select vec_id // 4 as tile_index, i // 8 as y, i % 8 as x, (2 * sum(px) + count(*)) // (2 * count(*)) as v from emb_px group by all)
select tile_index, y, string_agg(cast(cast(v as bigint) as varchar), ',' order by x) as line from m group by all"""


def blurred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scene blurred with sigma 2, as rounded samples."""
    scene = V.scene(spark, sf_dir)
    out = gaussian_blur(scene, B.tile_sizes(scene), (1, 8, 8), 2.0, B.TILE, axes=(1, 2))
    values = to_scanlines(out, [], "<f8").select("y", "x0", F.posexplode("values").alias("k", "v"))
    return values.select("y", (F.col("x0") + F.col("k")).alias("x"), F.round("v", 4).alias("v"))


_W = [f"({o}, cast({w!r} as double))" for o, w in zip(range(-6, 7), kernel_weights(2.0).tolist())]
_MIRROR = "case when {p} < 0 then -({p}) when {p} >= {n} then 2 * ({n} - 1) - ({p}) else {p} end"
GAUSSIAN_BLUR = f"""with {V.SCENE},
size as (select max(y) + 1 as h, max(x) + 1 as w from scene),
k(o, weight) as (values {', '.join(_W)}),
horizontal as (
  select t.y, t.x, sum(k.weight * s.v) as v from scene t cross join k cross join size
  join scene s on s.y = t.y and s.x = {_MIRROR.format(p='t.x + k.o', n='size.w')} group by t.y, t.x)
select t.y, t.x, round(sum(k.weight * s.v), 4) as v from scene t cross join k cross join size
join horizontal s on s.x = t.x and s.y = {_MIRROR.format(p='t.y + k.o', n='size.h')} group by t.y, t.x"""


# --- stitch ------------------------------------------------------------------------------


def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_pairs(V.tiles(spark, sf_dir), padding=(0, 1, 1)).select("i", "j", "lo_y", "hi_y", "lo_x", "hi_x", "overlap")


_OVERLAP = """select a.tile_index as i, b.tile_index as j,
  greatest(a.pos_y, b.pos_y) - {p} as lo_y, least(a.pos_y, b.pos_y) + 32 + {p} as hi_y,
  greatest(a.pos_x, b.pos_x) - {p} as lo_x, least(a.pos_x, b.pos_x) + 32 + {p} as hi_x
from tile a join tile b on a.tile_index < b.tile_index
 and abs(a.pos_y - b.pos_y) < 32 + 2 * {p} and abs(a.pos_x - b.pos_x) < 32 + 2 * {p}"""
OVERLAP_PAIRS = f"""with {V.TILES}, o as ({_OVERLAP.format(p=1)})
select *, (hi_y - lo_y) * (hi_x - lo_x) as overlap from o"""


def _whole_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of one image line, as a ragged image has them, joined in order of x."""
    pieces = F.array_sort(F.collect_list(F.struct("x0", "line")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(pieces, lambda p: p["line"]), ",").alias("line"))


def _inputs(spark: SparkSession, sf_dir: str):
    """Tiles and blocks as the convert stage leaves them: stored tables."""
    tiles = cut_lineage(V.tiles(spark, sf_dir))
    return tiles, cut_lineage(V.tile_blocks(spark, sf_dir)), overlap_pairs(tiles, min_overlap=MIN_OVERLAP)


def _shifts(spark: SparkSession, sf_dir: str, method: str, cell=(1, 128, 128)) -> DataFrame:
    tiles, blocks, pairs = _inputs(spark, sf_dir)
    found = pair_shifts(pair_crops(blocks, tiles, pairs, SEARCH), SEARCH, method, min_overlap=64, cell=cell)
    return found.select("i", "j", "dy", "dx", F.round("ncc", 6).alias("ncc"), "valid")


def pair_shifts_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shifts(spark, sf_dir, "phase")


def pair_shifts_ncc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shifts(spark, sf_dir, "ncc")


def pair_shifts_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same shifts from sums over windows of 8 x 8 samples."""
    return _shifts(spark, sf_dir, "ncc", (1, 8, 8))


def pair_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest peak of each pair's phase correlation, ranked by a window over the summed surfaces."""
    tiles, blocks, pairs = _inputs(spark, sf_dir)
    windows = window_pairs(pair_crops(blocks, tiles, pairs, SEARCH), SEARCH)
    return phase_peaks(windows, SEARCH, 1).select("i", "j", "dy", "dx", "rank")


_NEIGHBOURS = f"""o as ({_OVERLAP.format(p=0)}),
near as (select i, j from o where (hi_y - lo_y) * (hi_x - lo_x) >= 128)"""
PAIR_SHIFTS = f"""with {V.TILES}, {_NEIGHBOURS}
select i, j, (b.true_y - b.pos_y) - (a.true_y - a.pos_y) as dy, (b.true_x - b.pos_x) - (a.true_x - a.pos_x) as dx,
       cast(1 as double) as ncc, true as valid
from near join tile a on a.tile_index = i join tile b on b.tile_index = j"""


PAIR_PEAKS = f"""with s as ({PAIR_SHIFTS}) select i, j, dy, dx, 1::integer as rank from s"""


def planted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and column neighbours with their true displacement, without touching pixels."""
    t = V.tiles(spark, sf_dir)
    at = lambda s: t.select(
        "acq_id", F.col("tile_index").alias(s), F.col("true_y").alias(f"{s}y"), F.col("true_x").alias(f"{s}x")
    )
    pairs = overlap_pairs(t, min_overlap=MIN_OVERLAP).select("acq_id", "i", "j")
    met = pairs.join(at("i"), ["acq_id", "i"]).join(at("j"), ["acq_id", "j"])
    return met.select(
        "acq_id", "i", "j", F.lit(0.0).alias("dz"),
        (F.col("jy") - F.col("iy")).cast("double").alias("dy"), (F.col("jx") - F.col("ix")).cast("double").alias("dx"),
        F.lit(1.0).alias("w"),
    )


def tile_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth tile row is taken out, so the mosaic falls into bands."""
    tiles = V.tiles(spark, sf_dir).where("r % 5 <> 3")
    kept = tiles.select("acq_id", "tile_index")
    links = planted_links(spark, sf_dir)
    for t in ("i", "j"):
        links = links.join(kept.withColumnRenamed("tile_index", t), ["acq_id", t], "left_semi")
    return components(tiles, links).select(
        "tile_index", "root", F.round("oy").cast("long").alias("oy"), F.round("ox").cast("long").alias("ox")
    )


TILE_COMPONENTS = f"""with {V.TILES},
kept as (select *, (r + 1) // 5 as band from tile where r % 5 <> 3),
rooted as (select *, first_value(tile_index) over w as root, first_value(true_y) over w as ry, first_value(true_x) over w as rx
           from kept window w as (partition by band order by tile_index))
select tile_index, root, cast(true_y - ry as bigint) as oy, cast(true_x - rx as bigint) as ox from rooted"""


def solved_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels to positions: match by phase correlation, then solve."""
    tiles, blocks, pairs = _inputs(spark, sf_dir)
    found = cut_lineage(pair_shifts(pair_crops(blocks, tiles, pairs, SEARCH), SEARCH, "phase", min_overlap=64))
    positions, _ = solve_positions(tiles, to_links(tiles, found))
    return positions.select(
        "tile_index", F.round("pos_y", 3).alias("pos_y"), F.round("pos_x", 3).alias("pos_x")
    )


SOLVED_POSITIONS = f"""with {V.TILES}
select t.tile_index, cast(t.true_y - a.true_y + a.pos_y as double) as pos_y, cast(t.true_x - a.true_x + a.pos_x as double) as pos_x
from tile t join tile a on a.tile_index = 0"""


def _corrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column links of every fifth tile are off by five samples."""
    bad = (F.col("j") - F.col("i") == 6) & (F.col("i") % 17 == 3)
    return planted_links(spark, sf_dir).withColumn("dy", F.col("dy") + F.when(bad, 5.0).otherwise(0.0))


def pruned_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links left after outliers have been dropped round by round."""
    tiles = V.tiles(spark, sf_dir)
    _, links, _ = solve_with_pruning(tiles, _corrupted(spark, sf_dir), max_error=1.0)
    return links.select("i", "j", F.round("dy", 3).alias("dy"), F.round("dx", 3).alias("dx"))


PRUNED_LINKS = f"""with {V.TILES}, {_NEIGHBOURS}
select i, j, cast(b.true_y - a.true_y as double) as dy, cast(b.true_x - a.true_x as double) as dx
from near join tile a on a.tile_index = i join tile b on b.tile_index = j where not (j - i = 6 and i % 17 = 3)"""


def solve_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of the planted links at the nominal positions: what the optimiser starts from."""
    from tilewright.operators.solve import solve_log as summarise

    log = summarise(0, planted_links(spark, sf_dir), V.tiles(spark, sf_dir))
    return log.select("iteration", "n_links", F.round("mean_err", 6).alias("mean_err"), F.round("max_err", 6).alias("max_err"))


SOLVE_LOG = f"""with {V.TILES}, {_NEIGHBOURS},
e as (select sqrt(((b.pos_y - a.pos_y) - (b.true_y - a.true_y)) ** 2 + ((b.pos_x - a.pos_x) - (b.true_x - a.true_x)) ** 2) as err
      from near join tile a on a.tile_index = i join tile b on b.tile_index = j)
select 0 as iteration, count(*) as n_links, round(avg(err), 6) as mean_err, round(max(err), 6) as max_err from e"""


def rematch_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs still to match when part of the links is already accepted."""
    from tilewright.plans.reconstruct import pairs_to_match

    tiles = V.tiles(spark, sf_dir)
    accepted = planted_links(spark, sf_dir).where("(i + j) % 3 <> 0")
    return pairs_to_match(tiles, accepted, "incremental", min_overlap=MIN_OVERLAP).select("i", "j", "overlap")


REMATCH_INCREMENTAL = f"""with {V.TILES}, {_NEIGHBOURS}
select o.i, o.j, (hi_y - lo_y) * (hi_x - lo_x) as overlap from o join near using (i, j) where (i + j) % 3 = 0"""


def top_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest overlaps of each tile as candidate partners."""
    pairs = overlap_pairs(V.tiles(spark, sf_dir)).select("i", "j", "overlap")
    return top_per_pair(pairs, ["i"], "overlap", 3)


TOP_OVERLAPS = f"""with {V.TILES}, o as ({_OVERLAP.format(p=0)}),
s as (select i, j, (hi_y - lo_y) * (hi_x - lo_x) as overlap from o)
select *, row_number() over (partition by i order by overlap desc, j) as rank from s
qualify rank <= 3"""


# --- fuse and pyramid --------------------------------------------------------------------


def _fused(spark, sf_dir, positions, **options) -> DataFrame:
    tiles, blocks, _ = _inputs(spark, sf_dir)
    return fuse(blocks, tiles, positions or tiles, OUT_CELL, reach=B.tile_sizes(blocks), **options)


def fused_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles at their nominal places, blended: overlapping samples differ, so weights matter."""
    return _lines(_fused(spark, sf_dir, None), ["cy", "cx"]).drop("z")


def fused_maxweight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(_fused(spark, sf_dir, None, blending=False, fill=False), ["cy", "cx"]).drop("z")


def fused_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles at their true places give the scene back wherever one covers it."""
    return _lines(_fused(spark, sf_dir, V.true_positions(spark, sf_dir), fill=False), ["cy", "cx"]).drop("z")


def fused_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third tile is missing; the holes take the channel background."""
    tiles = cut_lineage(V.tiles(spark, sf_dir).where("tile_index % 3 <> 1"))
    blocks = cut_lineage(V.tile_blocks(spark, sf_dir))
    blocks = blocks.join(tiles.select("acq_id", "tile_index"), ["acq_id", "tile_index"], "left_semi")
    return _lines(fuse(blocks, tiles, tiles, OUT_CELL, reach=B.tile_sizes(blocks)), ["cy", "cx"]).drop("z")


def fused_solved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: match, solve and fuse; equals the scene from the first tile's place on."""
    tiles, blocks, pairs = _inputs(spark, sf_dir)
    found = cut_lineage(pair_shifts(pair_crops(blocks, tiles, pairs, SEARCH), SEARCH, "phase", min_overlap=64))
    positions, _ = solve_positions(tiles, to_links(tiles, found))
    return _lines(fuse(blocks, tiles, positions, OUT_CELL, fill=False, reach=B.tile_sizes(blocks)), ["cy", "cx"]).drop("z")


def _fuse_sql(ypos, xpos, value, fill, keep="true"):
    return f"""with {V.TILE_PX},
px as (select *, {ypos} + y - (select min({ypos}) from tile where {keep}) as gy, {xpos} + x - (select min({xpos}) from tile where {keep}) as gx,
         (least(y, 31 - y) + 1) * (least(x, 31 - x) + 1) as w from tile_pixel where {keep}),
ext as (select max(gy) + 1 as h, max(gx) + 1 as wd from px),
bg as (select min(v) as b from (select v, row_number() over (order by v) as k, count(*) over () as n from px) where k >= ceil(n * 0.01)),
out as (select gy, gx, {value} as v from px group by gy, gx),
grid as (select gy, gx from (select unnest(range(0, (select h from ext))) as gy), (select unnest(range(0, (select wd from ext))) as gx))
select gy // 32 as cy, gx // 32 as cx, gy as y, (gx // 32) * 32 as x0,
       string_agg(cast(cast(coalesce(v, {fill}) as bigint) as varchar), ',' order by gx) as line
from grid left join out using (gy, gx) group by gy, gx // 32"""


_BLEND = "(2 * sum(w * v) + sum(w)) // (2 * sum(w))"
FUSED_BLOCKS = _fuse_sql("pos_y", "pos_x", _BLEND, "(select b from bg)")
FUSED_MAXWEIGHT = _fuse_sql("pos_y", "pos_x", "first(v order by w desc, tile_index)", "0")
FUSED_SCENE = _fuse_sql("true_y", "true_x", "min(v)", "0")
FUSED_FILL = _fuse_sql("pos_y", "pos_x", _BLEND, "(select b from bg)", "tile_index % 3 <> 1")


def _scene_pyramid(spark: SparkSession, sf_dir: str):
    scene = V.scene(spark, sf_dir)
    size = scene.agg(*[F.max(F.col(f"{a}0") + F.col(f"n{a}")).alias(a) for a in "zyx"]).first()
    factors = level_factors((size["z"], size["y"], size["x"]), (0.42, 0.23, 0.23), (1, 32, 32))
    return scene, factors


def pyramid_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level sums of the scene as image lines."""
    scene, factors = _scene_pyramid(spark, sf_dir)
    out = pyramid(scene, factors, (1, 32, 32))
    return _sum_lines(out)


def _sum_lines(levels: DataFrame) -> DataFrame:
    lines = to_scanlines(levels, ["level", "cy", "cx"], "<i8").withColumn("line", F.array_join("values", ","))
    return _whole_lines(lines, ["level", "cy", "cx", "y"])


PYRAMID_LEVELS = f"""with {V.SCENE},
deep as (select min(n) as n from (select unnest(range(0, 40)) as n), (select greatest(max(y), max(x)) + 1 as side from scene) where side <= 32 * 2 ** n),
levels as (
  select l as level, y // cast(2 ** l as bigint) as y, x // cast(2 ** l as bigint) as x, sum(v) as s
  from scene, (select unnest(range(1, (select n + 1 from deep))) as l) group by all)
select level, y // 32 as cy, x // 32 as cx, y, string_agg(cast(cast(s as bigint) as varchar), ',' order by x) as line
from levels group by level, y, x // 32"""


def pyramid_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded means per level; edge cells average what they hold."""
    scene, factors = _scene_pyramid(spark, sf_dir)
    extents = B.tile_sizes(scene).select("acq_id", *[F.col(f"size_{a}").alias(f"ext_{a}") for a in "zyx"])
    means = level_means(pyramid(scene, factors, (1, 32, 32)), extents, factors)
    return _whole_lines(_lines(means, ["level", "cy", "cx"]), ["level", "cy", "cx", "y"])


PYRAMID_MEANS = f"""with {V.SCENE},
deep as (select min(n) as n from (select unnest(range(0, 40)) as n), (select greatest(max(y), max(x)) + 1 as side from scene) where side <= 32 * 2 ** n),
levels as (
  select l as level, y // cast(2 ** l as bigint) as y, x // cast(2 ** l as bigint) as x, (2 * sum(v) + count(*)) // (2 * count(*)) as s
  from scene, (select unnest(range(1, (select n + 1 from deep))) as l) group by all)
select level, y // 32 as cy, x // 32 as cx, y, string_agg(cast(cast(s as bigint) as varchar), ',' order by x) as line
from levels group by level, y, x // 32"""


# --- the whole plan ----------------------------------------------------------------------

MOSAIC = {
    "stitching_block_size": "16,16,2",
    "final_block_size_xy": 32,
    "stitching_blur_sigma": 0,
    "search_radius": "4,4,0",
    "min_overlap": 160,
    "fill": False,
}


def _reconstructed(spark: SparkSession, sf_dir: str, **options):
    from tilewright.plans.reconstruct import reconstruct
    from tilewright.session import staging_path

    planes, stage = cut_lineage(V.mosaic_planes(spark, sf_dir)), V.mosaic_stage(spark, sf_dir)
    return reconstruct(spark, planes, stage, staging_path(spark, "reconstruct"), **{**MOSAIC, **options})


def reconstruct_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes and stage coordinates to all levels of the export, for two acquisitions of different extent."""
    run = _reconstructed(spark, sf_dir)
    return _lines(run.table("export"), ["acq_id", "channel", "level"])


_MOSAIC_TILES = V.TILES + """,
acq as (select unnest(['first', 'second']) as acq_id),
part as (select acq_id, tile.* from tile cross join acq where acq_id = 'first' or r * 2 <= (select max(r) from tile)),
low as (select acq_id, min(true_y) as ly, min(true_x) as lx, max(true_y) + 32 - min(true_y) as h, max(true_x) + 32 - min(true_x) as w from part group by acq_id)"""
RECONSTRUCT_EXPORT = f"""with {V.SCENE}, {_MOSAIC_TILES},
covered as (select distinct acq_id, s.y, s.x, s.v from part t join scene s on s.y between t.true_y and t.true_y + 31 and s.x between t.true_x and t.true_x + 31),
grid as (select acq_id, gy, gx from low, unnest(range(0, h)) a(gy), unnest(range(0, w)) b(gx)),
base as (select g.acq_id, channel, z, gy, gx,
    coalesce(v * (1 + channel) + 7 * z + case when g.acq_id = 'second' then 100 else 0 end, 0) as v
  from grid g join low using (acq_id) cross join (select unnest([0, 1]) as channel) cross join (select unnest([0, 1]) as z)
  left join covered c on c.acq_id = g.acq_id and c.y = g.gy + ly and c.x = g.gx + lx),
deep as (select acq_id, min(n) as n from low, (select unnest(range(0, 40)) as n) where greatest(h, w) <= 32 * 2 ** n group by acq_id),
level as (select acq_id, l from deep, (select unnest(range(0, 41)) as l) where l <= n),
out as (
  select acq_id, channel, l as level, z // (case when l >= 2 then 2 else 1 end) as z, gy // cast(2 ** l as bigint) as y, gx // cast(2 ** l as bigint) as x,
    (2 * sum(v) + count(*)) // (2 * count(*)) as v
  from base join level using (acq_id) group by all)
select acq_id, channel, level, z, y, (x // 32) * 32 as x0, string_agg(cast(cast(v as bigint) as varchar), ',' order by x) as line
from out group by acq_id, channel, level, z, y, x // 32"""


def reconstruct_flatfield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan with its optional stage: rows that each stage traced per acquisition."""
    run = _reconstructed(spark, sf_dir, flatfield_correction=True, stitching_channel="c1")
    return run.trace().where("stage in ('blocks', 'tiles', 'field', 'corrected', 'matching', 'positions')").select("stage", "acq_id", "rows", "status")


RECONSTRUCT_FLATFIELD = f"""with {_MOSAIC_TILES},
n as (select acq_id, count(*) as tiles from part group by acq_id)
select stage, acq_id, cast(case stage when 'field' then 8 when 'matching' then 4 * tiles when 'blocks' then 8 * tiles when 'corrected' then 8 * tiles else tiles end as bigint) as rows,
  'ok' as status from n cross join (select unnest(['blocks', 'tiles', 'field', 'corrected', 'matching', 'positions']) as stage)"""


QUERIES = {
    "reconstruct_export": (reconstruct_export, RECONSTRUCT_EXPORT),
    "reconstruct_flatfield": (reconstruct_flatfield, RECONSTRUCT_FLATFIELD),
    "stage_to_pixel": (stage_to_pixel, STAGE_TO_PIXEL),
    "channel_filter": (channel_filter, CHANNEL_FILTER),
    "axis_words": (axis_words, AXIS_WORDS),
    "blocks_split": (blocks_split, BLOCKS_SPLIT),
    "blocks_roundtrip": (blocks_roundtrip, BLOCKS_ROUNDTRIP),
    "channel_metadata": (channel_metadata, CHANNEL_METADATA),
    "pixel_histogram": (pixel_histogram, PIXEL_HISTOGRAM),
    "flatfield_fields": (flatfield_fields, FLATFIELD_FIELDS),
    "flatfield_binned": (flatfield_binned, FLATFIELD_BINNED),
    "flatfield_applied": (flatfield_applied, FLATFIELD_APPLIED),
    "channel_average": (channel_average, CHANNEL_AVERAGE),
    "gaussian_blur": (blurred, GAUSSIAN_BLUR),
    "overlap_pairs": (overlaps, OVERLAP_PAIRS),
    "top_overlaps": (top_overlaps, TOP_OVERLAPS),
    "pair_shifts_phase": (pair_shifts_phase, PAIR_SHIFTS),
    "pair_shifts_ncc": (pair_shifts_ncc, PAIR_SHIFTS),
    "pair_shifts_windows": (pair_shifts_windows, PAIR_SHIFTS),
    "pair_peaks": (pair_peaks, PAIR_PEAKS),
    "tile_components": (tile_components, TILE_COMPONENTS),
    "solved_positions": (solved_positions, SOLVED_POSITIONS),
    "pruned_links": (pruned_links, PRUNED_LINKS),
    "solve_log": (solve_log, SOLVE_LOG),
    "rematch_incremental": (rematch_incremental, REMATCH_INCREMENTAL),
    "fused_blocks": (fused_blocks, FUSED_BLOCKS),
    "fused_maxweight": (fused_maxweight, FUSED_MAXWEIGHT),
    "fused_scene": (fused_scene, FUSED_SCENE),
    "fused_fill": (fused_fill, FUSED_FILL),
    "fused_solved": (fused_solved, FUSED_SCENE),
    "pyramid_levels": (pyramid_levels, PYRAMID_LEVELS),
    "pyramid_means": (pyramid_means, PYRAMID_MEANS),
}
