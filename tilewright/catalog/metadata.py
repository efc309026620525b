"""Queries over metadata files: written from the given tables, read back, next to their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.catalog import views as V
from tilewright.operators import blocks as B
from tilewright.operators.rules import list_conformance
from tilewright.session import staging_path
from tilewright.sources import metadata as MD
from tilewright.sources.samplesheet import source_path


def read_stage_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage positions of every tile, through the XML that a microscope writes, 512 tiles a file."""
    path = staging_path(spark, "stage-xml")
    line = F.format_string(
        '<Data Acquisition="%s" Index="%d" PositionX="%d" PositionY="%d" PositionZ="%d"/>', "acq_id", "tile_index", "pos_x", "pos_y", "pos_z"
    )
    lines = V.tiles(spark, sf_dir).select(F.floor(F.col("tile_index") / 512).alias("part"), line.alias("line"))
    one = F.concat(F.lit("<Stage>"), F.array_join(F.array_sort(F.collect_list("line")), ""), F.lit("</Stage>"))
    lines.groupBy("part").agg(one.alias("value")).write.partitionBy("part").text(path)
    stage = MD.read_stage_metadata(spark, path)
    at = [F.col("stage")[k].cast("long").alias(a) for k, a in enumerate(("x", "y", "z"))]
    return stage.select("acq_id", "tile_index", *at)


READ_STAGE_XML = f"""with {V.TILES}
select 'scene' as acq_id, tile_index, cast(pos_x as bigint) as x, cast(pos_y as bigint) as y, 0::bigint as z from tile"""


def tile_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile metadata as JSON and back."""
    path = staging_path(spark, "tiles-json")
    tiles = V.tiles(spark, sf_dir)
    MD.write_tile_metadata(tiles.withColumn("file", F.format_string("t%02d.czi", "tile_index")), path)
    read = MD.read_tile_metadata(spark, path)
    return read.select("acq_id", "tile_index", *[F.col(f"pos_{a}").cast("long").alias(f"pos_{a}") for a in "zyx"], "size_y", "size_x", "file")


TILE_JSON = f"""with {V.TILES}
select 'scene' as acq_id, tile_index, 0::bigint as pos_z, cast(pos_y as bigint) as pos_y, cast(pos_x as bigint) as pos_x,
  32::int as size_y, 32::int as size_x, format('t{{:02d}}.czi', tile_index) as file from tile"""


def _written_channels(spark: SparkSession, sf_dir: str) -> str:
    """Channel metadata and final positions of the same acquisition in one folder."""
    folder = staging_path(spark, "channels")
    blocks = V.multichannel(spark, sf_dir)
    channels = B.channel_metadata(blocks)
    MD.write_channel_metadata(channels, folder)
    tiles = blocks.select("acq_id", "tile_index").distinct()
    positions = tiles.select("acq_id", "tile_index", *[(F.col("tile_index") * k).cast("double").alias(f"pos_{a}") for a, k in zip("zyx", (0, 8, 3))])
    MD.write_positions(positions, channels, folder)
    return folder


def channel_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel metadata read by pattern; final results beside it don't match."""
    return MD.read_channel_metadata(spark, _written_channels(spark, sf_dir)).drop("acq_id")


CHANNEL_GLOB = """select vec_id % 4 as channel, count(distinct vec_id // 4) as n_tiles, count(*) as n_blocks,
  1::bigint as size_z, 8::bigint as size_y, 8::bigint as size_x, count(*) * 128 as n_bytes from embeddings group by 1"""


def final_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final positions read by pattern, every tile once per channel."""
    read = MD.read_positions(spark, _written_channels(spark, sf_dir))
    return read.select("channel", "tile_index", *[F.col(f"pos_{a}").cast("long").alias(f"pos_{a}") for a in "zyx"])


FINAL_GLOB = """select c.channel, t.tile_index, 0::bigint as pos_z, t.tile_index * 8 as pos_y, t.tile_index * 3 as pos_x
from (select distinct vec_id % 4 as channel from embeddings) c cross join (select distinct vec_id // 4 as tile_index from embeddings) t"""


def list_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subset, intersection, difference and order tests of each conversation's list of roles."""
    turns = V.table(spark, sf_dir, "conversations")
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda t: t["role"])
    listed = turns.groupBy("conv_id").agg(roles.alias("roles"))
    out = list_conformance(listed, "roles", ["system", "user"])
    return out.select("conv_id", F.array_join("missing", ",").alias("missing"), "contains_all", "overlaps", "order_violation")


LIST_OVERLAP = """with p as (
  select conv_id, list(role order by turn, role) as roles from conversations group by 1),
q as (select conv_id, coalesce(list_position(roles, 'system'), 0) as s, coalesce(list_position(roles, 'user'), 0) as u from p)
select conv_id, concat_ws(',', case when s = 0 then 'system' end, case when u = 0 then 'user' end) as missing,
  s > 0 and u > 0 as contains_all, s > 0 or u > 0 as overlaps, not (s < u) as order_violation from q"""


def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that isn't set adds no rows to the union with one that is."""
    path = staging_path(spark, "regions")
    V.table(spark, sf_dir, "nation").select(F.col("n_name").alias("value")).write.text(path)
    given = source_path(spark, path, "value string")
    return given.unionByName(source_path(spark, None, "value string"))


OPTIONAL_SOURCE = "select n_name as value from nation"

QUERIES = {
    "read_stage_xml": (read_stage_xml, READ_STAGE_XML),
    "tile_json_roundtrip": (tile_json_roundtrip, TILE_JSON),
    "channel_glob": (channel_glob, CHANNEL_GLOB),
    "final_glob": (final_glob, FINAL_GLOB),
    "list_overlap": (list_overlap, LIST_OVERLAP),
    "optional_source": (optional_source, OPTIONAL_SOURCE),
}
