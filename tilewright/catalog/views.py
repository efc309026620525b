"""Views of the given tables that the catalogued queries run on, with their DuckDB text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.operators.blocks import TILE, convert_to_blocks
from tilewright.operators.boxes import BOX_FIELDS, crop_boxes, to_bytes

TILE_BLOCK = (1, 16, 16)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- pixels ------------------------------------------------------------------------------


def _patches(spark: SparkSession, sf_dir: str, acq: str, **cols) -> DataFrame:
    """Each embedding as one 1x8x8 box of quantised samples; placement by column expression."""
    # The key depends on the row, as in stored tables: a literal would be folded out of joins.
    placed = table(spark, sf_dir, "embeddings").select(
        F.when(F.col("vec_id") >= 0, acq).alias("acq_id"),
        cols["tile_index"].cast("long").alias("tile_index"),
        cols["channel"].cast("int").alias("channel"),
        cols["z0"].cast("long").alias("z0"),
        cols["y0"].cast("long").alias("y0"),
        cols["x0"].cast("long").alias("x0"),
        "embedding",
    )
    schema = T.StructType([*[placed.schema[c] for c in TILE], *BOX_FIELDS])

    def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            px = [to_bytes(np.floor(np.asarray(v, "float64") * 1000) + 1000) for v in batch["embedding"]]
            yield batch.assign(nz=1, ny=8, nx=8, data=px)[schema.fieldNames()]

    return placed.mapInPandas(quantise, schema)


def scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mosaic 20 patches wide, one tile."""
    v = F.col("vec_id")
    return _patches(
        spark, sf_dir, "scene", tile_index=F.lit(0), channel=F.lit(0), z0=F.lit(0),
        y0=F.floor(v / 20) * 8, x0=v % 20 * 8,
    )


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes of 8x8 samples: channel = label, z = vec_id."""
    return _patches(
        spark, sf_dir, "stack", tile_index=F.lit(0), channel=F.col("label"), z0=F.col("vec_id"),
        y0=F.lit(0), x0=F.lit(0),
    )


def voxel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One volume 8 x 8 x number of embeddings."""
    return _patches(
        spark, sf_dir, "voxel", tile_index=F.lit(0), channel=F.lit(0), z0=F.col("vec_id"), y0=F.lit(0), x0=F.lit(0)
    )


def multichannel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four channels per tile: tile = vec_id div 4, channel = vec_id mod 4."""
    v = F.col("vec_id")
    return _patches(
        spark, sf_dir, "multi", tile_index=F.floor(v / 4), channel=v % 4, z0=F.lit(0), y0=F.lit(0), x0=F.lit(0)
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32x32 tiles of the scene at stride 24, nominal (``pos_*``) and planted (``true_*``) places.

    Tile row r starts on patch row 3r, so the rows come from the patches themselves.
    """
    patches = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 20).alias("patch_row"))
    height = patches.agg((F.max("patch_row") * 8 + 8).alias("h")).scalar()
    rows = patches.where("patch_row % 3 = 0").distinct().select((F.col("patch_row") / 3).cast("long").alias("r"))
    rows = rows.where(F.col("r") * 24 + 36 <= height)
    grid = rows.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    r, c = F.col("r"), F.col("c")
    return grid.select(
        F.when(r >= 0, "scene").alias("acq_id"),
        (r * 6 + c).alias("tile_index"),
        "r", "c",
        F.lit(0).cast("long").alias("pos_z"),
        (r * 24 + 2).alias("pos_y"),
        (c * 24 + 2).alias("pos_x"),
        (r * 24 + 2 + (r * 7 + c * 3) % 5 - 2).alias("true_y"),
        (c * 24 + 2 + (r * 5 + c * 11) % 5 - 2).alias("true_x"),
        F.lit(1).alias("size_z"), F.lit(32).alias("size_y"), F.lit(32).alias("size_x"),
    )


def tile_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles' samples, cut from the scene at their planted places, as blocks."""
    placed = tiles(spark, sf_dir)
    reach = placed.select("acq_id", "tile_index", "true_y", "true_x")
    for a in ("y", "x"):
        lo = F.col(f"true_{a}")
        reach = reach.withColumn(f"p{a}", F.explode(F.sequence(F.floor(lo / 8), F.floor((lo + 31) / 8))))
    patches = scene(spark, sf_dir).drop("tile_index").withColumns(
        {"py": F.floor(F.col("y0") / 8), "px": F.floor(F.col("x0") / 8)}
    )
    met = patches.join(reach, ["acq_id", "py", "px"]).withColumns(
        {
            "lo_z": F.lit(0).cast("long"), "hi_z": F.lit(1).cast("long"),
            "lo_y": F.col("true_y"), "hi_y": F.col("true_y") + 32,
            "lo_x": F.col("true_x"), "hi_x": F.col("true_x") + 32,
        }
    )
    crops = crop_boxes(met, [*TILE, "true_y", "true_x"])
    local = crops.withColumns({"y0": F.col("y0") - F.col("true_y"), "x0": F.col("x0") - F.col("true_x")})
    return convert_to_blocks(local.drop("true_y", "true_x"), TILE_BLOCK).drop("cz", "cy", "cx")


def mosaic_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles in two acquisitions, two channels and two planes, each with samples of its own.

    The second acquisition has only the upper half of the tile rows, so extents and levels differ.
    """
    spread = tile_blocks(spark, sf_dir).drop("acq_id", "channel", "z0")
    top = tiles(spark, sf_dir).agg(F.max("r").alias("top")).scalar()
    rows = (
        spread.withColumn("acq_id", F.explode(F.array(F.lit("first"), F.lit("second"))))
        .withColumn("channel", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("z0", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))
        .where((F.col("acq_id") == "first") | (F.floor(F.col("tile_index") / 6) * 2 <= top))
    )
    schema = T.StructType([*[rows.schema[c] for c in TILE], *BOX_FIELDS])

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [
                to_bytes(np.frombuffer(d, "<u2").astype("int64") * (1 + c) + 7 * z + 100 * (a == "second"))
                for d, c, z, a in zip(batch["data"], batch["channel"], batch["z0"], batch["acq_id"])
            ]
            yield batch.assign(data=data)[schema.fieldNames()]

    return rows.mapInPandas(turned, schema)


def mosaic_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage coordinates of those tiles at their nominal places, for the default resolution and axes."""
    placed = mosaic_planes(spark, sf_dir).select("acq_id", "tile_index").distinct().join(tiles(spark, sf_dir).drop("acq_id"), "tile_index")
    at = [-F.col("pos_x") * 0.23, F.col("pos_y") * 0.23, F.col("pos_z") * 0.42]
    size = [F.lit(2).alias("size_z"), "size_y", "size_x"]
    return placed.select("acq_id", "tile_index", F.array(*[c.cast("double") for c in at]).alias("stage"), *size)


def true_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles(spark, sf_dir).select(
        "acq_id", "tile_index", "pos_z", F.col("true_y").alias("pos_y"), F.col("true_x").alias("pos_x")
    )


# --- tables ------------------------------------------------------------------------------


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A samplesheet with planted faults."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id + 2 as line_no",
        "case when doc_id % 97 = 0 then '' else concat(replace(source, 'src', 'src '), ' ', lang) end as id",
        "case when doc_id % 89 = 0 then '' when doc_id % 3 = 0 then concat('F', doc_id, '.mvl') "
        "else concat('F_V', lpad(cast(doc_id % 40 as string), 2, '0'), '.czi') end as filename",
        "case when doc_id % 5 = 0 then 'F_V%02d.czi' when doc_id % 5 = 1 then '  ' else '' end as pattern",
        "case when doc_id % 13 = 0 then '' when doc_id % 11 = 0 then 'bad' else md5(cast(text as binary)) end as checksum",
        "case when doc_id % 4 = 0 then concat('file:///store/', doc_id) else '' end as uri",
        "doc_id",
    )


def file_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing files: path and content."""
    return (
        table(spark, sf_dir, "documents")
        .where("doc_id % 7 <> 0")
        .selectExpr("concat('store/', doc_id) as path", "cast(text as binary) as content", "doc_id")
    )


def version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat(case when p_partkey % 3 = 0 then 'MAIN:' else 'MAIN:SUB:' end, replace(p_name, ' ', '_')) as process",
        "p_brand as tool",
        "concat(p_size % 3, '.', p_partkey % 2) as version",
        "p_partkey",
    )


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name as acq",
        "concat(c_custkey % 9, '.5,0.23,0.42') as resolution",
        "cast(c_custkey % 4 as int) as workers",
        "c_custkey % 2 = 0 as cluster",
        "c_mktsegment as mode",
    )


def run_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as run_id", "event_type as stage", "user_id as acq", "ts as ended", "value",
        "case when event_type = 'error' then 'failed' when value < 1 then 'ignored' else 'ok' end as status",
    )


# --- DuckDB text of the same views -------------------------------------------------------

EMB_PX = """emb_px as (
  select vec_id, label, cast(k - 1 as bigint) as i, cast(floor(cast(embedding[k] as double) * 1000) as bigint) + 1000 as px
  from embeddings, (select unnest(range(1, 65)) as k))"""
STACK = EMB_PX + """,
stack as (select label as channel, vec_id as z, i // 8 as y, i % 8 as x, px as v from emb_px)"""
SCENE = EMB_PX + """,
scene as (select (vec_id // 20) * 8 + i // 8 as y, (vec_id % 20) * 8 + i % 8 as x, px as v from emb_px)"""
TILES = """tile as (
  select r * 6 + c as tile_index, r, c, r * 24 + 2 as pos_y, c * 24 + 2 as pos_x,
         r * 24 + 2 + (r * 7 + c * 3) % 5 - 2 as true_y, c * 24 + 2 + (r * 5 + c * 11) % 5 - 2 as true_x
  from (select unnest(range(0, (select max(vec_id) // 20 * 8 + 8 from embeddings) // 24 + 1)) as r),
       (select unnest(range(0, 6)) as c)
  where r * 24 + 36 <= (select max(vec_id) // 20 * 8 + 8 from embeddings))"""
TILE_PX = SCENE + """,
""" + TILES + """,
tile_pixel as (
  select t.tile_index, t.pos_y, t.pos_x, t.true_y, t.true_x, s.y - t.true_y as y, s.x - t.true_x as x, s.v
  from tile t join scene s on s.y between t.true_y and t.true_y + 31 and s.x between t.true_x and t.true_x + 31)"""
SHEET = """sheet as (
  select doc_id + 2 as line_no,
    case when doc_id % 97 = 0 then '' else concat(replace(source, 'src', 'src '), ' ', lang) end as id,
    case when doc_id % 89 = 0 then '' when doc_id % 3 = 0 then concat('F', doc_id, '.mvl')
         else concat('F_V', lpad(cast(doc_id % 40 as varchar), 2, '0'), '.czi') end as filename,
    case when doc_id % 5 = 0 then 'F_V%02d.czi' when doc_id % 5 = 1 then '  ' else '' end as pattern,
    case when doc_id % 13 = 0 then '' when doc_id % 11 = 0 then 'bad' else md5(text) end as checksum,
    case when doc_id % 4 = 0 then concat('file:///store/', doc_id) else '' end as uri, doc_id
  from documents)"""
VALID = SHEET + """,
valid as (select * exclude (id), replace(id, ' ', '_') as id from sheet where id <> '' and filename <> '')"""
VERSION_ROWS = """version_rows as (
  select concat(case when p_partkey % 3 = 0 then 'MAIN:' else 'MAIN:SUB:' end, replace(p_name, ' ', '_')) as process,
         p_brand as tool, concat(p_size % 3, '.', p_partkey % 2) as version, p_partkey from part)"""
SETTINGS = """settings as (
  select c_custkey, c_name as acq, concat(c_custkey % 9, '.5,0.23,0.42') as resolution,
         cast(c_custkey % 4 as int) as workers, c_custkey % 2 = 0 as cluster, c_mktsegment as mode from customer)"""
RUN_TRACE = """run_trace as (
  select event_id as run_id, event_type as stage, user_id as acq, ts as ended, value,
         case when event_type = 'error' then 'failed' when value < 1 then 'ignored' else 'ok' end as status from events)"""
