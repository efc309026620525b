"""Image operators on planted truth and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import flatfield as FF
from tilewright.operators import fuse as FU
from tilewright.operators import register as RE
from tilewright.operators import solve as SO
from tilewright.operators.blocks import convert_to_blocks, tile_sizes
from tilewright.operators.blur import gaussian_blur
from tilewright.operators.boxes import pixels
from tilewright.operators.overlap import overlap_pairs
from tilewright.operators.pyramid import level_factors, level_means, pyramid
from tilewright.plans.reconstruct import stitch

BOX = "acq_id string, tile_index long, channel int, z0 long, y0 long, x0 long, nz int, ny int, nx int, data binary"


def box(array, acq="a", tile=0, channel=0, origin=(0, 0, 0), dtype="<u2"):
    return (acq, tile, channel, *origin, *array.shape, array.astype(dtype).tobytes())


def image(rows, shape, dtype="<u2"):
    out = np.zeros(shape, dtype)
    for r in rows:
        out[r.z0 : r.z0 + r.nz, r.y0 : r.y0 + r.ny, r.x0 : r.x0 + r.nx] = pixels(r.data, r.nz, r.ny, r.nx, dtype)
    return out


@pytest.fixture(scope="module")
def world():
    return np.random.default_rng(5).integers(0, 4000, (12, 120, 120))


def tile_rows(spark, world, places, size):
    rows = [box(world[z : z + size[0], y : y + size[1], x : x + size[2]], tile=i) for i, (z, y, x) in enumerate(places)]
    return spark.createDataFrame(rows, BOX)


def tile_table(spark, places, size):
    rows = [("a", i, *map(float, p), *size) for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "acq_id string, tile_index long, pos_z double, pos_y double, pos_x double, size_z int, size_y int, size_x int")


def test_blocks_split_and_assemble_is_identity(spark, world):
    blocks = convert_to_blocks(spark.createDataFrame([box(world)], BOX), (5, 50, 32))
    assert blocks.count() == 3 * 3 * 4
    assert (image(blocks.collect(), world.shape) == world).all()
    assert tuple(tile_sizes(blocks).first())[2:] == world.shape


def test_overlap_matches_all_pairs_check(spark):
    rng = np.random.default_rng(1)
    places = rng.integers(-40, 200, (60, 3))
    # Half the tiles share one place: every true pair must still come out exactly once.
    places[30:] = places[30]
    size = (20, 30, 40)
    got = [(r["i"], r["j"]) for r in overlap_pairs(tile_table(spark, places, size), (1, 2, 3)).select("i", "j").collect()]
    reach = np.array(size) + 2 * np.array((1, 2, 3))
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if (abs(places[i] - places[j]) < reach).all()}
    assert len(got) == len(set(got)) and set(got) == want


def test_stitch_volume_recovers_planted_places(spark, world):
    size = (10, 48, 48)
    true = [(1, y, x) for y in (0, 36) for x in (0, 36)]
    rng = np.random.default_rng(3)
    nominal = [(0, 0, 0)] + [tuple(np.array(t) - (1, 0, 0) + rng.integers(-2, 3, 3) * (0, 1, 1)) for t in true[1:]]
    blocks = convert_to_blocks(tile_rows(spark, world, true, size), (8, 32, 32))
    positions, _, log = stitch(
        blocks, tile_table(spark, nominal, size), "full", search=(1, 4, 4), min_overlap=1000, max_rounds=2
    )
    got = {r["tile_index"]: (r["pos_z"], r["pos_y"], r["pos_x"]) for r in positions.collect()}
    assert all(np.allclose(got[i], np.array(t) - (1, 0, 0), atol=1e-3) for i, t in enumerate(true))
    assert log.agg(F.max("max_err")).first()[0] < 1e-6

def overlapping(world, a_at, b_at, size, jitter=0):
    a = world[a_at[0] : a_at[0] + size[0], a_at[1] : a_at[1] + size[1], a_at[2] : a_at[2] + size[2]]
    b = world[b_at[0] : b_at[0] + size[0], b_at[1] : b_at[1] + size[1], b_at[2] : b_at[2] + size[2]]
    return a, b + jitter


def test_windows_give_the_correlation_of_the_whole_overlap(spark, world):
    size, search = (10, 60, 60), (1, 3, 3)
    noise = np.random.default_rng(6).integers(0, 1500, size)
    a, b = overlapping(world, (1, 0, 0), (0, 31, 2), size, noise)
    nominal = [(0, 0, 0), (0, 30, 0)]
    blocks = convert_to_blocks(spark.createDataFrame([box(a, tile=0), box(b, tile=1)], BOX), (4, 32, 32))
    tiles = tile_table(spark, nominal, size)
    crops = RE.pair_crops(blocks, tiles, overlap_pairs(tiles), search)
    found = {cell: RE.pair_shifts(crops, search, "ncc", cell=cell).collect() for cell in ((64, 128, 128), (3, 16, 20))}
    assert found[64, 128, 128] == found[3, 16, 20] and len(found[3, 16, 20]) == 1
    r = found[3, 16, 20][0]
    assert (r.dz, r.dy, r.dx) == (-1, 1, 2)
    # the same by the whole arrays
    va, vb = a[:9, 31:, 2:].astype(float), b[1:, :29, :58].astype(float)
    assert r.n_px == va.size and r.ncc == pytest.approx(np.corrcoef(va.reshape(-1), vb.reshape(-1))[0, 1], abs=1e-12)
    phase = RE.pair_shifts(crops, search, "phase", cell=(5, 30, 30)).collect()[0]
    assert (phase.dz, phase.dy, phase.dx, phase.n_px) == (-1, 1, 2, r.n_px) and phase.ncc == pytest.approx(r.ncc)
    # a range in which no shift brings enough samples together
    none = RE.pair_shifts(crops, search, "ncc", min_overlap=10**6).collect()[0]
    assert (none.valid, none.ncc, none.n_px) == (False, -2.0, 0)


def test_windows_are_bounded_and_payload_moves_as_crops(spark, world):
    size, search, cell = (8, 100, 40), (1, 2, 2), (4, 25, 25)
    blocks = convert_to_blocks(tile_rows(spark, world, [(0, 0, 0), (0, 10, 20)], size), (8, 50, 40))
    tiles = tile_table(spark, [(0, 0, 0), (0, 10, 20)], size)
    crops = RE.pair_crops(blocks, tiles, overlap_pairs(tiles), search)
    plan = crops._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("MapInArrow")[1] and "SortMergeJoin" not in plan.split("Scan")[0].split("BroadcastExchange")[0]
    rows = RE.window_pairs(crops, search, cell).collect()
    assert len(rows) > 8
    for r in rows:
        assert len(r.data) <= 2 * 4 * 25 * 25 and len(r.b_data) <= 2 * 6 * 29 * 29
    # samples in floating point, as blurred blocks are
    smooth = gaussian_blur(blocks, tile_sizes(blocks), (8, 50, 40), 1.0, ["acq_id", "tile_index", "channel"], (1, 2))
    blurred = RE.pair_crops(smooth, tiles, overlap_pairs(tiles), search, dtype="<f8")
    r = RE.pair_shifts(blurred, search, "phase", dtype="<f8", cell=cell).collect()[0]
    assert (r.dz, r.dy, r.dx) == (0, 0, 0) and 0.9 < r.ncc <= 1
    flat = spark.createDataFrame([box(np.full(size, 7), tile=t) for t in (0, 1)], BOX)
    assert RE.pair_shifts(RE.pair_crops(flat, tiles, overlap_pairs(tiles), search), search, "ncc").first().ncc == -1


def grid_links(spark, n_rows, n_cols, noise=0.0):
    rng = np.random.default_rng(11)
    place = rng.normal(0, 50, (n_rows * n_cols, 3))
    links = []
    for r in range(n_rows):
        for c in range(n_cols):
            i = r * n_cols + c
            for j in ([i + 1] if c + 1 < n_cols else []) + ([i + n_cols] if r + 1 < n_rows else []):
                links.append(("a", i, j, *(place[j] - place[i] + rng.normal(0, noise, 3)).tolist(), float(rng.uniform(0.5, 1))))
    frame = spark.createDataFrame(links, "acq_id string, i long, j long, dz double, dy double, dx double, w double")
    return place, links, frame


def test_solver_across_buckets_is_least_squares(spark, monkeypatch):
    """Small buckets: trees are joined by contraction, and several iterations are needed."""
    monkeypatch.setattr(SO, "BUCKET", 5)
    place, links, frame = grid_links(spark, 3, 3, noise=1.0)
    tiles = tile_table(spark, [(0, 0, 0)] * 9, (1, 1, 1))
    positions, log = SO.solve_positions(tiles, frame, tolerance=1e-7)
    got = np.array([[r["pos_z"], r["pos_y"], r["pos_x"]] for r in positions.orderBy("tile_index").collect()])
    a = np.zeros((len(links), 9))
    for k, (_, i, j, *_d, w) in enumerate(links):
        a[k, i], a[k, j] = -np.sqrt(w), np.sqrt(w)
    d = np.array([l[3:6] for l in links]) * np.sqrt([[l[6]] for l in links])
    want = np.linalg.lstsq(a, d, rcond=None)[0]
    assert np.allclose(got - got[0], want - want[0], atol=1e-5) and log.count() > 2
    roots = SO.components(tiles, frame).select("root").distinct().collect()
    assert [r["root"] for r in roots] == [0]


def test_components_keep_unlinked_tiles(spark, monkeypatch):
    monkeypatch.setattr(SO, "BUCKET", 2)
    links = spark.createDataFrame(
        [("a", 9, 1, 0.0, 1.0, 0.0, 1.0), ("a", 4, 9, 0.0, 2.0, 0.0, 1.0), ("b", 1, 2, 0.0, 5.0, 0.0, 1.0)],
        "acq_id string, i long, j long, dz double, dy double, dx double, w double",
    )
    tiles = spark.createDataFrame([("a", t) for t in (1, 4, 6, 9)] + [("b", 1), ("b", 2)], "acq_id string, tile_index long")
    got = {(r["acq_id"], r["tile_index"]): (r["root"], r["oy"]) for r in SO.components(tiles, links).collect()}
    assert got == {("a", 1): (1, 0.0), ("a", 9): (1, -1.0), ("a", 4): (1, -3.0), ("a", 6): (6, 0.0), ("b", 1): (1, 0.0), ("b", 2): (1, 5.0)}


def test_fuse_identity_and_hot_blocks(spark, world, monkeypatch):
    size = (12, 60, 60)
    places = [(0, y, x) for y in (0, 30, 60) for x in (0, 30, 60)] * 2
    blocks = convert_to_blocks(tile_rows(spark, world, places, size), (12, 32, 32))
    # Shift the copies' samples so that weights and ties matter.
    tiles = tile_table(spark, places, size)
    shifted = tile_table(spark, [(0, y + (i > 8), x) for i, (_, y, x) in enumerate(places)], size)
    for options in ({"blending": True}, {"blending": False}):
        plain = {tuple(r)[:5]: tuple(r) for r in FU.fuse(blocks, shifted, shifted, (6, 40, 40), **options).collect()}
        with monkeypatch.context() as m:
            m.setattr(FU, "GROUP_LIMIT", 2)
            salted = {tuple(r)[:5]: tuple(r) for r in FU.fuse(blocks, shifted, shifted, (6, 40, 40), **options).collect()}
        assert plain == salted
        out = FU.fuse(blocks, tiles, tiles, (6, 40, 40), **options)
        assert (image(out.collect(), world.shape) == world).all()


def test_flatfield_finds_planted_shading(spark):
    rng = np.random.default_rng(2)
    shade = 1 + 0.3 * rng.uniform(-1, 1, (6, 8))
    shade /= shade.mean()
    level = rng.integers(500, 20000, (300, 1, 1))
    stack = np.rint(level * shade)
    rows = spark.createDataFrame([box(stack[k : k + 1], origin=(k, 0, 0)) for k in range(300)], BOX)
    # cells that are no part of the image's sides
    small = FF.estimate(FF.cell_histograms(rows, (4, 3)), (4, 3))
    field = FF.estimate(FF.cell_histograms(rows, (8, 8)), (8, 8))
    s, same = ({(r["y"], r["x"]): (r["s"], r["t"]) for r in FF.field_rows(f).collect()} for f in (field, small))
    assert s.keys() == same.keys() and np.allclose([s[k] for k in s], [same[k] for k in s])
    s = {k: v[0] for k, v in s.items()}
    assert np.allclose([[s[y, x] for x in range(8)] for y in range(6)], shade, atol=1e-3)
    fixed = image(FF.apply_field(rows, field, (8, 8)).collect(), stack.shape)
    assert np.abs(fixed.astype(float) - level).max() / 20000 < 2e-3


def test_flatfield_needs_equal_depth(spark):
    rows = spark.createDataFrame([box(np.ones((1, 2, 2))), box(np.ones((1, 1, 2)), origin=(1, 0, 0))], BOX)
    with pytest.raises(Exception, match="same number of samples"):
        FF.estimate(FF.cell_histograms(rows, (8, 8)), (8, 8)).collect()


def test_histograms_are_packed_and_bounded(spark, monkeypatch):
    stack = np.random.default_rng(4).integers(0, 65536, (40, 9, 13))
    rows = spark.createDataFrame([box(stack[k : k + 1, y : y + 5, :], origin=(k, y, 0)) for k in range(40) for y in (0, 4)][:80], BOX)
    whole = spark.createDataFrame([box(stack[k : k + 1], origin=(k, 0, 0)) for k in range(40)], BOX)
    want = {}
    for (k, y, x), v in np.ndenumerate(stack):
        want[y, x, int(v)] = want.get((y, x, int(v)), 0) + 1
    monkeypatch.setattr(FF, "HELD", 500)
    hist = FF.cell_histograms(whole, (4, 6))
    got = {(r.y, r.x, r.v): r.n for r in FF.histogram_rows(hist, (4, 6)).collect()}
    assert got == want and hist.count() == 3 * 3
    # boxes that lie across cells and each other count twice where they do
    twice = {(r.y, r.x): r.n for r in FF.histogram_rows(FF.cell_histograms(rows, (4, 6)), (4, 6)).groupBy("y", "x").agg(F.sum("n").alias("n")).collect()}
    assert twice[4, 0] == 80 and twice[3, 12] == 40
    # the bound of a binned cell doesn't depend on the depth
    binned = FF.cell_histograms(whole, (4, 6), 16, 1000, 50000).select(F.max(F.length("codes")).alias("b")).first().b
    assert binned <= 4 * 6 * 16 * 8
    rows = FF.histogram_rows(FF.cell_histograms(whole, (4, 6), 16, 1000, 50000), (4, 6)).collect()
    bins = np.clip((stack - 1000) * 16 // 49000, 0, 15) * 49000 // 16 + 1000
    assert {(r.y, r.x, r.v): r.n for r in rows} == {k: n for k, n in zip(*np.unique([(y, x, v) for (_, y, x), v in np.ndenumerate(bins)], axis=0, return_counts=True)) for k in [tuple(k.tolist())]}


def test_flatfield_shuffles_no_pixel_rows(spark, world):
    blocks = convert_to_blocks(spark.createDataFrame([box(world)], BOX), (4, 40, 40))
    plan = FF.cell_histograms(blocks, (40, 40))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(acq_id" in plan and "cy#" in plan and ", y#" not in plan
    deep = FF.estimate(FF.cell_histograms(blocks, (40, 40), 64, 0, 4000), (40, 40))
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert deep.count() == 9


def test_blur_keeps_constants_and_matches_direct_sum(spark, world):
    flat = spark.createDataFrame([box(np.full((3, 20, 20), 7))], BOX)
    out = gaussian_blur(convert_to_blocks(flat, (3, 8, 8)), tile_sizes(flat), (3, 8, 8), 1.0, ["acq_id", "tile_index", "channel"], (1, 2))
    assert np.allclose(image(out.collect(), (3, 20, 20), "<f8"), 7)
    small = world[:, :16, :16]
    src = convert_to_blocks(spark.createDataFrame([box(small)], BOX), (4, 8, 8))
    out = gaussian_blur(src, tile_sizes(src), (4, 8, 8), 1.0, ["acq_id", "tile_index", "channel"])
    w = np.exp(-np.arange(-3, 4) ** 2 / 2)
    want = np.pad(small.astype(float), 3, mode="reflect")
    for axis in range(3):
        want = np.apply_along_axis(lambda v: np.convolve(v, w / w.sum(), "valid"), axis, want)
    assert np.allclose(image(out.collect(), small.shape, "<f8"), want)


def test_level_plan():
    factors = level_factors((500, 4000, 4000), (0.42, 0.23, 0.23), (64, 512, 512))
    assert factors[:3] == [(1, 2, 2), (2, 2, 2), (2, 2, 2)]


def test_pyramid_conserves_mass(spark, world):
    odd = world[:, :101, :77]
    base = convert_to_blocks(spark.createDataFrame([box(odd)], BOX), (4, 32, 32))
    factors = level_factors(odd.shape, (0.42, 0.23, 0.23), (4, 32, 32))
    levels = pyramid(base, factors, (4, 32, 32))
    rows = levels.collect()
    for number in range(1, len(factors) + 1):
        assert sum(np.frombuffer(r.data, "<i8").sum() for r in rows if r.level == number) == odd.sum()
    extents = spark.createDataFrame([("a", *odd.shape)], "acq_id string, ext_z long, ext_y long, ext_x long")
    means = [r for r in level_means(levels, extents, factors).collect() if r.level == 1]
    got = image(means, (12, 51, 39))
    assert got[0, 50, 38] == odd[0, 100, 76] and got[3, 0, 0] == int(np.floor(odd[3, :2, :2].mean() + 0.5))


def test_paste_refuses_gaps_and_overlaps():
    from collections import namedtuple

    from tilewright.operators.boxes import paste, plane_runs

    box = namedtuple("Box", "z0 y0 x0 nz ny nx data")
    one = lambda z, y, v: box(z, y, 0, 1, 1, 2, np.full(2, v, "<u2").tobytes())
    assert paste([one(0, 0, 1), one(0, 1, 2)])[0].tolist() == [[[1, 1], [2, 2]]]
    with pytest.raises(ValueError, match="missing"):
        paste([one(0, 0, 1), one(1, 1, 1)])
    with pytest.raises(ValueError, match="overlap"):
        paste([one(0, 0, 1), one(0, 0, 2)])
    assert paste([one(0, 0, 1), one(0, 0, 2)], add=True)[0].tolist() == [[[3, 3]]]
    assert [len(run) for run in plane_runs([one(4, 0, 1), one(0, 0, 1), one(1, 0, 1)])] == [2, 1]


def test_pyramid_of_unaligned_blocks(spark):
    """Sums are whole wherever the blocks of the base begin."""
    from tilewright.operators.pyramid import pyramid

    fields = "acq_id string, channel int, z0 bigint, y0 bigint, x0 bigint, nz int, ny int, nx int, data binary"
    rng = np.random.default_rng(1)
    volume = rng.integers(0, 500, (4, 6, 10)).astype("<u2")
    cuts = [(z, y, x) for z in range(4) for y in (0, 3) for x in (0, 5)]
    rows = []
    for z, y, x in cuts:
        part = volume[z : z + 1, y : y + 3, x : x + 5]
        rows.append(("a", 0, z, y, x, *part.shape, part.tobytes()))
    levels = pyramid(spark.createDataFrame(rows, fields), [(2, 2, 2)], (2, 2, 2)).collect()
    got = np.zeros((2, 3, 5), dtype="<i8")
    for r in levels:
        got[r.z0 : r.z0 + r.nz, r.y0 : r.y0 + r.ny, r.x0 : r.x0 + r.nx] += np.frombuffer(r.data, "<i8").reshape(r.nz, r.ny, r.nx)
    want = volume.astype("<i8").reshape(2, 2, 3, 2, 5, 2).sum(axis=(1, 3, 5))
    assert (got == want).all()


def test_unconverged_positions_are_an_error(spark):
    from tilewright.operators.solve import solve_positions

    rng = np.random.default_rng(3)
    tiles = spark.createDataFrame(
        [("a", i, 0, (i // 3) * 10, (i % 3) * 10, 1, 12, 12) for i in range(9)],
        "acq_id string, tile_index bigint, pos_z bigint, pos_y bigint, pos_x bigint, size_z int, size_y int, size_x int",
    )
    pairs = [(i, i + 1) for i in range(9) if i % 3 < 2] + [(i, i + 3) for i in range(6)]
    links = [("a", i, j, 0.0, float((j // 3 - i // 3) * 10 + rng.normal()), float((j % 3 - i % 3) * 10 + rng.normal()), 1.0) for i, j in pairs]
    links = spark.createDataFrame(links, "acq_id string, i bigint, j bigint, dz double, dy double, dx double, w double")
    with pytest.raises(RuntimeError, match="converged"):
        solve_positions(tiles, links, tolerance=1e-12, max_iterations=0)
    assert solve_positions(tiles, links)[0].count() == 9
