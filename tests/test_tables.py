"""Samplesheets, files, metadata and reports."""

import hashlib
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tilewright.functions.running import running_sum
from tilewright.operators import manifest as M
from tilewright.operators import report as R
from tilewright.operators.rules import SETTING_RULES, list_conformance, rule_violations
from tilewright.options import int_vector, stage_options
from tilewright.plans.ingest import ingest
from tilewright.sources import blocks as SB
from tilewright.sources import files as FI
from tilewright.sources import metadata as MD
from tilewright.sources.samplesheet import read_samplesheet, sniff_separator, source_path, write_samplesheet
from tilewright.sources.versions import read_versions


def write(path, text):
    path.write_text(text)
    return str(path)


def ids(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("sep", [",", "\t", ";", "|"])
def test_sniffed_dialects(spark, tmp_path, sep):
    lines = [sep.join(["id", "filename", "note"]), sep.join(["a b", "x.czi", f'"1{sep}2"']), "", sep.join(["a b", "y.mvl", ""])]
    sheet = read_samplesheet(spark, write(tmp_path / "s.csv", "\n".join(lines) + "\n"))
    assert ids(sheet, "line_no", "id", "filename", "note") == [(2, "a b", "x.czi", f"1{sep}2"), (3, "a b", "y.mvl", "")]
    assert sheet.first()["uri"] is None


def test_sniff_fails_without_separator():
    with pytest.raises(ValueError):
        sniff_separator(["id", "a"])


def test_required_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="must"):
        read_samplesheet(spark, write(tmp_path / "s.csv", "id,name\na,b\n"))


def test_first_bad_line_wins(spark, tmp_path):
    sheet = read_samplesheet(spark, write(tmp_path / "s.csv", "id,filename\n a,x.czi\nb,\n,y.czi\nc\n"))
    with pytest.raises(ValueError, match=r"File name is required. On line 3\."):
        M.validate(sheet)
    # The short row has no file name; missing counts as empty.
    assert ids(M.violations(sheet), "line_no") == [(3,), (4,), (5,)]
    assert ids(M.validate(sheet, strict=False), "id") == [("_a",)]


def test_blank_id_is_valid_and_becomes_underscore(spark):
    sheet = spark.createDataFrame([(2, " ", "f", "", "", "")], "line_no long, id string, filename string, pattern string, checksum string, uri string")
    assert M.validate(sheet).first()["id"] == "_"


def test_multi_image_rule(spark):
    rows = [(2, "a", "1.czi", ""), (3, "a", "2.czi", ""), (4, "b", "1.czi", ""), (5, "c", "1.CZI", ""), (6, "c", "2.czi", ""), (7, "d", "1.czi", " "), (8, "d", "2.czi", "")]
    sheet = spark.createDataFrame(rows, "line_no long, id string, filename string, pattern string")
    assert ids(M.multi_image_faults(sheet), "id") == [("a",)]
    with pytest.raises(ValueError, match="Acquisition 'a'"):
        M.check_multi_image(sheet)


def test_roundtrip_keeps_order_and_extra_columns(spark, tmp_path):
    text = "filename,id,extra\n" + "".join(f"f{i}.czi,a,\"x,{i}\"\n" for i in range(50))
    sheet = read_samplesheet(spark, write(tmp_path / "s.csv", text))
    out = str(tmp_path / "out")
    write_samplesheet(M.validate(sheet), out, ["filename", "id", "extra"], single_file=True)
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert part.read_text() == text


def test_header_routing(spark, tmp_path):
    with_uri = read_samplesheet(spark, write(tmp_path / "a.csv", "id,filename,uri\na,x,\na,y,file:///y\n"))
    without = read_samplesheet(spark, write(tmp_path / "b.csv", "id,filename\na,x\n"))
    assert ids(M.route_remote(with_uri), "filename", "route") == [("x", "local"), ("y", "remote")]
    assert ids(M.route_remote(with_uri, by_header=True), "route") == [("remote",), ("remote",)]
    assert ids(M.route_remote(without, by_header=True), "route") == [("local",)]


def test_patterns(spark):
    rows = [("a", 2, "/d/1.czi", "1.czi", "czi", " "), ("a", 3, "/d/2.czi", "2.czi", "czi", "P"), ("a", 4, "/d/m.mvl", "m.mvl", "mvl", "Q"), ("b", 5, "/d/9.czi", "9.czi", "czi", "")]
    files = spark.createDataFrame(rows, "acq_id string, line_no long, path string, filename string, ext string, pattern string")
    got = {r["acq_id"]: r for r in M.acquisitions(files, "/o").collect()}
    assert (got["a"]["pattern"], got["a"]["last_pattern"] if "last_pattern" in got["a"] else "Q", got["a"]["patterns_differ"]) == ("P", "Q", True)
    assert got["b"]["pattern"] == "9.czi" and got["b"]["stitching_dir"] == "/o/stitching/b"
    with pytest.raises(Exception, match="no metadata file for b"):
        M.require_metadata(M.acquisitions(files, "/o")).collect()


def test_channel_option():
    assert [M.channel_number(v) for v in (None, "", "all", "c1", "ch12x3", "0")] == [None, None, None, 1, 12, 0]
    with pytest.raises(ValueError):
        M.channel_number("red")


def test_ingest_fetches_verifies_and_groups(spark, tmp_path):
    store, images = tmp_path / "store", tmp_path / "in"
    store.mkdir()
    images.mkdir()
    lines = ["id,filename,pattern,checksum,uri"]
    for name in ("a_V00.czi", "a_V01.czi", "a.mvl"):
        body = f"body of {name}".encode()
        (store / name).write_bytes(body)
        lines.append(f"my acq,{name},{'a_V%02d.czi' if name.endswith('00.czi') else ''},{hashlib.md5(body).hexdigest()},file://{store / name}")
    (images / "a.mvl").write_bytes(b"body of a.mvl")
    path = write(tmp_path / "s.csv", "\n".join(lines) + "\n")
    acqs, files, fetched = ingest(spark, path, f"file://{images}", "/out")
    assert ids(fetched, "path") == [(f"file://{images}/a_V00.czi",), (f"file://{images}/a_V01.czi",)]
    row = acqs.first()
    assert (row["acq_id"], row["pattern"], row["n_files"]) == ("my_acq", "a_V%02d.czi", 3)
    assert files.count() == 3
    (images / "a.mvl").write_bytes(b"changed")
    with pytest.raises(Exception, match="Checksum failed"):
        ingest(spark, path, f"file://{images}", "/out")[0].collect()


def test_ingest_expands_remote_archives(spark, tmp_path):
    store, images = tmp_path / "store", tmp_path / "in"
    store.mkdir()
    with zipfile.ZipFile(store / "a.zip", "w") as z:
        z.writestr("a_V00.czi", "first")
        z.writestr("sub/", "")
        z.writestr("sub/a.mvl", "")
    digest = hashlib.md5((store / "a.zip").read_bytes()).hexdigest()
    sheet = write(tmp_path / "s.csv", f"id,filename,pattern,checksum,uri\nacq,a.zip,,{digest},file://{store / 'a.zip'}\n")
    ingest(spark, sheet, str(images), "/out")
    assert (images / "a_V00.czi").read_text() == "first" and (images / "sub" / "a.mvl").read_text() == ""
    (images / "a_V00.czi").write_text("old")
    assert ingest(spark, sheet, str(images), "/out")[2].count() == 0
    assert (images / "a_V00.czi").read_text() == "first"
    (images / "a.zip").write_bytes(b"changed")
    with pytest.raises(Exception, match="Checksum failed"):
        ingest(spark, sheet, str(images), "/out")


def test_members_stream_in_parts(spark, tmp_path):
    body = os.urandom(3 << 20)
    for name, inside in (("a.ZIP", "big.bin"), ("b.zip", "big.bin"), ("c.zip", "only.bin")):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(inside, body + name.encode())
    paths = [(f"file://{tmp_path / n}",) for n in ("a.ZIP", "b.zip", "c.zip", "c.zip", "plain.txt")] + [(None,)]
    members = FI.archive_members(spark.createDataFrame(paths, "path string"))
    assert ids(members, "member", "size") == [("big.bin", len(body) + 5)] * 2 + [("only.bin", len(body) + 5)]
    written = FI.expand_beside(members, chunk=1000).collect()
    assert {r["member"]: r["md5"] for r in written} == {
        "big.bin": hashlib.md5(body + b"b.zip").hexdigest(), "only.bin": hashlib.md5(body + b"c.zip").hexdigest()
    }
    assert (tmp_path / "big.bin").read_bytes() == body + b"b.zip"
    assert not list(tmp_path.glob("*.part"))
    empty = FI.archive_members(spark.createDataFrame([], "path string"))
    assert FI.expand_beside(empty).count() == 0


@pytest.mark.parametrize("name", ["../out.txt", "/out.txt", "d/../../out.txt"])
def test_members_stay_in_their_folder(spark, tmp_path, name):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "x.zip", "w") as z:
        z.writestr(name, "1")
    members = FI.archive_members(spark.createDataFrame([(f"file://{tmp_path}/in/x.zip",)], "path string"))
    with pytest.raises(Exception, match="outside its folder"):
        FI.expand_beside(members).collect()
    assert not (tmp_path / "out.txt").exists()


def test_inventory_and_unzip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("d/one.txt", "1")
        z.writestr("two.txt", "22")
    (tmp_path / "plain.txt").write_text("no")
    assert ids(FI.file_inventory(spark, str(tmp_path)), "name", "length")[0] == ("plain.txt", 2)
    content = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    assert ids(FI.unzip_members(content), "member", "size") == [("d/one.txt", 1), ("two.txt", 2)]


def test_optional_source(spark, tmp_path):
    assert source_path(spark, None, "value string").count() == 0
    with pytest.raises(Exception):
        source_path(spark, str(tmp_path / "missing"), "value string")


def test_stage_xml_to_tiles(spark, tmp_path):
    xml = "<R>" + "".join(f'<Data Acquisition="a" Index="{i}" PositionX="{i * -2.3}" PositionY="{i * 4.6}" PositionZ="0.42"/>' for i in range(3)) + "</R>"
    stage = MD.read_stage_metadata(spark, write(tmp_path / "m.mvl", xml))
    tiles = MD.parse_tiles(stage, "0.23,0.23,0.42", "-x,y,z")
    got = [(r["tile_index"], round(r["pos_x"], 6), round(r["pos_y"], 6), r["pos_z"]) for r in tiles.orderBy("tile_index").collect()]
    assert got == [(0, 0.0, 0.0, 0.0), (1, 10.0, 20.0, 0.0), (2, 20.0, 40.0, 0.0)]
    acqs = spark.createDataFrame([("a", "F_V%02d.czi")], "acq_id string, pattern string")
    assert ids(MD.attach_files(tiles, acqs), "file") == [("F_V00.czi",), ("F_V01.czi",), ("F_V02.czi",)]


def test_metadata_files(spark, tmp_path):
    tiles = spark.createDataFrame([("a", 1, 0.0, 1.0, 2.0, 1, 8, 8, "f")], MD.TILE_SCHEMA)
    MD.write_tile_metadata(tiles, str(tmp_path / "tiles.json"))
    assert MD.read_tile_metadata(spark, str(tmp_path / "tiles.json")).collect() == tiles.collect()
    channels = spark.createDataFrame([("a", c, 1, 1, 1, 8, 8, 128) for c in (0, 1)], MD.CHANNEL_SCHEMA)
    MD.write_channel_metadata(channels, str(tmp_path))
    MD.write_positions(tiles.select("acq_id", "tile_index", "pos_z", "pos_y", "pos_x"), channels, str(tmp_path))
    assert (tmp_path / "a" / "c1-n5-final.json").exists()
    # Final results are not read as channel metadata.
    assert MD.read_channel_metadata(spark, str(tmp_path)).count() == 2
    assert ids(MD.read_positions(spark, str(tmp_path)), "channel", "pos_x") == [(0, 2.0), (1, 2.0)]
    # A channel that is written again is replaced, those of other acquisitions and channels stay; names stay as safe as their folders'.
    again = spark.createDataFrame([("a", 7, 0.0, 1.0, 9.0), ("b/c", 7, 0.0, 1.0, 5.0)], "acq_id string, tile_index long, pos_z double, pos_y double, pos_x double")
    MD.write_positions(again, spark.createDataFrame([("a", 1), ("b/c", 4)], "acq_id string, channel int"), str(tmp_path))
    assert ids(MD.read_positions(spark, str(tmp_path)), "acq_id", "channel", "pos_x") == [("a", 0, 2.0), ("a", 1, 9.0), ("b/c", 4, 5.0)]
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_staged")]
    log = spark.createDataFrame([("a", 0, 3, 0.5, 1.0)], "acq_id string, iteration int, n_links long, mean_err double, max_err double")
    MD.write_solve_log(log, str(tmp_path / "optimizer-final.txt"))
    assert spark.read.text(str(tmp_path / "optimizer-final.txt")).first()[0] == "a iteration=0 links=3 mean=0.500000 max=1.000000"


def test_raw_planes_and_attributes(spark, tmp_path):
    import numpy as np

    np.arange(12, dtype="<u2").tofile(tmp_path / "acq_1_t5_c2_z7.raw")
    row = SB.planes_from_files(spark, str(tmp_path), (3, 4)).first()
    assert (row["acq_id"], row["tile_index"], row["channel"], row["z0"], row["nx"]) == ("acq_1", 5, 2, 7, 4)
    with pytest.raises(Exception, match="unexpected size"):
        SB.planes_from_files(spark, str(tmp_path), (3, 5)).collect()


def test_field_is_replaced_per_channel(spark, tmp_path):
    rows = lambda c, s: spark.createDataFrame([("a", c, 0, s)], "acq_id string, channel int, cy long, s double")
    path = str(tmp_path / "field")
    SB.write_field(rows(0, 1.0).unionByName(rows(1, 1.0)), path)
    SB.write_field(rows(1, 2.0), path)
    assert ids(spark.read.parquet(path), "channel", "s") == [(0, 1.0), (1, 2.0)]


def test_versions_text(spark, tmp_path):
    write(tmp_path / "a.yml", '"MAIN:SUB:CHECK":\n    python: 3.9.5\n    tool: \'1.0\'\n')
    write(tmp_path / "b.yml", '"MAIN:CHECK":\n    python: 3.9.6\n')
    rows = read_versions(spark, str(tmp_path))
    assert ids(rows, "process", "tool", "version") == [("MAIN:CHECK", "python", "3.9.6"), ("MAIN:SUB:CHECK", "python", "3.9.5"), ("MAIN:SUB:CHECK", "tool", "1.0")]
    assert R.version_faults(rows).count() == 0
    with pytest.raises(ValueError):
        R.module_versions(rows, strict=True)


def test_setting_rules(spark):
    columns = "id int, resolution string, stitching_block_size string, final_block_size_xy string, stitching_mode string, stitching_blur_sigma string, flatfield_correction string"
    good, bad = (1, "0.2,0.2,0.4", "128,128,64", "512", "full", "2", "true"), (2, "0.2,0.2", "1,2", "x", "some", "y", "maybe")
    broken = rule_violations(spark.createDataFrame([good, bad], columns), SETTING_RULES, "id")
    assert {r["id"] for r in broken.collect()} == {2} and broken.count() == 6


def test_list_conformance(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b", "a", "c"]), (3, ["b", "c"]), (4, ["a", "c"])], "k int, seen array<string>")
    got = {r["k"]: (r["missing"], r["order_violation"]) for r in list_conformance(rows, "seen", ["a", "b", "c"]).collect()}
    # Missing first is no order violation; missing in the middle is.
    assert got == {1: ([], False), 2: ([], True), 3: (["a"], False), 4: (["b"], True)}


def test_params_dump(spark, tmp_path):
    flat = spark.createDataFrame([(1, "b", "2"), (1, "a", "1")], "run int, name string, value string")
    path = R.dump_params(flat, ["run"], "2024-01-01_00-00-00", str(tmp_path))
    assert path.endswith("params_2024-01-01_00-00-00.json") and spark.read.json(path, multiLine=True).first()["b"] == "2"


def test_running_sum_over_chunks(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), F.col("id").alias("v"))
    got = running_sum(df, ["k"], "o", {"s": "v"}, chunk=7).collect()
    assert all(r["s"] == sum(v for v in range(r["o"] + 1) if v % 2 == r["k"]) for r in got) and len(got) == 100


def test_options():
    assert stage_options(stitching_mode="full")["stitching_mode"] == "full" and int_vector("128,128,64") == (128, 128, 64)
    with pytest.raises(ValueError):
        stage_options(colour="red")
