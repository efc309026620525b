"""Faults that a review found, on rows of their own."""

import hashlib
import os
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, difference
from tilewright.operators.boxes import held_parts
from tilewright.sources import files as FI


def save(folder, name, **columns):
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return str(folder)


def test_inventory_has_no_folder_per_file(spark, tmp_path, monkeypatch):
    """folders follow sources and languages, not documents; names of any characters come back."""
    from tilewright.catalog import ingest

    n = 1000
    texts = [None if k == 7 else f"text {k}\nä" for k in range(n)]
    sources = ["a b/c%" if k % 2 else None for k in range(n)]
    folder = save(tmp_path, "documents", doc_id=list(range(n)), text=texts, source=sources, lang=["de"] * n)
    stores = []
    monkeypatch.setattr(ingest, "staging_path", lambda spark, name: stores.append(f"{tmp_path}/{name}") or stores[-1])
    got = {(r["source"], r["lang"], r["part"]): (r["n_bytes"], r["md5"]) for r in ingest.file_inventory(spark, folder).collect()}
    want = {}
    for k in range(n):
        want.setdefault(("a b/c%" if k % 2 else ingest.NO_NAME, "de", k // 100), []).append(texts[k] or "")
    want = {key: "".join(f"{t}\n" for t in lines).encode() for key, lines in want.items()}
    assert got == {key: (len(data), hashlib.md5(data).hexdigest()) for key, data in want.items()}
    assert sum(len(folders) for _, folders, _ in os.walk(stores[0])) == 4


def test_members_of_an_archive_share_a_task(spark, tmp_path):
    """an archive is opened once for a run of its members, not once for each."""
    for k in range(6):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as archive:
            for m in range(10 if k else 200):
                archive.writestr(f"d{k}/{m}.txt", f"{k} {m}")
    paths = spark.createDataFrame([(f"file://{tmp_path}/{k}.zip",) for k in range(6)], "path string")
    written = FI.expand_beside(FI.archive_members(paths)).withColumn("task", F.spark_partition_id())
    rows = written.groupBy("archive").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks")).collect()
    assert sorted((r["n"], r["tasks"]) for r in rows if r["n"] == 10) == [(10, 1)] * 5
    assert [r["tasks"] <= 4 for r in rows if r["n"] == 200] == [True]
    assert (tmp_path / "d0" / "199.txt").read_text() == "0 199"


def test_rows_leave_in_bounded_batches(monkeypatch):
    """small members share a batch, and a batch is bounded in bytes and rows."""
    monkeypatch.setattr(FI, "BATCH_BYTES", 100)
    monkeypatch.setattr(FI, "BATCH_ROWS", 8)
    rows = [(k, b"x" * (40 if k < 10 else 1)) for k in range(30)]
    batches = list(FI._in_batches(iter(rows), ["k", "data"]))
    assert [len(b) for b in batches] == [3, 3, 3, 8, 8, 5]
    assert [r for b in batches for r in zip(b["k"].to_pylist(), b["data"].to_pylist())] == rows


def patches(folder, ids):
    rng = np.random.default_rng(8)
    vectors = rng.uniform(-0.9, 0.9, (len(ids), 64)).astype("float32").tolist()
    embedding = pa.array(vectors, pa.list_(pa.float32()))
    return save(folder, "embeddings", vec_id=ids, embedding=embedding, label=[k % 10 for k in ids])


@pytest.fixture(scope="module")
def ragged(tmp_path_factory):
    """A scene whose last row of patches ends inside a tile; one patch is missing inside it too."""
    return patches(tmp_path_factory.mktemp("ragged"), [k for k in range(147) if k != 45])


@pytest.mark.parametrize(
    "name",
    [
        "fused_blocks", "fused_fill", "fused_maxweight", "fused_solved", "fused_scene", "gaussian_blur", "pair_peaks", "pair_shifts_ncc",
        "pair_shifts_phase", "pair_shifts_windows", "pyramid_levels", "pyramid_means", "reconstruct_flatfield", "solved_positions",
    ],
)
def test_scenes_that_lack_patches(spark, ragged, name):
    """F2 to F13, F15, F16: samples that are not there are left out, as in the SQL, and are no error."""
    got = contract.queries()[name](spark, ragged).toPandas()
    assert len(got) and difference(got, connect(ragged).execute(contract.oracle_sql()[name]).df()) is None


def test_reconstruction_of_a_ragged_scene(spark, tmp_path):
    """a last row of patches that ends inside a tile."""
    folder = patches(tmp_path, list(range(147)))
    got = contract.queries()["reconstruct_export"](spark, folder).toPandas()
    assert difference(got, connect(folder).execute(contract.oracle_sql()["reconstruct_export"]).df()) is None


def test_parts_cover_the_held_samples_once():
    rng = np.random.default_rng(9)
    for held in (rng.random((3, 5, 7)) < 0.6, np.zeros((1, 2, 2), bool), np.ones((2, 2, 2), bool)):
        seen = np.zeros(held.shape, int)
        for part in held_parts(held):
            seen[part] += 1
        assert (seen == held).all()
    assert len(list(held_parts(np.ones((2, 2, 2), bool)))) == 1


def test_field_of_uneven_depth_when_allowed(spark):
    """where tiles lack samples, order statistics are spread over the ranks of the deepest pixel."""
    from tilewright.operators import flatfield as FF

    shade, fields = np.array([[0.5, 1.5]]), "acq_id string, tile_index long, channel int, z0 long, y0 long, x0 long, nz int, ny int, nx int, data binary"
    rows = []
    for k in range(200):
        line = np.rint((1000 + 10 * (k // 2 * 2)) * shade).astype("<u2")[:, : 2 - k % 2]
        rows.append(("a", 0, 0, k, 0, 0, 1, *line.shape, line.tobytes()))
    counted = FF.cell_histograms(spark.createDataFrame(rows, fields), (8, 8))
    s = {r["x"]: r["s"] for r in FF.field_rows(FF.estimate(counted, (8, 8), uneven=True)).collect()}
    assert s[0] == pytest.approx(0.5, abs=0.01) and s[1] == pytest.approx(1.5, abs=0.01)


def test_rounds_keep_no_guess_of_the_size(spark):
    """the guessed size of a table that is joined with itself round by round doesn't gain digits."""
    from tilewright.session import cut_round

    state = spark.range(20).selectExpr("id", "1.0D as v", "2.0D as p")
    links, digits = spark.range(19).selectExpr("id as i", "id + 1 as j"), []
    for _ in range(4):
        at = lambda t: F.broadcast(state.select(F.col("id").alias(t), F.col("v").alias(f"{t}v")))  # noqa: E731, B023
        flow = links.join(at("i"), "i").join(at("j"), "j").groupBy(F.col("i").alias("id")).agg(F.sum(F.col("iv") - F.col("jv")).alias("q"))
        state = cut_round(state.join(F.broadcast(flow), "id", "left").selectExpr("id", "v + coalesce(q, 0) as v", "p").coalesce(1))
        digits.append(len(str(state._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
    assert len(set(digits)) == 1 and state.agg(F.sum("v")).first()[0] == 20


def test_tasks_list_the_files(spark, tmp_path, monkeypatch):
    """F4 of round 4: no file of an inventory is listed by the driver, and no folder holds all files of the archives."""
    from tilewright.catalog import ingest

    names = ["a.txt", "sub/b c%20\u00e9.txt", "sub/_h/x.txt", "sub/_k=1/y.txt", ".z.txt", "sub/deep/e.csv", "_metadata", "p=1/q._COPYING_", "void"]
    for name in names:
        (tmp_path / "tree" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / name).write_text("" if name == "void" else name)
    (tmp_path / "tree/none/inside").mkdir(parents=True)
    tree = f"{tmp_path}/tree"
    for glob in (None, "*.txt", "*.{csv,txt}", "?.txt"):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        known = (reader.option("pathGlobFilter", glob) if glob else reader).load(tree).select("path", "length", F.col("modificationTime").alias("modified"))
        found = FI.file_inventory(spark, tree, glob=glob)
        assert sorted(found.select(*known.columns).collect()) == sorted(known.collect())
        assert not found.inputFiles()
    assert FI.file_inventory(spark, f"{tree}/none").count() == 0
    n = 1500
    folder = save(tmp_path, "documents", doc_id=list(range(n)), text=[f"text {k}" for k in range(n)])
    stores = []
    monkeypatch.setattr(ingest, "staging_path", lambda spark, name: stores.append(f"{tmp_path}/{name}") or stores[-1])
    got = {r["name"]: (r["size"], r["md5"]) for r in ingest.ingest_archives(spark, folder).collect()}
    assert got == {f"{k}.txt": (len(f"text {k}"), hashlib.md5(f"text {k}".encode()).hexdigest()) for k in range(n)}
    assert max(len([f for f in files if not f.endswith(".crc")]) for _, _, files in os.walk(stores[0])) <= 1000
