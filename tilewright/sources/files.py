"""File inventory, fetch plan, checksums and archives."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.session import cut_lineage


def file_inventory(spark: SparkSession, folder: str, hash_content: bool = False, glob: str | None = None) -> DataFrame:
    """``path, name, length, modified`` of existing files, and ``md5`` when asked for.

    Without hashing, tasks list the folders level by level, and the driver holds no file: its memory doesn't grow with them.
    A task holds the names of one folder.  What is no folder, as a pattern, goes through Spark's reader.
    """
    if not hash_content and _is_folder(spark, folder):
        return _listed(spark, folder, glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    extra = [F.md5("content").alias("md5")] if hash_content else []
    return files.select("path", name.alias("name"), "length", F.col("modificationTime").alias("modified"), *extra)


def _is_folder(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(path) and system.getFileStatus(path).isDirectory()


def _is_hidden(name: str, inside: bool) -> bool:
    """Names of files and folders that Spark's readers leave out."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not (inside and name.startswith(("_common_metadata", "_metadata")))


def _listed(spark: SparkSession, folder: str, glob: str | None) -> DataFrame:
    """``path, name, length, modified`` of the files below a folder, as Spark's reader of binary files gives them."""
    top = qualified(spark, folder).rstrip("/")
    # names below are no URIs: they may hold any character
    root = spark._jvm.org.apache.hadoop.fs.Path(top).toUri().toString()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(root)
        for batch in batches:
            for below in batch["below"].to_pylist():
                for info in system.get_file_info(fs.FileSelector(at.rstrip("/") + below)):
                    inside = info.type == fs.FileType.Directory
                    # files without a byte are left out there too
                    if not _is_hidden(info.base_name, inside) and (inside or info.size):
                        yield f"{below}/{info.base_name}", info.base_name, info.size or 0, info.mtime_ns // 1_000_000, inside

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(entries(batches), ["below", "name", "length", "millis", "inside"])

    # AQE would merge partitions by bytes, but a row is a folder to list: keep the set number
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders, levels = spark.createDataFrame([("",)], "below string"), []
    while not folders.isEmpty():
        found = folders.repartition(n, "below").mapInArrow(listing, "below string, name string, length bigint, millis bigint, inside boolean")
        levels.append(cut_lineage(found))
        folders = levels[-1].where("inside").select("below")
    files = reduce(DataFrame.unionByName, levels).where(~F.col("inside"))
    if glob:
        files = files.where(F.col("name").rlike(f"^(?:{spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()})$"))
    return files.select(F.concat(F.lit(top), "below").alias("path"), "name", "length", F.timestamp_millis("millis").alias("modified"))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as its file system spells it, as ``file_inventory`` lists it: ``file:///a/b``."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(hadoop)
    return system.makeQualified(path).toString()


def existing_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_inventory`` of a folder that may not be there yet: then there are no files."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(hadoop).exists(path):
        return spark.createDataFrame([], "path string, name string, length bigint, modified timestamp")
    return file_inventory(spark, folder)


def file_digests(paths: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """``path, md5`` of the files named by ``path``; files of any size, read in chunks by tasks."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch["path"]:
                system, at = fs.FileSystem.from_uri(path)
                seen = hashlib.md5()
                with system.open_input_stream(at) as stream:
                    while part := stream.read(chunk):
                        seen.update(part)
                out.append(seen.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "md5": out})

    return paths.select("path").distinct().mapInPandas(digest, "path string, md5 string")


def write_lines(rows: DataFrame) -> DataFrame:
    """Write ``value`` as lines to the file named by ``path``: ``path, n_lines`` of every file written.

    Rows of one file lie together in one partition, in the order of its lines; a null is an empty line.
    Tasks stream them and put a file in place whole, so there is neither a directory nor a commit per file.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        import uuid

        from pyarrow import fs

        made: set[str] = set()
        rows = (row for batch in batches for row in zip(batch["path"].to_pylist(), batch["value"].to_pylist()))
        for path, lines in itertools.groupby(rows, itemgetter(0)):
            system, at = fs.FileSystem.from_uri(path)
            folder = at.rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            part, n = f"{at}.{uuid.uuid4().hex}.part", 0
            with system.open_output_stream(part, buffer_size=1 << 16) as out:
                for n, (_, value) in enumerate(lines, start=1):
                    out.write((value or "").encode() + b"\n")
            system.move(part, at)
            yield path, n

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(written(batches), ["path", "n_lines"])

    return rows.select("path", "value").mapInArrow(write, "path string, n_lines bigint")


def plan_fetch(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Manifest rows whose file is not there yet."""
    return manifest.join(inventory.select("path"), "path", "left_anti")


def fetch_missing(plan: DataFrame) -> DataFrame:
    """Copy ``uri`` to ``path`` in tasks, for URIs that Arrow file systems open.

    A row per copied file comes back; the target is replaced whole, so a retried task is
    harmless.  Copies stream in chunks; no file is held in memory.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        for batch in batches:
            sizes = []
            for uri, path in zip(batch["uri"], batch["path"]):
                source, at = fs.FileSystem.from_uri(uri)
                target, to = fs.FileSystem.from_uri(path)
                target.create_dir(to.rsplit("/", 1)[0], recursive=True)
                part = f"{to}.{uuid.uuid4().hex}.part"
                n = 0
                with source.open_input_stream(at) as i, target.open_output_stream(part) as o:
                    while chunk := i.read(1 << 20):
                        n += o.write(chunk)
                target.move(part, to)
                sizes.append(n)
            yield pd.DataFrame({"path": batch["path"], "uri": batch["uri"], "n_bytes": sizes})

    return plan.select("path", "uri").mapInPandas(copy, "path string, uri string, n_bytes bigint")


def verify_checksums(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """``status``: verified, failed (also when the file is missing) or unchecked without a checksum."""
    met = manifest.join(inventory.select("path", "md5"), "path", "left")
    wanted = F.trim(F.coalesce("checksum", F.lit("")))
    status = (
        F.when(wanted == "", "unchecked")
        .when(F.col("md5").isNotNull() & (F.lower(wanted) == F.col("md5")), "verified")
        .otherwise("failed")
    )
    return met.withColumn("status", status)


def require_verified(checked: DataFrame) -> DataFrame:
    """Fail the job at the first row whose checksum does not hold."""
    ok = F.col("status") != "failed"
    return checked.where(F.when(ok, True).otherwise(F.raise_error(F.concat(F.lit("Checksum failed for "), "path")).cast("boolean")))


def archive_members(archives: DataFrame) -> DataFrame:
    """``archive, member, size`` of every file in the ``.zip`` files named by ``path``.

    Tasks seek to each archive's directory at its end; no member is read.  Null and other paths
    have no members; a member named twice is listed once, with its last size, as the later one overwrites.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with _opened(path) as archive:
                    names = {i.filename: i.file_size for i in archive.infolist() if not i.is_dir()}
                for name, size in names.items():
                    yield path, name, size

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(listed(batches), ["archive", "member", "size"])

    paths = archives.where(F.lower("path").endswith(".zip")).select("path").distinct()
    return paths.mapInArrow(listing, MEMBER)


def expand_beside(members: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Write the listed members beside their archives: ``archive, member, size, path, md5`` of every file written.

    Members are spread over tasks in runs of about ``RUN`` of one archive, which is opened once for a run, and stream in
    chunks, so memory depends neither on an archive's size nor on a member's.  A file is put in place whole, so a
    retried task is harmless.  A name that would leave the archive's folder fails the job.  When archives of one
    folder hold the same name, the archive last in order of path is the one that is written.
    """

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        made: set[str] = set()
        rows = (row for batch in batches for row in zip(*[batch[c].to_pylist() for c in ("archive", "member", "path")]))
        for path, run in itertools.groupby(rows, itemgetter(0)):
            with _opened(path) as archive:
                for _, member, target in run:
                    info = archive.getinfo(member)
                    yield path, member, info.file_size, target, _copy_member(archive, info, target, chunk, made)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(expanded(batches), ["archive", "member", "size", "path", "md5"])

    outside = F.col("member").rlike(r"(^|[/\\])\.\.([/\\]|$)|^[/\\]")
    safe = F.when(outside, F.raise_error(F.concat(F.lit("Member outside its folder: "), "archive", F.lit(" "), "member")))
    target = F.concat(F.regexp_extract("archive", r"^(.*/)", 1), F.coalesce(safe.cast("string"), F.col("member")))
    last = members.select("archive", "member", target.alias("path")).groupBy("path").agg(
        F.max(F.struct("archive", "member")).alias("last")
    )
    last = cut_lineage(last.select("last.archive", "last.member", "path"))
    runs = last.groupBy("archive").agg(F.ceil(F.count(F.lit(1)) / RUN).alias("runs"))
    spread = last.join(runs, "archive").withColumn("run", F.pmod(F.xxhash64("member"), F.col("runs")))
    spread = spread.repartition("archive", "run").sortWithinPartitions("archive", "member")
    return spread.select("archive", "member", "path").mapInArrow(expand, f"{MEMBER}, path string, md5 string")


#: Members of one archive that a task writes with the archive opened once.
RUN = 64
# Output rows are handed back in Arrow batches of about this many bytes, or so many rows.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 5000


def _in_batches(rows: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded bytes; a large row is a batch of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)


MEMBER = "archive string, member string, size bigint"


@contextmanager
def _opened(path: str) -> Iterator[zipfile.ZipFile]:
    """A zip archive on any file system that Arrow opens, read where it is sought."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    with system.open_input_file(at) as source, zipfile.ZipFile(source) as archive:
        yield archive


def _copy_member(archive: zipfile.ZipFile, info: zipfile.ZipInfo, path: str, chunk: int, made: set[str]) -> str:
    """Stream one member to its place; the digest of what was written.  ``made``: folders that this task has made."""
    import hashlib
    import uuid

    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    folder = at.rsplit("/", 1)[0]
    if folder not in made:
        system.create_dir(folder, recursive=True)
        made.add(folder)
    part, seen = f"{at}.{uuid.uuid4().hex}.part", hashlib.md5()
    with archive.open(info) as source, system.open_output_stream(part) as out:
        while data := source.read(chunk):
            seen.update(data)
            out.write(data)
    system.move(part, at)
    return seen.hexdigest()


def unzip_members(files: DataFrame, with_content: bool = True) -> DataFrame:
    """``archive, member, size, content`` of every ``.zip`` among ``path, content`` rows.

    Members come out one by one, in batches of bounded bytes: an archive's members are never all in memory.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            yield path, info.filename, info.file_size, archive.read(info) if with_content else None

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _in_batches(members(batches), ["archive", "member", "size", "content"]):
            # without contents, the column of nulls needs its type
            yield out if with_content else out.set_column(3, "content", pa.nulls(len(out), pa.binary()))

    archives = files.where(F.col("path").endswith(".zip")).select("path", "content")
    return archives.mapInArrow(expand, "archive string, member string, size bigint, content binary")
