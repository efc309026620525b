"""Samplesheet to acquisitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import manifest as M
from tilewright.session import cut_lineage
from tilewright.sources import files as FI
from tilewright.sources.samplesheet import read_samplesheet


def _local(path):
    """One spelling of file URIs: ``file:/x`` and ``file:///x`` are the same file."""
    return F.regexp_replace(path, r"^file:/+", "file:///")


def ingest(
    spark: SparkSession, samplesheet: str, image_dir: str, outdir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validate, fetch what is missing, verify what has a checksum, expand remote archives, group.

    Returns acquisitions, their files and the list of files fetched now.  Existing files
    are verified, never fetched again.  Members of remote ``.zip`` files lie beside them afterwards, written
    anew in every run.  ``image_dir`` may be a plain path or a URI, and need not
    exist yet.  Only files of rows with a checksum are read.
    """
    image_dir = FI.qualified(spark, image_dir)
    sheet = M.check_multi_image(M.validate(read_samplesheet(spark, samplesheet)))
    sheet = M.route_remote(sheet).withColumn("path", _local(F.concat_ws("/", F.lit(image_dir), "filename")))
    there = FI.existing_files(spark, image_dir).withColumn("path", _local("path"))
    plan = FI.plan_fetch(sheet.where("route = 'remote'"), there)
    # The copy must run once and before the digests are read: keep its result.
    fetched = cut_lineage(FI.fetch_missing(plan))
    now = FI.existing_files(spark, image_dir).withColumn("path", _local("path"))
    checked = sheet.where("route = 'remote'").where(~M.is_blank("checksum")).select("path").distinct()
    digests = cut_lineage(FI.file_digests(now.join(checked, "path", "left_semi")))
    # Archives expand from the checked rows: a file that does not hold its checksum fails before its members are written.
    remote = cut_lineage(FI.require_verified(FI.verify_checksums(sheet.where("route = 'remote'"), digests)))
    cut_lineage(FI.expand_beside(FI.archive_members(remote)))
    rows = remote.select(sheet.columns).unionByName(sheet.where("route = 'local'"))
    files = M.acquisition_files(rows, image_dir)
    return M.acquisitions(files, outdir), files, fetched
