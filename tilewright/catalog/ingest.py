"""Samplesheet, file and rule queries."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Callable
from operator import itemgetter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.catalog import views as V
from tilewright.functions import text as X
from tilewright.operators import manifest as M
from tilewright.operators.report import nested_lookup
from tilewright.operators.rules import Rule, missing_paths, order_conformance, rule_violations
from tilewright.session import cut_lineage, staging_path
from tilewright.sources import files as FI
from tilewright.sources.samplesheet import read_samplesheet, read_validated, write_samplesheet

COLUMNS = ["id", "filename", "pattern", "checksum", "uri"]


def samplesheet_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.violations(V.sheet(spark, sf_dir))


VIOLATIONS = f"""with {V.SHEET}
select line_no, case when id = '' then 'Acquisition name is required.' else 'File name is required.' end as message
from sheet where id = '' or filename = ''"""


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.validate(V.sheet(spark, sf_dir), strict=False)


def samplesheet_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir).select("line_no", "id", "filename", (~M.is_blank("pattern")).alias("has_pattern"))


VALID = f"with {V.VALID} select line_no, id, filename, trim(pattern) <> '' as has_pattern from valid"


def samplesheet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated sheet written, sniffed and read, validated, written as CSV, read again."""
    raw, clean = staging_path(spark, "sheet-tsv"), staging_path(spark, "sheet-csv")
    write_samplesheet(V.sheet(spark, sf_dir).select("line_no", *COLUMNS), raw, sep="\t")
    sheet = M.validate(read_samplesheet(spark, raw), strict=False)
    header = ["line_no_given", *COLUMNS]
    write_samplesheet(sheet.withColumn("line_no_given", F.col("line_no").cast("string")), clean, header)
    back = read_validated(spark, clean, header)
    return back.select(F.col("line_no_given").cast("long").alias("line_no"), *COLUMNS)


ROUNDTRIP = f"with {V.VALID} select line_no, id, filename, pattern, checksum, uri from valid"


def _fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smaller acquisitions, so that some have no pattern."""
    return _valid(spark, sf_dir).withColumn("id", F.concat("id", F.lit("_"), F.col("doc_id") % 31))


_FINE = V.VALID + """,
fine as (select * exclude (id), concat(id, '_', doc_id % 31) as id from valid)"""


def multi_image_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.multi_image_faults(_fine(spark, sf_dir))


MULTI_IMAGE = f"""with {_FINE}
select id, count(*) filter (where filename like '%.czi') as n_images,
  concat('Acquisition ''', id, ''' has more than one CZI file, so it needs to have at least one value in the ''pattern'' column.') as message
from fine group by id having n_images > 1 and count(*) filter (where pattern <> '') = 0"""


def duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.duplicate_files(_valid(spark, sf_dir))


DUPLICATES = f"with {V.VALID} select id, filename, count(*) as n from valid group by all having n > 1"


def route_remote_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed, then united again: every row once, with its label."""
    routed = M.route_remote(_valid(spark, sf_dir)).select("line_no", "route", "uri")
    remote, local = routed.where("route = 'remote'"), routed.where("route = 'local'").drop("uri")
    return remote.unionByName(local, allowMissingColumns=True)


ROUTE = f"""with {V.VALID} select line_no, case when trim(uri) <> '' then 'remote' else 'local' end as route,
  case when trim(uri) <> '' then uri end as uri from valid"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.acquisition_files(_fine(spark, sf_dir), "/data/input")


def acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.acquisitions(_files(spark, sf_dir), "/data/out", "run1")


_FILES = _FINE + """,
files as (select *, concat('/data/input/', filename) as path, regexp_extract(filename, '\\.([^./]+)$', 1) as ext from fine)"""
_ACQS = _FILES + """,
acqs as (
  select id as acq_id, count(*) as n_files, count(*) filter (where ext = 'czi') as n_images,
    arg_min(pattern, line_no) filter (where trim(pattern) <> '') as first_pattern,
    arg_max(pattern, line_no) filter (where pattern <> '') as last_pattern,
    arg_min(path, line_no) filter (where ext = 'mvl') as metadata_file,
    arg_min(filename, line_no) filter (where ext = 'czi') as first_image
  from files group by id)"""
ACQUISITIONS = f"""with {_ACQS}
select acq_id, n_files, n_images, coalesce(first_pattern, case when n_images = 1 then first_image end) as pattern,
  first_pattern is distinct from last_pattern as patterns_differ, metadata_file, first_image,
  concat('/data/out/stitching/', acq_id) as stitching_dir, concat('/data/out/spark/run1/', acq_id) as session_dir from acqs"""


def acquisition_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = M.packed_files(_files(spark, sf_dir), lead=["/data/input", "/data/out"])
    return packed.select("acq_id", F.array_join("files", " ").alias("files"), F.size("patterns").alias("n"))


LISTS = f"""with {_FILES}
select id as acq_id, concat('/data/input /data/out ', string_agg(path, ' ' order by line_no)) as files,
  count(*) as n from files group by all"""


def acquisition_first_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisitions that can be parsed: metadata file and pattern present (others would fail the job)."""
    ready = acquisitions(spark, sf_dir).where("metadata_file is not null and pattern is not null")
    return M.require_metadata(ready).select("acq_id", "metadata_file", "pattern")


FIRST_EXT = f"""with {_ACQS}, a as (select *, coalesce(first_pattern, case when n_images = 1 then first_image end) as pattern from acqs)
select acq_id, metadata_file, pattern from a where metadata_file is not null and pattern is not null"""


def _expected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    acqs = acquisitions(spark, sf_dir).where(~M.is_blank("pattern"))
    present = _files(spark, sf_dir).select("acq_id", "filename")
    return M.expected_files(acqs, 40), present


def expected_files_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, present = _expected(spark, sf_dir)
    return expected.join(present, ["acq_id", "filename"], "left_semi")


def missing_files_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, present = _expected(spark, sf_dir)
    return expected.join(present, ["acq_id", "filename"], "left_anti")


_EXPECTED = _ACQS + """,
a as (select acq_id, coalesce(first_pattern, case when n_images = 1 then first_image end) as pattern from acqs),
expected as (
  select acq_id, n, case when pattern like '%\\%%' escape '\\' then printf(pattern, n) else pattern end as filename
  from a cross join (select unnest(range(0, 40)) as n) where trim(pattern) <> '')"""
EXPECTED_SEMI = f"with {_EXPECTED} select * from expected e where exists (select 1 from files f where f.id = e.acq_id and f.filename = e.filename)"
MISSING_ANTI = f"with {_EXPECTED} select * from expected e where not exists (select 1 from files f where f.id = e.acq_id and f.filename = e.filename)"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.sheet(spark, sf_dir).select("doc_id", F.concat(F.lit("store/"), "doc_id").alias("path"), "checksum", "uri")


def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = FI.plan_fetch(_manifest(spark, sf_dir), V.file_store(spark, sf_dir))
    return plan.where(~M.is_blank("uri")).select("doc_id", "path", "uri")


FETCH_PLAN = f"with {V.SHEET} select doc_id, concat('store/', doc_id) as path, uri from sheet where doc_id % 7 = 0 and uri <> ''"


def missing_path_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_paths(_manifest(spark, sf_dir), "path", V.file_store(spark, sf_dir)).select("doc_id", "path")


MISSING_PATHS = f"with {V.SHEET} select doc_id, concat('store/', doc_id) as path from sheet where doc_id % 7 = 0"


def checksum_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = V.file_store(spark, sf_dir).select("path", F.md5("content").alias("md5"))
    return FI.verify_checksums(_manifest(spark, sf_dir), inventory).select("doc_id", "path", "status")


CHECKSUM = f"""with {V.SHEET}
select s.doc_id, concat('store/', s.doc_id) as path,
  case when checksum = '' then 'unchecked' when s.doc_id % 7 <> 0 and checksum = md5(d.text) then 'verified' else 'failed' end as status
from sheet s join documents d using (doc_id)"""


def _zipped(rows: DataFrame, folder: Column, prefix: str, place: Callable) -> DataFrame:
    """Archives of ten documents each: ``place(path, entries)`` gives an archive's row; rows of an archive lie together and stream.

    A file per archive in ``folder``, a member ``<prefix><doc_id>.txt`` per document.
    """
    path = F.concat(folder, F.floor(F.col("doc_id") / 10), F.lit(".zip"))
    docs = rows.select(path.alias("path"), F.concat(F.lit(prefix), "doc_id", F.lit(".txt")).alias("member"), "doc_id", "text")
    names = ["path", "content"]

    def pack(batches):
        rows = (row for batch in batches for row in zip(*[batch[c].to_pylist() for c in ("path", "member", "text")]))
        yield from FI._in_batches((place(path, entries) for path, entries in itertools.groupby(rows, itemgetter(0))), names)

    together = docs.repartition("path").sortWithinPartitions("path", "doc_id").select("path", "member", "text")
    return together.mapInArrow(pack, "path string, content binary")


def _write_members(out, entries) -> None:
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for _, member, body in entries:
            archive.writestr(member, body)


def unzip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of ten documents each, expanded again."""

    def in_memory(path, entries):
        buffer = io.BytesIO()
        _write_members(buffer, entries)
        return path, buffer.getvalue()

    archives = _zipped(V.table(spark, sf_dir, "documents"), F.lit("store/"), "", in_memory)
    return FI.unzip_members(archives).select("archive", "member", "size", F.md5("content").alias("md5"))


UNZIP = """select concat('store/', doc_id // 10, '.zip') as archive, concat(doc_id, '.txt') as member,
  octet_length(encode(text)) as size, md5(text) as md5 from documents"""


def ingest_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of ten documents each, a hundred of them in a folder, listed, expanded beside themselves and digested from the files.

    No folder grows with the documents, and tasks list them.
    """
    folder = FI.qualified(spark, staging_path(spark, "archives"))

    def in_file(path, entries):
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(at) as out:
            _write_members(out, entries)
        return path, b""

    hundred = F.concat(F.lit(f"{folder}/"), F.floor(F.col("doc_id") / 1000), F.lit("/"))
    written = cut_lineage(_zipped(V.table(spark, sf_dir, "documents"), hundred, "d/", in_file).select("path"))
    cut_lineage(FI.expand_beside(FI.archive_members(written)))
    files = FI.file_inventory(spark, folder, glob="*.txt")
    found = files.join(FI.file_digests(files), "path")
    return found.select("name", F.col("length").alias("size"), "md5")


INGEST_ARCHIVES = "select concat(doc_id, '.txt') as name, octet_length(encode(text)) as size, md5(text) as md5 from documents"


def enrich_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisitions joined with their run contexts on the work directory; those without one drop out."""
    acqs = acquisitions(spark, sf_dir).select(F.col("session_dir").alias("work_dir"), "acq_id", "n_files")
    contexts = (
        _fine(spark, sf_dir).where("doc_id % 3 = 0")
        .groupBy(F.concat(F.lit("/data/out/spark/run1/"), "id").alias("work_dir")).agg(F.count("*").alias("workers"))
    )
    return acqs.join(contexts, "work_dir")


ENRICH = f"""with {_FINE}, acqs as (select concat('/data/out/spark/run1/', id) as work_dir, id as acq_id, count(*) as n_files from fine group by id),
contexts as (select concat('/data/out/spark/run1/', id) as work_dir, count(*) as workers from fine where doc_id % 3 = 0 group by id)
select * from acqs join contexts using (work_dir)"""


def work_items_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.work_items(acquisitions(spark, sf_dir).select("acq_id"), channel=2, level=3)


WORK_ITEMS = f"""with {_FINE} select id as acq_id, channel, level from (select distinct id from fine)
cross join (select unnest(range(1, 3)) as channel) cross join (select unnest(range(1, 4)) as level)"""


def complete_acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch barrier on a composite key: groups with at least four distinct files."""
    return M.complete_groups(_valid(spark, sf_dir), ["id", "pattern"], "filename", 4)


COMPLETE = f"with {V.VALID} select id, pattern, count(distinct filename) as n_members from valid group by all having n_members >= 4"


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of the documents in files by source, language and hundred of ids, listed with their digests, which tasks stream.

    A folder holds all files of a source and language: folders, which the driver lists, don't grow with the documents.
    """
    folder = FI.qualified(spark, staging_path(spark, "store"))
    docs = V.table(spark, sf_dir, "documents").select(
        "source", "lang", F.floor(F.col("doc_id") / 100).alias("part"), "doc_id", F.col("text").alias("value")
    )
    # Names that any file system and URI takes; null and empty are called as Spark calls such partitions.
    safe = lambda c: F.coalesce(F.nullif(F.replace(F.url_encode(c), F.lit("%"), F.lit("~")), F.lit("")), F.lit(NO_NAME))
    number = F.coalesce(F.col("part").cast("string"), F.lit(NO_NAME))
    path = F.concat(F.lit(f"{folder}/source="), safe("source"), F.lit("/lang="), safe("lang"), F.lit("/part="), number, F.lit(".txt"))
    placed = docs.repartition("source", "lang", "part").select(path.alias("path"), "doc_id", "value")
    cut_lineage(FI.write_lines(placed.sortWithinPartitions("path", "doc_id")))
    files = FI.file_inventory(spark, folder, glob="*.txt")
    found = files.join(FI.file_digests(files), "path")
    place = r"/source=([^/]+)/lang=([^/]+)/part=([^/]+)\.txt$"
    names = [
        F.url_decode(F.replace(F.regexp_extract("path", place, k), F.lit("~"), F.lit("%"))).alias(c)
        for k, c in ((1, "source"), (2, "lang"))
    ]
    part = F.regexp_extract("path", place, 3).try_cast("long").alias("part")
    return found.select(*names, part, F.col("length").alias("n_bytes"), "md5")


NO_NAME = "__HIVE_DEFAULT_PARTITION__"
INVENTORY = """select source, lang, doc_id // 100 as part, strlen(string_agg(text, chr(10) order by doc_id)) + 1 as n_bytes,
  md5(string_agg(text, chr(10) order by doc_id) || chr(10)) as md5 from documents group by all"""


# --- rules -------------------------------------------------------------------------------

RULES = [
    Rule("resolution", "required"),
    Rule("resolution", "pattern", r"^[0-4]\.\d+,[\.\d]+,[\.\d]+$"),
    Rule("mode", "enum", ("BUILDING", "MACHINERY")),
    Rule("acq", "type", "int"),
    Rule("workers", "check", "workers <= 1 or cluster", "clusters are needed for several workers"),
]


def rule_violations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_violations(V.settings(spark, sf_dir), RULES, "c_custkey").select("c_custkey", "column", "kind")


RULE_VIOLATIONS = f"""with {V.SETTINGS}
select c_custkey, 'resolution' as column, 'pattern' as kind from settings where not regexp_matches(resolution, '^[0-4]\\.\\d+,[\\.\\d]+,[\\.\\d]+$')
union all select c_custkey, 'mode', 'enum' from settings where mode not in ('BUILDING', 'MACHINERY')
union all select c_custkey, 'acq', 'type' from settings where try_cast(acq as int) is null
union all select c_custkey, 'workers', 'check' from settings where not (workers <= 1 or cluster)"""


def nested_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.settings(spark, sf_dir).withColumn(
        "m", F.create_map("mode", F.create_map(F.lit("resolution"), "resolution", F.lit("acq"), "acq"))
    )
    return s.select("c_custkey", nested_lookup("m", F.lit("BUILDING"), F.lit("acq")).alias("found"))


NESTED = f"with {V.SETTINGS} select c_custkey, case when mode = 'BUILDING' then acq end as found from settings"


def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and null count as unset; plain coalesce would keep the empty string."""
    s = V.sheet(spark, sf_dir)
    return s.select("doc_id", M.or_default("uri", "none").alias("uri"), M.or_default(F.nullif(F.col("checksum"), F.lit("bad")), "N/A").alias("checksum"))


DEFAULTS = f"""with {V.SHEET} select doc_id, case when uri = '' then 'none' else uri end as uri,
  case when checksum in ('', 'bad') then 'N/A' else checksum end as checksum from sheet"""


def channel_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel options in their spellings, to numbers; ``all`` and unset give none."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, "all").when(k % 5 == 1, "").when(k % 5 == 2, F.concat(F.lit("ch"), k)).otherwise(F.concat(F.lit("c"), k, F.lit("x7")))
    return V.settings(spark, sf_dir).select("c_custkey", M.channel_number_column(name).alias("channel"))


CHANNEL_NAMES = f"with {V.SETTINGS} select c_custkey, case when c_custkey % 5 >= 2 then cast(c_custkey as int) end as channel from settings"


def list_conformance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose roles miss or disorder the required system, user, assistant."""
    turns = V.table(spark, sf_dir, "conversations")
    out = order_conformance(turns, "conv_id", "role", "turn", ["system", "user", "assistant"])
    return out.select("conv_id", F.array_join("missing", ",").alias("missing"), "order_violation")


CONFORMANCE = """with p as (
  select conv_id, min(turn) filter (where role = 'system') as s, min(turn) filter (where role = 'user') as u,
         min(turn) filter (where role = 'assistant') as a from conversations group by 1)
select conv_id, concat_ws(',', case when s is null then 'system' end, case when u is null then 'user' end, case when a is null then 'assistant' end) as missing,
  not (coalesce(s, -1) < coalesce(u, -1)) or not (coalesce(u, -1) < coalesce(a, -1)) as order_violation from p"""


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the path of every page address."""
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    pages = V.table(spark, sf_dir, "pages").select("page_id", path.alias("p"))
    raw = F.concat(F.col("p"), F.lit("/./img/../t.czi"))
    return pages.select(
        "page_id",
        X.path_parent("p").alias("parent"),
        X.path_name("p").alias("name"),
        X.path_extension(raw).alias("ext"),
        (X.path_normalize(raw) == X.path_normalize(F.concat(F.col("p"), F.lit("//t.czi")))).alias("same"),
    )


PATHS = """with p as (select page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as p from pages)
select page_id, regexp_extract(p, '^(.*)/[^/]*$', 1) as parent, regexp_extract(p, '([^/]*)$', 1) as name, 'czi' as ext, true as same from p"""


QUERIES = {
    "samplesheet_violations": (samplesheet_violations, VIOLATIONS),
    "samplesheet_valid": (samplesheet_valid, VALID),
    "samplesheet_roundtrip": (samplesheet_roundtrip, ROUNDTRIP),
    "multi_image_rule": (multi_image_rule, MULTI_IMAGE),
    "duplicate_files": (duplicate_files, DUPLICATES),
    "route_remote_local": (route_remote_local, ROUTE),
    "acquisitions": (acquisitions, ACQUISITIONS),
    "acquisition_lists": (acquisition_lists, LISTS),
    "acquisition_first_ext": (acquisition_first_ext, FIRST_EXT),
    "expected_files_semi": (expected_files_semi, EXPECTED_SEMI),
    "missing_files_anti": (missing_files_anti, MISSING_ANTI),
    "fetch_plan": (fetch_plan, FETCH_PLAN),
    "missing_path_rule": (missing_path_rule, MISSING_PATHS),
    "checksum_status": (checksum_status, CHECKSUM),
    "unzip_members": (unzip_members, UNZIP),
    "ingest_archives": (ingest_archives, INGEST_ARCHIVES),
    "enrich_join": (enrich_join, ENRICH),
    "work_items_cross": (work_items_cross, WORK_ITEMS),
    "complete_acquisitions": (complete_acquisitions, COMPLETE),
    "file_inventory": (file_inventory, INVENTORY),
    "rule_violations": (rule_violations_query, RULE_VIOLATIONS),
    "nested_lookup": (nested_lookup_query, NESTED),
    "default_values": (default_values, DEFAULTS),
    "channel_names": (channel_names, CHANNEL_NAMES),
    "list_conformance": (list_conformance_query, CONFORMANCE),
    "paths": (paths, PATHS),
}
