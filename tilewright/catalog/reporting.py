"""Version, parameter and run-report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.catalog import views as V
from tilewright.functions import text as X
from tilewright.operators import report as R
from tilewright.operators.manifest import or_default
from tilewright.session import staging_path


def versions_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.version_rows(spark, sf_dir).select("process", "tool", "version").distinct()


DISTINCT = f"with {V.VERSION_ROWS} select distinct process, tool, version from version_rows"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sides of files; the side of even part sizes wins where both have a process."""
    rows = V.version_rows(spark, sf_dir).withColumn("side", F.floor(F.col("p_partkey") / 7) % 2)
    return R.merge_versions(rows, "side", "p_partkey")


_MERGED = V.VERSION_ROWS + """,
sided as (select *, p_partkey // 7 % 2 as side from version_rows),
last as (select process, side, tool, arg_max(version, p_partkey) as version from sided group by all),
merged as (select process, tool, version from last l
  where side = (select max(side) from last m where m.process = l.process))"""


def versions_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


MERGE = f"with {_MERGED} select * from merged"


def versions_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.module_conflicts(_merged(spark, sf_dir))


CONFLICTS = f"""with {_MERGED}, m as (select *, split_part(process, ':', -1) as module from merged),
pm as (select module, count(distinct process) as n_processes from m group by 1),
pt as (select module, tool, count(distinct process) as n_with_tool, count(distinct version) as n_versions from m group by all)
select module, tool, n_processes, n_with_tool, n_versions from pt join pm using (module) where n_versions > 1 or n_with_tool <> n_processes"""


def versions_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.module_versions(_merged(spark, sf_dir))


MODULES = f"with {_MERGED} select split_part(process, ':', -1) as process, tool, min(version) as version from merged group by all"


def versions_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three rows each; some versions carry a stray letter or marker."""
    k = F.col("p_partkey")
    rows = V.version_rows(spark, sf_dir).select(
        F.floor(k / 3).alias("file"), F.concat("process", F.floor(k / 3) % 2 * (k % 3)).alias("process"),
        F.when(k % 50 == 7, "END_VERSIONS").otherwise(F.col("tool")).alias("tool"),
        F.when(k % 20 == 3, F.concat(F.lit("v"), "version")).when(k % 20 == 4, F.sha1(F.col("version"))).otherwise(F.col("version")).alias("version"),
    )
    return R.version_faults(rows)


FORMAT = f"""with {V.VERSION_ROWS}, r as (
  select p_partkey // 3 as file, concat(process, p_partkey // 3 % 2 * (p_partkey % 3)) as process,
    case when p_partkey % 50 = 7 then 'END_VERSIONS' else tool end as tool,
    case when p_partkey % 20 = 3 then 'v' || version when p_partkey % 20 = 4 then sha1(version) else version end as version from version_rows)
select file, count(distinct process) as n_processes, count(tool) as n_tools, count(*) filter (where tool = 'END_VERSIONS') as n_markers,
  count(*) filter (where not (regexp_matches(version, '^\\d') or regexp_matches(version, '^[a-f0-9]{{40}}$'))) as n_odd_versions
from r group by file having n_processes <> 1 or n_tools = 0 or n_markers > 0 or n_odd_versions > 0"""


def versions_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions written as the merged YAML text and read back."""
    from tilewright.sources.versions import read_versions

    path = staging_path(spark, "versions")
    lines = R.versions_yaml(_merged(spark, sf_dir))
    # One file per process: a process header and its tools stay together.
    lines.repartition("process").sortWithinPartitions("process", "tool").select(
        F.regexp_replace("process", "[^A-Za-z0-9_]", "_").alias("file"), "value"
    ).write.partitionBy("file").text(path)
    return read_versions(spark, path).select("process", "tool", "version")


PARSED = MERGE


def versions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.versions_table(_merged(spark, sf_dir)).select("process", "tool", "label", "html")


TABLE = f"""with {_MERGED}, l as (select *, case when row_number() over (partition by process order by tool) = 1 then process else '' end as label from merged)
select process, tool, label, concat('<tr><td><samp>', label, '</samp></td><td><samp>', tool, '</samp></td><td><samp>', version, '</samp></td></tr>') as html from l"""


def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tools as sections; part of them have an explicit weight."""
    rows = V.table(spark, sf_dir, "part")
    sections = rows.groupBy(F.col("p_brand").alias("section")).agg(F.count("*").alias("n"))
    weights = rows.where("p_size > 45").groupBy(F.col("p_brand").alias("section")).agg(
        F.max(F.col("p_partkey") % 1000).alias("weight")
    )
    return R.order_sections(sections, weights)


SECTIONS = """with w as (select p_brand as section, max(p_partkey % 1000) as weight from part where p_size > 45 group by 1)
select p_brand as section, count(*) as n, coalesce(max(weight), 0) as weight from part left join w on section = p_brand group by 1"""


def pick_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pick_one(V.version_rows(spark, sf_dir), "process", "p_partkey", "tool")


PICK = f"with {V.VERSION_ROWS} select process, arg_min(tool, p_partkey) as tool, count(*) as n, count(*) > 1 as many from version_rows group by 1"


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of parameters per run; the later group repeats ``mode``, sometimes empty."""
    s = V.settings(spark, sf_dir)
    entry = lambda g, n, v: F.struct(F.lit(g).alias("group_order"), F.lit(n).alias("name"), v.cast("string").alias("value"))
    late = F.when(F.col("c_custkey") % 4 == 0, "").otherwise("full")
    groups = F.array(
        entry(1, "resolution", F.col("resolution")), entry(1, "mode", F.col("mode")),
        entry(2, "workers", F.col("workers")), entry(3, "mode", late),
    )
    return s.where("c_custkey % 3 > 0").select("c_custkey", F.explode(groups).alias("p")).select("c_custkey", "p.*").unionByName(
        s.where("c_custkey % 3 = 0").select("c_custkey", F.explode(F.slice(groups, 1, 3)).alias("p")).select("c_custkey", "p.*")
    )


def params_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.flatten_params(_params(spark, sf_dir), ["c_custkey"])


_FLAT = V.SETTINGS + """,
flat as (
  select c_custkey, 'resolution' as name, resolution as value from settings
  union all select c_custkey, 'workers', cast(workers as varchar) from settings
  union all select c_custkey, 'mode', case when c_custkey % 3 = 0 then mode when c_custkey % 4 = 0 then '' else 'full' end from settings)"""
FLAT = f"with {_FLAT} select * from flat"


def params_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.params_json(params_flat(spark, sf_dir), ["c_custkey"])
    return out.select("c_custkey", F.regexp_replace("value", r"\s*:\s*", ":").alias("value"))


PARAMS_JSON = f"""with {_FLAT} select c_custkey,
  concat('{{', chr(10), string_agg(concat('  "', name, '":"', value, '"'), concat(',', chr(10)) order by name), chr(10), '}}') as value from flat group by 1"""


def params_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.params_list(params_flat(spark, sf_dir), ["c_custkey"])


PARAMS_LIST = f"""with {_FLAT}, f as (select c_custkey, name, case when value = '' then 'N/A' else value end as value from flat)
select c_custkey, string_agg(concat(' - ', name, ': ', value), chr(10) order by name) as text,
  concat('[', string_agg(concat('{{"title":"', name, '","value":"', value, '"}}'), ',' order by name), ']') as facts from f group by 1"""


def params_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.params_html(params_flat(spark, sf_dir)).select("c_custkey", "name", "html")


PARAMS_HTML = f"""with {_FLAT} select c_custkey, name, concat('<dt>', name, '</dt><dd><samp>',
  case when value = '' then '<span style="color:#999999;">N/A</span>' else value end, '</samp></dd>') as html from flat"""


def version_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.version_rows(spark, sf_dir)
    k = F.col("p_partkey")
    version = F.when(k % 3 == 0, F.concat(F.lit("v"), "version")).when(k % 3 == 1, F.col("version"))
    commit = F.when(k % 2 == 0, F.sha1(F.col("tool")))
    return rows.select(
        "p_partkey", X.version_label(version, commit).alias("label"), X.module_name("process").alias("module"),
        X.name_to_id(F.concat("process", F.lit("/"), "tool")).alias("id"),
    )


VERSION_STRINGS = f"""with {V.VERSION_ROWS} select p_partkey,
  concat(case when p_partkey % 3 < 2 then 'v' || version else '' end, case when p_partkey % 2 = 0 then '-g' || substring(sha1(tool), 1, 7) else '' end) as label,
  split_part(process, ':', -1) as module, concat(process, '-', tool) as id from version_rows"""


def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command lines over page addresses: only the first hook goes."""
    pages = V.table(spark, sf_dir, "pages")
    command = F.concat(F.lit("run --input a.csv  --hook_url "), "url", F.lit(" --outdir o --hook_url kept"))
    return pages.select("page_id", X.redact_option(command).alias("command"))


REDACT = """select page_id, 'run --input a.csv --outdir o --hook_url kept' as command from pages"""


def tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents")
    text = F.replace(F.replace("text", F.lit("a,"), F.lit("a, .")), F.lit("e."), F.lit("e. ."))
    return docs.select("doc_id", F.md5(X.tidy_punctuation(text)).alias("digest"))


TIDY = """select doc_id, md5(replace(replace(replace(replace(replace(text, 'a,', 'a, .'), 'e.', 'e. .'), ', .', '.'), '. .', '.'), ', .', '.')) as digest from documents"""


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory and time words of every part, parsed and shortened."""
    unit = F.element_at(F.array(*[F.lit(u) for u in ("B", "KB", "MB", "GB", "TB")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    joint = F.when(F.col("p_partkey") % 2 == 0, ".").otherwise(" ")
    word = F.concat(F.col("p_size").cast("string"), joint, unit)
    hours = F.concat(F.col("p_size").cast("string"), F.lit(".h"))
    return V.table(spark, sf_dir, "part").select(
        "p_partkey", X.size_bytes(word).alias("bytes"), X.short_units(word).alias("short"),
        X.duration_seconds(hours).cast("long").alias("secs"), (X.size_bytes(word) <= X.size_bytes(F.lit("25.MB"))).alias("fits"),
    )


SIZES = """with w as (select p_partkey, p_size, p_partkey % 5 as u, case when p_partkey % 2 = 0 then '.' else ' ' end as j,
  ['B', 'KB', 'MB', 'GB', 'TB'][p_partkey % 5 + 1] as unit from part)
select p_partkey, cast(p_size * 1024 ** u as bigint) as bytes,
  case when j = ' ' and u > 0 then concat(p_size, lower(unit[1])) else concat(p_size, j, unit) end as short,
  cast(p_size as bigint) * 3600 as secs, p_size * 1024 ** u <= 25 * 1024 ** 2 as fits from w"""


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.run_outcome(V.run_trace(spark, sf_dir), ["acq"])


RUN_SUMMARY = f"""with {V.RUN_TRACE}, c as (select acq, count(*) filter (where status = 'ok') as n_ok, count(*) filter (where status = 'ignored') as n_ignored,
  count(*) filter (where status = 'failed') as n_failed from run_trace group by acq)
select *, case when n_failed > 0 then 'Pipeline completed with errors' when n_ignored > 0
  then 'Pipeline completed successfully, but with errored process(es) ' else 'Pipeline completed successfully' end as outcome from c"""


def run_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace rows appended to a table, then summed per stage with the time span."""
    path = staging_path(spark, "trace")
    R.append_trace(V.run_trace(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("stage").agg(
        F.count("*").alias("n"), X.file_stamp(F.min("ended")).alias("first"), X.file_stamp(F.max("ended")).alias("last"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
    )


RUN_STAGES = f"""with {V.RUN_TRACE} select stage, count(*) as n, strftime(min(ended), '%Y-%m-%d_%H-%M-%S') as first,
  strftime(max(ended), '%Y-%m-%d_%H-%M-%S') as last, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents from run_trace group by 1"""


def run_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = V.run_trace(spark, sf_dir)
    return t.select(
        "run_id", X.run_subject(F.lit("recon"), F.col("status") != "failed", "stage").alias("subject"),
        X.file_stamp("ended").alias("stamp"), or_default(F.when(F.col("status") == "failed", F.col("stage")), "None").alias("error"),
    )


RUN_MESSAGES = f"""with {V.RUN_TRACE} select run_id, concat('[recon] ', case when status = 'failed' then 'FAILED' else 'Successful' end, ': ', stage) as subject,
  strftime(ended, '%Y-%m-%d_%H-%M-%S') as stamp, case when status = 'failed' then stage else 'None' end as error from run_trace"""


def run_files_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published names: version files by pattern, or everything but one name."""
    k = F.col("run_id")
    name = F.when(k % 7 == 0, "versions.yml").when(k % 7 == 1, F.concat("stage", F.lit("_versions.yml"))).otherwise(F.concat("stage", k, F.lit(".txt")))
    named = V.run_trace(spark, sf_dir).select("run_id", name.alias("name"))
    by_pattern = R.published(named, "name", like="%\\_versions.yml").withColumn("sink", F.lit("info"))
    by_name = R.published(named, "name", drop="versions.yml").withColumn("sink", F.lit("report"))
    return by_pattern.unionByName(by_name)


PUBLISHED = f"""with {V.RUN_TRACE}, n as (select run_id, case when run_id % 7 = 0 then 'versions.yml' when run_id % 7 = 1 then stage || '_versions.yml'
  else concat(stage, run_id, '.txt') end as name from run_trace)
select run_id, name, 'info' as sink from n where name like '%\\_versions.yml' escape '\\'
union all select run_id, name, 'report' from n where name <> 'versions.yml'"""


def collected_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct version lines collected into one ordered text output, read back."""
    path = staging_path(spark, "collated")
    lines = V.version_rows(spark, sf_dir).select(F.format_string("%s %s %s", "process", "tool", "version").alias("line"))
    R.collect_file(lines, "line", ["line"], path)
    return spark.read.text(path).withColumnRenamed("value", "line")


COLLECTED = f"with {V.VERSION_ROWS} select distinct concat(process, ' ', tool, ' ', version) as line from version_rows"


QUERIES = {
    "versions_distinct": (versions_distinct, DISTINCT),
    "versions_merge": (versions_merge, MERGE),
    "versions_conflicts": (versions_conflicts, CONFLICTS),
    "versions_modules": (versions_modules, MODULES),
    "versions_format": (versions_format, FORMAT),
    "versions_parsed": (versions_parsed, PARSED),
    "versions_table": (versions_table, TABLE),
    "report_sections": (report_sections, SECTIONS),
    "pick_report": (pick_report, PICK),
    "params_flat": (params_flat, FLAT),
    "params_json": (params_json, PARAMS_JSON),
    "params_list": (params_list, PARAMS_LIST),
    "params_html": (params_html, PARAMS_HTML),
    "version_strings": (version_strings, VERSION_STRINGS),
    "redact": (redact, REDACT),
    "tidy": (tidy, TIDY),
    "sizes": (sizes, SIZES),
    "run_summary": (run_summary, RUN_SUMMARY),
    "run_stages": (run_stages, RUN_STAGES),
    "run_messages": (run_messages, RUN_MESSAGES),
    "run_files_published": (run_files_published, PUBLISHED),
    "collected_file": (collected_file, COLLECTED),
}
