"""Versions, parameters and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.text import module_name
from tilewright.operators.manifest import or_default


def parse_versions(lines: DataFrame) -> DataFrame:
    """``file, line_no, value`` text rows of versions files to ``file, process, tool, version``.

    A process line is carried down to its tool lines inside each file; a versions file is
    one task's own output, a handful of lines.
    """
    from pyspark.sql import Window

    header = F.regexp_extract("value", r'^"?([^\s"][^"]*?)"?:\s*$', 1)
    above = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    pattern = r'^\s+"?([^"\s]+?)"?:\s*[\'"]?(.*?)[\'"]?\s*$'
    carried = lines.withColumn("process", F.last(F.when(header != "", header), True).over(above))
    tools = carried.where(F.col("value").rlike(r"^\s+\S"))
    return tools.select(
        "file", "process", F.regexp_extract("value", pattern, 1).alias("tool"), F.regexp_extract("value", pattern, 2).alias("version")
    )


def merge_versions(rows: DataFrame, priority: str, order: str) -> DataFrame:
    """Process maps united: per process the side with the highest ``priority`` wins whole.

    Within a side the last row by ``order`` gives a tool's version.  Two partial
    aggregates; nothing is ranked inside a process.
    """
    tools = rows.groupBy("process", "tool", priority).agg(F.max_by("version", order).alias("version"))
    winner = tools.groupBy("process").agg(F.max(priority).alias(priority))
    return tools.join(winner, ["process", priority]).select("process", "tool", "version")


def module_conflicts(versions: DataFrame) -> DataFrame:
    """Modules whose processes do not all have the same tools and versions.

    Compared by counts: every tool of a module must occur in all its processes with one
    version.  No per-process map is ever built.
    """
    rows = versions.withColumn("module", module_name("process"))
    per_module = rows.groupBy("module").agg(F.count_distinct("process").alias("n_processes"))
    per_tool = rows.groupBy("module", "tool").agg(
        F.count_distinct("process").alias("n_with_tool"), F.count_distinct("version").alias("n_versions")
    )
    return (
        per_tool.join(per_module, "module")
        .where("n_versions > 1 or n_with_tool <> n_processes")
        .select("module", "tool", "n_processes", "n_with_tool", "n_versions")
    )


def module_versions(versions: DataFrame, strict: bool = False) -> DataFrame:
    """``module, tool, version``, one row each; ``strict`` fails when processes disagree."""
    if strict and not module_conflicts(versions).isEmpty():
        raise ValueError("software versions differ between processes of the same module")
    return versions.select(module_name("process").alias("process"), "tool", "version").groupBy("process", "tool").agg(
        F.min("version").alias("version")
    )


def version_faults(versions: DataFrame, group: str = "file") -> DataFrame:
    """Shape faults per versions file: number of processes, of tools, stray end markers, odd versions."""
    from tilewright.operators.rules import is_version

    per_file = versions.groupBy(group).agg(
        F.count_distinct("process").alias("n_processes"),
        F.count("tool").alias("n_tools"),
        F.count_if(F.concat_ws(" ", "process", "tool", "version").contains("END_VERSIONS")).alias("n_markers"),
        F.count_if(~is_version("version")).alias("n_odd_versions"),
    )
    return per_file.where("n_processes <> 1 or n_tools = 0 or n_markers > 0 or n_odd_versions > 0")


def first_in_group(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``is_first``: the row with the group's smallest ``order``; a joined minimum, not a ranked window."""
    first = rows.groupBy(group).agg(F.min(order).alias("_first"))
    return rows.join(first, group).withColumn("is_first", F.col(order) == F.col("_first")).drop("_first")


def versions_table(versions: DataFrame) -> DataFrame:
    """Rows of the versions table: ``process, tool, label, html``; sort by process and tool to render."""
    marked = first_in_group(versions, "process", "tool")
    label = F.when(F.col("is_first"), F.col("process")).otherwise("")
    cell = "<td><samp>%s</samp></td>"
    return marked.select(
        "process", "tool", "version", label.alias("label"), F.format_string(f"<tr>{cell * 3}</tr>", label, "tool", "version").alias("html")
    )


def versions_yaml(versions: DataFrame) -> DataFrame:
    """``process, tool, value`` lines of the merged file; the process line is the row with an empty tool."""
    head = versions.select("process").distinct().select("process", F.lit("").alias("tool"), F.concat("process", F.lit(":")).alias("value"))
    body = versions.select("process", "tool", F.format_string("  %s: '%s'", "tool", "version").alias("value"))
    return head.unionByName(body)


def write_lines(rows: DataFrame, order: list[str], path: str, value: str = "value", single_file: bool = False) -> None:
    """Text lines in order; part files sort by name.  ``single_file`` only for report-sized rows."""
    ordered = rows.orderBy(*order)
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.select(F.col(value).alias("value")).write.mode("overwrite").text(path)


def collect_file(rows: DataFrame, value: str, order: list[str], path: str) -> None:
    """Distinct items of a stream of lines into one ordered text output."""
    write_lines(rows.select(value, *[o for o in order if o != value]).distinct(), order, path, value)


def order_sections(sections: DataFrame, weights: DataFrame, name: str = "section") -> DataFrame:
    """Sections by descending explicit weight (0 without one), then by name, as they are rendered."""
    weighted = sections.join(weights, name, "left").withColumn("weight", F.coalesce("weight", F.lit(0)))
    return weighted.orderBy(F.desc("weight"), name)


def pick_one(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """The first of possibly many reports and how many there were."""
    return rows.groupBy(group).agg(
        F.min_by(value, order).alias(value), F.count("*").alias("n"), (F.count("*") > 1).alias("many")
    )


def flatten_params(params: DataFrame, keys: list[str], order: str = "group_order") -> DataFrame:
    """Parameter groups to one value per name; later groups win."""
    return params.groupBy(*keys, "name").agg(F.max_by("value", order).alias("value"))


def params_json(flat: DataFrame, keys: list[str]) -> DataFrame:
    """One pretty JSON object per key, names sorted.  A run has few parameters; runs may be many."""
    entries = F.array_sort(F.collect_list(F.struct("name", "value")))
    packed = flat.groupBy(*keys).agg(F.map_from_entries(entries).alias("m"))
    return packed.select(*keys, F.to_json("m", {"pretty": "true"}).alias("value"))


def dump_params(flat: DataFrame, keys: list[str], stamp: str, folder: str) -> str:
    """``params_<timestamp>.json`` below ``folder``."""
    path = f"{folder}/params_{stamp}.json"
    params_json(flat, keys).select("value").write.mode("overwrite").text(path)
    return path


def params_list(flat: DataFrame, keys: list[str]) -> DataFrame:
    """``- name: value`` lines and the title/value list of a message, per key."""
    entry = F.array_sort(F.collect_list(F.struct("name", or_default("value", "N/A").alias("value"))))
    packed = flat.groupBy(*keys).agg(entry.alias("e"))
    return packed.select(
        *keys,
        F.array_join(F.transform("e", lambda p: F.concat(F.lit(" - "), p["name"], F.lit(": "), p["value"])), "\n").alias("text"),
        F.to_json(F.transform("e", lambda p: F.struct(p["name"].alias("title"), p["value"].alias("value")))).alias("facts"),
    )


def params_html(flat: DataFrame) -> DataFrame:
    """Definition-list row of each parameter, with a grey N/A for empty values."""
    # Fixed value: the grey N/A; its span is closed as a span.
    shown = or_default("value", '<span style="color:#999999;">N/A</span>')
    return flat.withColumn("html", F.format_string("<dt>%s</dt><dd><samp>%s</samp></dd>", "name", shown))


def nested_lookup(c: Column | str, first: Column, second: Column) -> Column:
    """``map[first][second]``, null when either level is missing."""
    return F.try_element_at(F.try_element_at(c, first), second)


def published(rows: DataFrame, name: str, like: str | None = None, drop: str | None = None) -> DataFrame:
    """Only file names that match a pattern, without one excluded name."""
    if like is not None:
        rows = rows.where(F.col(name).like(like))
    return rows if drop is None else rows.where(F.col(name) != drop)


def run_outcome(trace: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by status and the closing message of each run or stage."""
    counts = trace.groupBy(*keys).agg(
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "ignored").alias("n_ignored"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    # The three closing messages.
    outcome = (
        F.when(F.col("n_failed") > 0, "Pipeline completed with errors")
        .when(F.col("n_ignored") > 0, "Pipeline completed successfully, but with errored process(es) ")
        .otherwise("Pipeline completed successfully")
    )
    return counts.withColumn("outcome", outcome)


def append_trace(rows: DataFrame, path: str) -> None:
    """Stage metrics of a job: run_id, stage, acq_id, started, ended, rows."""
    rows.write.mode("append").parquet(path)
