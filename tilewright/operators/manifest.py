"""Samplesheet rows to acquisitions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two row messages.
NO_ID = "Acquisition name is required."
NO_FILE = "File name is required."


def is_blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def or_default(c: Column | str, default) -> Column:
    """``default`` for null, for the empty string, and for 0 and false unless they are text."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    falsy = (F.typeof(c) != "string") & ((text == "false") | (text.try_cast("double") == 0))
    return F.when(c.isNull() | (text == "") | falsy, default).otherwise(c)


def violations(sheet: DataFrame) -> DataFrame:
    """``line_no, message``: the id is tested first, as given; blanks count, missing is empty."""
    empty = lambda c: F.length(F.coalesce(F.col(c), F.lit(""))) == 0
    message = F.when(empty("id"), NO_ID).when(empty("filename"), NO_FILE)
    return sheet.select("line_no", message.alias("message")).where("message is not null")


def validate(sheet: DataFrame, strict: bool = True) -> DataFrame:
    """Valid rows with spaces of the id replaced.

    ``strict`` fails on the first bad line, as the command line does; otherwise bad rows are
    left out (see ``violations`` for the report).
    """
    if strict:
        first = violations(sheet).agg(F.min_by("message", "line_no").alias("m"), F.min("line_no").alias("l")).first()
        if first["l"] is not None:
            raise ValueError(f"{first['m']} On line {first['l']}.")
    ok = (F.length(F.coalesce("id", F.lit(""))) > 0) & (F.length(F.coalesce("filename", F.lit(""))) > 0)
    return sheet.where(ok).withColumn("id", F.replace("id", F.lit(" "), F.lit("_")))


def multi_image_faults(sheet: DataFrame) -> DataFrame:
    """Acquisitions with several ``.czi`` rows and no pattern: ``id, n_images, message``."""
    given = F.length(F.coalesce("pattern", F.lit(""))) > 0
    per_id = sheet.groupBy("id").agg(
        F.count_if(F.col("filename").endswith(".czi")).alias("n_images"),
        F.max_by(F.when(given, F.col("pattern")), F.when(given, F.col("line_no"))).alias("pattern"),
    )
    # Fixed value: the message of the rule.
    message = F.format_string(
        "Acquisition '%s' has more than one CZI file, so it needs to have at least one value in the 'pattern' column.", "id"
    )
    return per_id.where("n_images > 1 and pattern is null").select("id", "n_images", message.alias("message"))


def check_multi_image(sheet: DataFrame) -> DataFrame:
    fault = multi_image_faults(sheet).agg(F.min("message").alias("m")).first()["m"]
    if fault:
        raise ValueError(fault)
    return sheet


def duplicate_files(sheet: DataFrame) -> DataFrame:
    """Rows naming the same file of the same acquisition more than once (a report, not an error)."""
    return sheet.groupBy("id", "filename").count().where("count > 1").withColumnRenamed("count", "n")


def route(df: DataFrame, rules: dict[str, Column], default: str | None = None) -> DataFrame:
    """``route`` column: the first label whose predicate holds; without a default the rest is dropped."""
    label = None
    for name, predicate in rules.items():
        label = F.when(predicate, name) if label is None else label.when(predicate, name)
    if default is not None:
        return df.withColumn("route", label.otherwise(default))
    return df.withColumn("route", label).where("route is not null")


def route_remote(sheet: DataFrame, by_header: bool = False) -> DataFrame:
    """``remote`` or ``local`` per row: rows with a uri are remote.

    ``by_header`` decides on whether the sheet has the column at all.  A sheet read without
    it carries null uris, while blank cells are ''.
    """
    remote = F.col("uri").isNotNull() if by_header else ~is_blank("uri")
    return route(sheet, {"remote": remote}, default="local")


def acquisition_files(sheet: DataFrame, image_dir: str) -> DataFrame:
    """``acq_id, line_no, path, filename, ext, pattern``: one row per file."""
    return sheet.select(
        F.col("id").alias("acq_id"),
        "line_no",
        F.concat_ws("/", F.lit(image_dir), "filename").alias("path"),
        "filename",
        F.regexp_extract("filename", r"\.([^./]+)$", 1).alias("ext"),
        "pattern",
    )


def acquisitions(files: DataFrame, outdir: str, session: str = "session") -> DataFrame:
    """One row per acquisition.

    ``pattern`` is the first non-blank one in row order; without any, an acquisition with a
    single image uses that file's name.  All columns are partial aggregates, so an
    acquisition may hold any share of the rows.
    """
    given = ~is_blank("pattern")
    image = F.col("ext") == "czi"
    first_line = lambda value, cond: F.min_by(F.when(cond, value), F.when(cond, F.col("line_no")))
    per_id = files.groupBy("acq_id").agg(
        F.count("*").alias("n_files"),
        F.count_if(image).alias("n_images"),
        first_line(F.col("pattern"), given).alias("first_pattern"),
        F.max_by(F.when(F.length("pattern") > 0, F.col("pattern")), F.when(F.length("pattern") > 0, F.col("line_no"))).alias("last_pattern"),
        first_line(F.col("path"), F.col("ext") == "mvl").alias("metadata_file"),
        first_line(F.col("filename"), image).alias("first_image"),
    )
    return per_id.select(
        "acq_id", "n_files", "n_images",
        F.coalesce("first_pattern", F.when(F.col("n_images") == 1, F.col("first_image"))).alias("pattern"),
        (~F.col("first_pattern").eqNullSafe(F.col("last_pattern"))).alias("patterns_differ"),
        "metadata_file", "first_image",
        F.format_string("%s/stitching/%s", F.lit(outdir), "acq_id").alias("stitching_dir"),
        F.format_string("%s/spark/%s/%s", F.lit(outdir), F.lit(session), "acq_id").alias("session_dir"),
    )


def packed_files(files: DataFrame, lead: list[str] | None = None) -> DataFrame:
    """One list per acquisition, in row order: ``acq_id, files, patterns``.

    ``lead`` entries (such as the directories) come before the files.  A list is as long as its
    acquisition; ``acquisition_files`` has one row per file for plans that need no list.
    """
    listed = files.groupBy("acq_id").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "path", "pattern"))).alias("rows")
    )
    paths = F.transform("rows", lambda r: r["path"])
    if lead:
        paths = F.concat(F.array(*[F.lit(v) for v in lead]), paths)
    return listed.select("acq_id", paths.alias("files"), F.transform("rows", lambda r: r["pattern"]).alias("patterns"))


def require_metadata(acqs: DataFrame) -> DataFrame:
    """Fail when an acquisition has no metadata file or no pattern to find its images by."""
    missing = F.concat(F.lit("no metadata file for "), "acq_id")
    no_pattern = F.concat(F.lit("no file pattern for "), "acq_id")
    good = (
        F.when(F.col("metadata_file").isNull(), F.raise_error(missing).cast("boolean"))
        .when(F.col("pattern").isNull(), F.raise_error(no_pattern).cast("boolean"))
        .otherwise(True)
    )
    return acqs.where(good)


def expected_files(acqs: DataFrame, tiles_per_acquisition: int | str) -> DataFrame:
    """``acq_id, n, filename``: the pattern printed with each tile number."""
    last = F.col(tiles_per_acquisition) if isinstance(tiles_per_acquisition, str) else F.lit(tiles_per_acquisition)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), (last - 1).cast("long")))
    return acqs.select("acq_id", "pattern", numbers.alias("n")).select(
        "acq_id", "n", F.expr("format_string(pattern, n)").alias("filename")
    )


def work_items(acqs: DataFrame, **counts: int) -> DataFrame:
    """Every acquisition with every number 1..n of each named dimension; rows expand in place."""
    out = acqs
    for name, n in counts.items():
        out = out.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n))))
    return out


def channel_number(name: str | None) -> int | None:
    """``all``, empty or unset: no choice; otherwise the first digits of the name."""
    if not name or name == "all":
        return None
    digits = re.search(r"\d+", name)
    if digits is None:
        raise ValueError(f"Invalid value for stitching_channel: {name}")
    return int(digits.group())


def select_channel(df: DataFrame, name: str | None) -> DataFrame:
    number = channel_number(name)
    return df if number is None else df.where(F.col("channel") == number)


def channel_number_column(name: Column | str) -> Column:
    """Column form of ``channel_number``: null for no choice, an error without digits."""
    name = F.col(name) if isinstance(name, str) else name
    digits = F.regexp_extract(name, r"(\d+)", 1)
    bad = F.raise_error(F.concat(F.lit("Invalid value for stitching_channel: "), name)).cast("int")
    chosen = F.when(digits == "", bad).otherwise(digits.cast("int"))
    return F.when(name.isNull() | (name == "") | (name == "all"), F.lit(None).cast("int")).otherwise(chosen)


def complete_groups(rows: DataFrame, keys: list[str], member: str, expected: int | str) -> DataFrame:
    """Keys whose distinct members have all arrived: ``keys, n_members``."""
    need = F.col(expected) if isinstance(expected, str) else F.lit(expected)
    return rows.groupBy(*keys).agg(F.count_distinct(member).alias("n_members")).where(F.col("n_members") >= need)
