"""String and rendering functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit suffixes of memory sizes and their short forms.
UNIT_SUFFIX = [(" KB", "k"), (" MB", "m"), (" GB", "g"), (" TB", "t")]
# Bytes per unit.
UNIT_BYTES = {"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30, "TB": 1 << 40}
# Seconds per unit.
UNIT_SECONDS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def module_name(process: Column | str) -> Column:
    """The part of a process name after the last colon."""
    return F.element_at(F.split(process, ":"), -1)


def name_to_id(name: Column | str) -> Column:
    return F.replace(_col(name), F.lit("/"), F.lit("-"))


def short_units(size: Column | str) -> Column:
    """``'6 GB'`` to ``'6g'`` and so on."""
    out = _col(size)
    for suffix, short in UNIT_SUFFIX:
        out = F.replace(out, F.lit(suffix), F.lit(short))
    return out


def size_bytes(size: Column | str) -> Column:
    """``'25.MB'`` or ``'1 GB'`` to bytes; null for anything else."""
    size = _col(size)
    pattern = r"^\s*(\d+(?:\.\d+)?)[\s.]*(B|KB|MB|GB|TB)\s*$"
    units = F.create_map(*[F.lit(v) for pair in UNIT_BYTES.items() for v in pair])
    number = F.regexp_extract(size, pattern, 1)
    unit = F.regexp_extract(size, pattern, 2)
    return F.when(unit != "", F.floor(number.cast("double") * F.try_element_at(units, unit))).cast("long")


def duration_seconds(text: Column | str) -> Column:
    """``'240.h'`` to seconds; null for anything else."""
    pattern = r"^\s*(\d+(?:\.\d+)?)[\s.]*(ms|s|m|h|d)\s*$"
    units = F.create_map(*[F.lit(float(v) if i % 2 else v) for pair in UNIT_SECONDS.items() for i, v in enumerate(pair)])
    number, unit = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.when(unit != "", number.cast("double") * F.try_element_at(units, unit))


def version_label(version: Column | str, commit: Column | str) -> Column:
    """``v`` before the version unless it is there, ``-g`` and seven digits of the commit."""
    version, commit = _col(version), _col(commit)
    given = lambda c: c.isNotNull() & (c != "")
    head = F.when(given(version), F.concat(F.when(version.startswith("v"), "").otherwise("v"), version)).otherwise("")
    tail = F.when(given(commit), F.concat(F.lit("-g"), F.substring(commit, 1, 7))).otherwise("")
    return F.concat(head, tail)


def redact_option(command: Column | str, option: str = "--hook_url") -> Column:
    """Remove the first occurrence of an option and its value."""
    return F.regexp_replace(command, rf"(?s)^(.*?) +{option} +[^ ]+", "$1")


def tidy_punctuation(text: Column | str) -> Column:
    """Close up a stop that follows a comma or a stop; the comma rule runs again at the end."""
    text = F.regexp_replace(text, r", \.", ".")
    text = F.regexp_replace(text, r"\. \.", ".")
    return F.regexp_replace(text, r", \.", ".")


def file_stamp(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def run_subject(name: Column | str, success: Column | str, run: Column | str) -> Column:
    word = F.when(_col(success), "Successful").otherwise("FAILED")
    return F.concat(F.lit("["), _col(name), F.lit("] "), word, F.lit(": "), _col(run))


# Paths -----------------------------------------------------------------------------------


def path_parent(path: Column | str) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def path_name(path: Column | str) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def path_extension(path: Column | str) -> Column:
    """After the last dot of the name; '' without one."""
    return F.regexp_extract(path, r"\.([^./]*)$", 1)


def path_normalize(path: Column | str, base: str = "/") -> Column:
    """Absolute path without ``.``, ``..`` and empty parts."""
    path = _col(path)
    absolute = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))
    parts = F.filter(F.split(absolute, "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(p))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))
