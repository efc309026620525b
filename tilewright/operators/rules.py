"""Rule tables over the columns of any settings table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``kind``: required, type, pattern, enum or check (a boolean expression over the row)."""

    column: str
    kind: str
    arg: object = None
    message: str | None = None

    def failed(self) -> Column:
        value = F.col(self.column) if self.kind != "check" else None
        if self.kind == "required":
            return value.isNull() | (value.cast("string") == "")
        if self.kind == "type":
            return value.isNotNull() & F.expr(f"try_cast(`{self.column}` as {self.arg})").isNull()
        if self.kind == "pattern":
            return value.isNotNull() & ~value.cast("string").rlike(self.arg)
        if self.kind == "enum":
            return value.isNotNull() & ~value.isin(list(self.arg))
        if self.kind == "check":
            return ~F.coalesce(F.expr(self.arg), F.lit(False))
        raise ValueError(f"unknown rule kind {self.kind!r}")

    def text(self) -> str:
        return self.message or f"{self.column}: {self.kind} {self.arg if self.arg is not None else ''}".strip()


# The option rules that tables of settings share.
SETTING_RULES = [
    Rule("resolution", "pattern", r"^[\.\d]+,[\.\d]+,[\.\d]+$"),
    Rule("stitching_block_size", "pattern", r"^\d+,\d+,\d+$"),
    Rule("final_block_size_xy", "type", "int"),
    Rule("stitching_mode", "enum", ("full", "incremental")),
    Rule("stitching_blur_sigma", "type", "int"),
    Rule("flatfield_correction", "type", "boolean"),
]


def rule_violations(rows: DataFrame, rules: Iterable[Rule], key: str | list[str]) -> DataFrame:
    """``key, column, kind, message`` per broken rule; one pass over the rows whatever the number of rules."""
    rules = list(rules)
    keys = [key] if isinstance(key, str) else key
    broken = F.array(
        *[
            F.when(
                r.failed(),
                F.struct(F.lit(r.column).alias("column"), F.lit(r.kind).alias("kind"), F.lit(r.text()).alias("message")),
            )
            for r in rules
        ]
    )
    found = rows.select(*keys, F.explode(F.filter(broken, lambda b: b.isNotNull())).alias("b"))
    return found.select(*keys, "b.*")


def missing_paths(rows: DataFrame, column: str, inventory: DataFrame) -> DataFrame:
    """The existence rule: rows whose path is not in the inventory."""
    wanted = rows.where(F.col(column).isNotNull() & (F.col(column) != ""))
    return wanted.join(inventory.select(F.col("path").alias(column)), column, "left_anti")


def is_version(c: Column | str) -> Column:
    """Starts with a digit, or is a 40-digit commit id."""
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(r"^\d") | c.rlike(r"^[a-f0-9]{40}$")


def list_conformance(rows: DataFrame, observed: str, required: list[str]) -> DataFrame:
    """Adds ``missing`` and ``order_violation`` for a list column against a required order.

    A missing item counts as before everything: it violates the order only as the later
    one of a neighbouring pair.  ``contains_all`` and ``overlaps`` are the subset and
    intersection tests.
    """
    want = F.array(*[F.lit(r) for r in required])
    places = [F.array_position(observed, r) for r in required]
    wrong = F.lit(False)
    for a, b in zip(places, places[1:]):
        wrong = wrong | ~(a < b)
    return rows.withColumns(
        {
            "missing": F.array_except(want, observed),
            "order_violation": wrong,
            "contains_all": F.size(F.array_except(want, observed)) == 0,
            "overlaps": F.arrays_overlap(want, observed),
        }
    )


def order_conformance(rows: DataFrame, key: str, item: str, position: str, required: list[str]) -> DataFrame:
    """The same checks for lists held as rows: first positions are partial aggregates per key."""
    first = [F.min(F.when(F.col(item) == r, F.col(position))).alias(f"_p{k}") for k, r in enumerate(required)]
    seen = rows.groupBy(key).agg(*first)
    places = [F.coalesce(F.col(f"_p{k}"), F.lit(-1)) for k in range(len(required))]
    wrong = F.lit(False)
    for a, b in zip(places, places[1:]):
        wrong = wrong | ~(a < b)
    absent = F.array_compact(F.array(*[F.when(F.col(f"_p{k}").isNull(), r) for k, r in enumerate(required)]))
    return seen.select(key, absent.alias("missing"), wrong.alias("order_violation"))
