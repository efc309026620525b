"""Three-component vectors and axis maps held in strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_vector(text: Column | str, kind: str = "double") -> Column:
    """``'0.23,0.23,0.42'`` to an array of three numbers."""
    return F.transform(F.split(text, ","), lambda v: F.trim(v).cast(kind))


def parse_axes(text: Column | str) -> Column:
    """``'-x,y,z'`` to an array of (axis letter, sign)."""

    def one(part: Column) -> Column:
        part = F.trim(part)
        return F.struct(
            F.right(part, F.lit(1)).alias("axis"),
            F.when(part.startswith("-"), F.lit(-1)).otherwise(F.lit(1)).alias("sign"),
        )

    return F.transform(F.split(text, ","), one)


def axis_ordinal(letter: Column) -> Column:
    """1-based position of an axis letter in x,y,z; any other letter is an error."""
    found = F.array_position(F.array(F.lit("x"), F.lit("y"), F.lit("z")), letter)
    return F.when(found > 0, found).otherwise(
        F.raise_error(F.concat(F.lit("unknown axis: "), letter)).cast("long")
    )


def stage_to_pixel(stage: Column, axes: Column, resolution: Column) -> Column:
    """``pos[k] = sign_k * stage[axis_k] / resolution[k]`` for pixel axes x, y, z."""
    return F.zip_with(
        axes,
        resolution,
        lambda a, r: a["sign"] * F.element_at(stage, axis_ordinal(a["axis"]).cast("int")) / r,
    )
