"""Layout-driven decoding of fixed-width lines, and what happens to lines that are not valid.

Two modes.  ``failfast`` stops the job at the first bad record, as a load into constrained tables would.
``permissive`` keeps every record and adds an ``errors`` array column, so that bad ones can be put aside.

A whole line is tested with one pattern made from its layout (plus the calendar, for dates).  The test of
each single field is evaluated only for lines that fail, to say what is wrong.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decoders import decode, pattern, rejected
from .layouts import Field

MODES = ("failfast", "permissive")

_ANY = r"\p{ASCII}"


def once(**values: Column) -> Column:
    """Columns that are computed where they are selected.

    Catalyst moves filters below projections and puts in the expression for each use of a column.  With
    costly text expressions that repeats the work for every test; it does not look into a generator.
    """
    return F.inline(F.array(F.struct(*[value.alias(name) for name, value in values.items()])))


def raw(line: Column, field: Field) -> Column:
    return F.substring(line, field.start, field.length)


def columns(line: Column, layout: Sequence[Field]) -> list[Column]:
    return [decode(f.kind, raw(line, f)).alias(f.name) for f in layout]


def problems(line: Column, layout: Sequence[Field]) -> list[Column]:
    """One column per checkable field: its name where the text is not valid, else NULL."""
    tests = ((f, rejected(f.kind, raw(line, f), f.allowed)) for f in layout)
    return [F.when(bad, F.lit(f.name)) for f, bad in tests if bad is not None] + [
        F.when(line.rlike(r"[^\x00-\x7F]"), F.lit("not ascii"))]


def line_pattern(layout: Sequence[Field], prefix: str = "") -> str:
    """A pattern for a padded line that starts with ``prefix``."""
    parts, at = [re.escape(prefix)], len(prefix) + 1
    for f in layout:
        if f.start > at:
            parts.append(f"{_ANY}{{{f.start - at}}}")
        parts.append(pattern(f.kind, f.length, f.allowed) or f"{_ANY}{{{f.length}}}")
        at = f.start + f.length
    return "".join(parts) + f"{_ANY}*"


def well_formed(line: Column, layouts: dict[str, Sequence[Field]]) -> Column:
    """Whether a line is valid for the layout of its leading characters."""
    shape = "|".join(line_pattern(layout, prefix) for prefix, layout in layouts.items())
    test = line.rlike(rf"^(?:{shape})\z")
    for prefix, layout in layouts.items():
        for f in layout:
            if "yy" in f.kind:
                real = decode(f.kind, raw(line, f)).isNotNull()
                test = test & (real if len(layouts) == 1 else ~line.startswith(prefix) | real)
    return test


def judged(df: DataFrame, valid: Column, found: list[Column], out: list[Column], mode: str) -> DataFrame:
    """Select ``out``; ``found`` holds the messages for rows that are not ``valid``, NULL where none."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    errors = F.filter(F.array(*found), lambda e: e.isNotNull())
    if mode == "permissive":
        return df.select(*out, F.when(valid, F.array().cast("array<string>")).otherwise(errors).alias("errors"))
    stop = F.raise_error(F.concat(F.lit("bad record: "), F.array_join(F.array(*found), ", ")))
    return df.filter(F.when(valid, True).otherwise(stop.cast("boolean"))).select(*out)
