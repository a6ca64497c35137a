"""Decoders for the text fields of timetable records, and the matching validity tests.

Each field kind has a decoder (text column to typed column, NULL when the text is not valid) and a test
that is true when the text has to be rejected.  Both are built-in column expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeofday import HHMM, parse_hhmm, parse_hhmmh

FOREVER = "9999-12-31"


def _int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date from its digits, NULL when there is no such day."""
    return F.concat_ws("-", year, month, day).try_cast("date")


def _open_ended(text: Column, date: Column) -> Column:
    return F.when(text == "999999", F.lit(FOREVER).cast("date")).otherwise(date)


def _two(text: Column, start: int) -> Column:
    return F.substring(text, start, 2)


def _century(yy: Column) -> Column:
    return F.concat(F.when(yy >= "60", "19").otherwise("20"), yy)


def date_ddmmyy(text: Column) -> Column:
    return _open_ended(text, _date(_century(_two(text, 5)), _two(text, 3), _two(text, 1)))


def date_yymmdd(text: Column) -> Column:
    return _open_ended(text, _date(_century(_two(text, 1)), _two(text, 3), _two(text, 5)))


def date_yymmdd_1956(text: Column) -> Column:
    year = (_two(text, 1).try_cast("int") + 1956).cast("string")
    return _open_ended(text, F.when(year.isNotNull(), _date(year, _two(text, 3), _two(text, 5))))


def date_ddmmyyyy(text: Column) -> Column:
    """``DD/MM/YYYY``; the separators are not looked at."""
    return _date(F.substring(text, 7, 4), _two(text, 4), _two(text, 1))


def days_run(text: Column) -> Column:
    """Seven ``0``/``1`` characters, Monday first, as an array of booleans."""
    return F.when(text.rlike("^[01]{7}$"),
                  F.array(*[F.substring(text, i, 1) == "1" for i in range(1, 8)]))


def chunks(text: Column, count: int, step: int, keep: int) -> Column:
    """``count`` pieces, one every ``step`` characters, the first ``keep`` characters of each."""
    return F.array(*[F.substring(text, 1 + i * step, keep) for i in range(count)])


def activity(text: Column) -> Column:
    return chunks(text, 6, 2, 2)


def routeing_group(text: Column) -> Column:
    return chunks(text, 10, 4, 3)


_DECODERS = {
    "text": F.rtrim,
    "vartext": lambda t: t,
    "choice": lambda t: t,
    "flag": lambda t: t,
    "int": _int,
    "int?": _int,
    "time": parse_hhmm,
    "timeh": parse_hhmmh,
    "timeh?": parse_hhmmh,
    "ddmmyy": date_ddmmyy,
    "yymmdd": date_yymmdd,
    "yymmdd1956": date_yymmdd_1956,
    "dd/mm/yyyy": date_ddmmyyyy,
    "days": days_run,
    "activity": activity,
    "routeing": routeing_group,
}


def decode(kind: str, text: Column) -> Column:
    return _DECODERS[kind](text)


def rejected(kind: str, text: Column, allowed: tuple[str, ...] = ()) -> Column | None:
    """True where ``text`` is not a legal value; None for kinds that accept anything."""
    if kind in ("text", "vartext", "activity", "routeing"):
        return None
    if kind in ("flag", "choice"):
        return ~text.isin(*allowed)
    bad = decode(kind, text).isNull()
    return bad & (F.trim(text) != "") if kind.endswith("?") else bad


def pattern(kind: str, length: int, allowed: tuple[str, ...] = ()) -> str | None:
    """The shape of legal text of a fixed length; None for kinds that accept anything."""
    if kind == "flag":
        return "[" + "".join(re.escape(c) for c in allowed) + "]"
    if kind in ("int", "int?"):
        # digits with blanks on either side
        shapes = [f" {{{left}}}[0-9]{{{n}}} {{{length - left - n}}}"
                  for n in range(length, 0, -1) for left in range(length - n + 1)]
        blank = [f" {{{length}}}"] if kind == "int?" else []
        return "(?:" + "|".join(shapes + blank) + ")"
    return {
        "time": HHMM,
        "timeh": HHMM + r"\p{ASCII}",
        "timeh?": f"(?:{HHMM}" + r"\p{ASCII}| {5})",
        "ddmmyy": "[0-9]{6}",
        "yymmdd": "[0-9]{6}",
        "yymmdd1956": "[0-9]{6}",
        "days": "[01]{7}",
    }.get(kind)
