"""Names, missing-value markers and digit tests."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that stand for a missing value in the feed.
NULL_MARKERS = ("", ":", "-", "--")


def sanitize_name(name: str) -> str:
    """A header field as a safe lower-case column name."""
    bare = re.sub(r"^[\"']|[\"']$", "", name.strip())
    safe = re.sub(r"[^a-z0-9]+", "_", bare.lower()).strip("_")
    if safe[:1].isdigit():
        return "f_" + safe
    return safe or "col"


def unique_names(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """Suffix names that repeat, or are ``taken`` already, with ``_2``, ``_3``, ... until none does."""
    wanted = list(names)
    taken = set(taken)
    repeats: dict[str, int] = {}
    result = []
    for name in wanted:
        candidate = name
        while candidate in taken:
            repeats[name] = repeats.get(name, 1) + 1
            candidate = f"{name}_{repeats[name]}"
        taken.add(candidate)
        result.append(candidate)
    return result


def alias_name(label: str, prefix: str) -> str:
    """A business name as a column name: every other character becomes ``_``."""
    return prefix + re.sub(r"[^a-z0-9]", "_", label.lower())


def null_if_marker(col: Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    return F.when(~col.isin(*markers), col)


def null_if_blank(col: Column) -> Column:
    """NULL for a string of nothing but white space, else the string itself."""
    return F.when(col.rlike(r"\S"), col)


def all_digits(col: Column, low: int, high: int | None = None) -> Column:
    """True when the whole string is ``low`` to ``high`` digits.

    ``\\z`` and not ``$``: the latter also accepts a trailing line break.
    """
    width = f"{{{low}}}" if high is None else f"{{{low},{high}}}"
    return col.rlike(rf"^[0-9]{width}\z")


def malformed(col: Column, low: int, high: int | None = None) -> Column:
    return col.isNull() | ~all_digits(col, low, high)
