"""Tag-list predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_array(tags: Iterable[str]) -> Column:
    """A literal ``array<string>``; typed even when empty."""
    tags = list(tags)
    if not tags:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(t) for t in tags])


def has_all_tags(tags_col: Column | str, required: Iterable[str]) -> Column:
    """True when every required tag is present; an empty requirement keeps every row."""
    col = F.col(tags_col) if isinstance(tags_col, str) else tags_col
    required = list(required)
    if not required:
        return F.lit(True)
    return F.size(F.array_except(tag_array(required), col)) == 0


def has_any_tag(tags_col: Column | str, wanted: Iterable[str]) -> Column:
    """True when at least one wanted tag is present; an empty list keeps no row."""
    col = F.col(tags_col) if isinstance(tags_col, str) else tags_col
    wanted = list(wanted)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(col, tag_array(wanted)), F.lit(False))
