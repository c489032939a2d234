"""Key joins that stay balanced when one key holds a large share of the rows.

Joining a large table to a per-key table (one row per key, e.g. per-user averages)
sends all rows of a key to one task, and AQE's skew handling can't split it when the
per-key side is an aggregate that is already partitioned on the key: no shuffle sits on that
side, so there is nothing to split against. ``per_key_join`` therefore takes per-key tables
that were materialised (``session.materialize``). Both sides are then shuffled for the
join, and AQE splits a hot key's partition by map output ranges, as often as its size asks,
and reads the per-key partition once for each part. Nothing is
salted, so a retried task yields the same rows. AQE goes by compressed bytes: identical
copies of a row are spread too, but only once their compressed size asks for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def per_key_join(large: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``large.join(per_key, key, how)`` for a materialised ``per_key`` with at most one row
    per key. Only joins whose large side may be split are allowed."""
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    return large.join(per_key, key, how)
