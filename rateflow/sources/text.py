"""Pipe-delimited text sources and sinks.

Layouts (no header):
  items    ``id|"title"|"tag|tag|..."``
  ratings  ``user|item|rating|epoch_seconds``
  deltas   ``user|item|old_rating|rating|epoch_seconds``; a negative old rating means none

Parsing follows the original loaders: every ``"`` is removed from the line before it is
split on ``|``; items are split into at most three fields, and the tag field is split
again with Java ``String.split`` semantics (trailing empty fields dropped). Casts are
strict: under ANSI a malformed line fails the job, as the original does. With
``permissive=True`` the readers leave malformed lines out (``try_cast``); ``rejected_lines`` shows
them, and ``divert_lines`` stores good rows and rejected lines in one pass.

The whole parse is column expressions over ``spark.read.text``: it splits files across
tasks like any text scan and never goes through Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rateflow.session import scratch_path

_PIPE = r"\|"


def _strip_quotes(value: Column) -> Column:
    return F.regexp_replace(value, '"', "")


def java_split(s: Column, sep_regex: str = _PIPE) -> Column:
    """``String.split(regex)`` as Java does it: trailing empty strings are removed.

    A string made only of separators becomes an empty array; the empty string stays
    ``[""]``.
    """
    only_seps = s.rlike(f"^({sep_regex})+$")
    trimmed = F.regexp_replace(s, f"({sep_regex})+$", "")
    return F.when(only_seps, F.array().cast("array<string>")).otherwise(F.split(trimmed, sep_regex))


def _cast(c: Column, type_name: str, permissive: bool) -> Column:
    return c.try_cast(type_name) if permissive else c.cast(type_name)


def _field(arr: Column, i: int, permissive: bool) -> Column:
    # element_at under ANSI raises on a missing field; try_element_at gives NULL.
    return F.try_element_at(arr, F.lit(i + 1)) if permissive else arr.getItem(i)


def read_items_text(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    parts = F.split(_strip_quotes(F.col("value")), _PIPE, 3)
    df = spark.read.text(path).select(parts.alias("f"))
    out = df.select(
        _cast(_field(F.col("f"), 0, permissive), "bigint", permissive).alias("item_id"),
        _field(F.col("f"), 1, permissive).alias("title"),
        java_split(_field(F.col("f"), 2, permissive)).alias("tags"),
    )
    if permissive:
        out = out.where(F.col("item_id").isNotNull() & F.col("tags").isNotNull())
    return out


def read_ratings_text(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    df = spark.read.text(path).select(java_split(_strip_quotes(F.col("value"))).alias("f"))
    f = F.col("f")
    out = df.select(
        _cast(_field(f, 0, permissive), "bigint", permissive).alias("user_id"),
        _cast(_field(f, 1, permissive), "bigint", permissive).alias("item_id"),
        F.lit(None).cast("double").alias("old_rating"),
        _cast(_field(f, 2, permissive), "double", permissive).alias("rating"),
        _cast(_field(f, 3, permissive), "bigint", permissive).alias("ts"),
    )
    if permissive:
        out = out.dropna(subset=["user_id", "item_id", "rating", "ts"])
    return out


def read_deltas_text(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    df = spark.read.text(path).select(java_split(_strip_quotes(F.col("value"))).alias("f"))
    return parse_delta_fields(df, F.col("f"), permissive)


def parse_delta_fields(df: DataFrame, f: Column, permissive: bool = False) -> DataFrame:
    old = _cast(_field(f, 2, permissive), "double", permissive)
    out = df.select(
        _cast(_field(f, 0, permissive), "bigint", permissive).alias("user_id"),
        _cast(_field(f, 1, permissive), "bigint", permissive).alias("item_id"),
        F.when(old >= 0, old).alias("old_rating"),
        _cast(_field(f, 3, permissive), "double", permissive).alias("rating"),
        _cast(_field(f, 4, permissive), "bigint", permissive).alias("ts"),
    )
    if permissive:
        out = out.dropna(subset=["user_id", "item_id", "rating", "ts"])
    return out


def rejected_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(line): the lines that the permissive reader of this kind (``items``, ``ratings`` or
    ``deltas``) leaves out."""
    lines = spark.read.text(path)
    if kind == "items":
        f = F.split(_strip_quotes(F.col("value")), _PIPE, 3)
        needed = [_field(f, 0, True).try_cast("bigint"), java_split(_field(f, 2, True))]
    elif kind in ("ratings", "deltas"):
        f = java_split(_strip_quotes(F.col("value")))
        shift = kind == "deltas"
        needed = [_field(f, 0, True).try_cast("bigint"), _field(f, 1, True).try_cast("bigint"),
                  _field(f, 2 + shift, True).try_cast("double"), _field(f, 3 + shift, True).try_cast("bigint")]
    else:
        raise ValueError(f"unknown kind of lines: {kind}")
    bad = F.lit(False)
    for c in needed:
        bad = bad | c.isNull()
    return lines.where(bad).select(F.col("value").alias("line"))


# Columns that a line of each kind must have.
_NEEDED = {"items": ["item_id", "tags"], "ratings": ["user_id", "item_id", "rating", "ts"], "deltas": ["user_id", "item_id", "rating", "ts"]}


@dataclass
class Diverted:
    """What ``divert_lines`` has stored: the parsed rows, the rejected lines (line) and how many lines
    there were of each."""

    rows: DataFrame
    rejected: DataFrame
    n_lines: int
    n_rejected: int


def divert_lines(spark: SparkSession, path: str, kind: str, out: str | None = None) -> Diverted:
    """Parse the lines of a kind (``items``, ``ratings`` or ``deltas``) once, and store rows and rejected
    lines side by side under ``out`` in one job, which counts both on the way."""
    if kind not in _NEEDED:
        raise ValueError(f"unknown kind of lines: {kind}")
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    value = _strip_quotes(F.col("line"))
    if kind == "items":
        f = F.split(value, _PIPE, 3)
        parsed = lines.select("line", _field(f, 0, True).try_cast("bigint").alias("item_id"), _field(f, 1, True).alias("title"),
                              java_split(_field(f, 2, True)).alias("tags"))
    else:
        split = lines.select("line", java_split(value).alias("f"))
        shift = int(kind == "deltas")
        old = _field(F.col("f"), 2, True).try_cast("double")
        old = F.when(old >= 0, old) if shift else F.lit(None).cast("double")
        numbers = [("user_id", 0, "bigint"), ("item_id", 1, "bigint"), ("rating", 2 + shift, "double"), ("ts", 3 + shift, "bigint")]
        casts = {c: _field(F.col("f"), i, True).try_cast(t).alias(c) for c, i, t in numbers}
        parsed = split.select("line", casts["user_id"], casts["item_id"], old.alias("old_rating"), casts["rating"], casts["ts"])
    bad = F.lit(False)
    for c in _NEEDED[kind]:
        bad = bad | F.col(c).isNull()
    seen = Observation()
    columns = [c for c in parsed.columns if c != "line"]
    marked = (parsed.withColumn("rejected", bad).observe(seen, F.count(F.lit(1)).alias("n_lines"), F.count_if("rejected").alias("n_rejected"))
              .select(*columns, F.when(F.col("rejected"), F.col("line")).alias("line"), "rejected"))
    out = out or scratch_path(spark, f"diverted-{kind}")
    marked.write.partitionBy("rejected").parquet(out)
    stored = spark.read.schema(marked.schema).parquet(out)
    counts = seen.get
    return Diverted(stored.where("not rejected").select(*columns), stored.where("rejected").select("line"), counts["n_lines"], counts["n_rejected"])


def items_lines(items: DataFrame) -> DataFrame:
    return items.select(F.concat(
        F.col("item_id").cast("string"), F.lit('|"'), F.col("title"), F.lit('"|"'),
        F.array_join(F.col("tags"), "|"), F.lit('"')).alias("value"))


def ratings_lines(ratings: DataFrame, damaged: Column | None = None) -> DataFrame:
    """Lines of the ratings; those that ``damaged`` selects have no number for a rating."""
    rating = F.col("rating").cast("string")
    if damaged is not None:
        rating = F.when(damaged, F.lit("?")).otherwise(rating)
    return ratings.select(F.concat_ws(
        "|", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
        rating, F.col("ts").cast("string")).alias("value"))


def deltas_lines(deltas: DataFrame) -> DataFrame:
    return deltas.select(F.concat_ws(
        "|", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
        F.coalesce(F.col("old_rating"), F.lit(-1.0)).cast("string"),
        F.col("rating").cast("string"), F.col("ts").cast("string")).alias("value"))


def write_items_text(items: DataFrame, path: str) -> None:
    items_lines(items).write.mode("errorifexists").text(path)


def write_ratings_text(ratings: DataFrame, path: str) -> None:
    ratings_lines(ratings).write.mode("errorifexists").text(path)


def write_deltas_text(deltas: DataFrame, path: str) -> None:
    deltas_lines(deltas).write.mode("errorifexists").text(path)
