"""MinHash signatures of tag lists as native Spark expressions.

The per-tag hash is Java's ``String.hashCode`` of ``tag + str(seed)`` followed by a
fixed mix of two 32-bit wrapping multiplies and arithmetic right shifts, then ``abs``.

The expression is written once as Spark SQL text and handed to ``F.expr``: one parse
on the JVM instead of hundreds of py4j calls to assemble the tree node by node, which
keeps plan construction fast even when a plan hashes tags in several places.
Arithmetic runs in ``bigint``; a 32-bit wrap is ``shiftright(shiftleft(x, 32), 32)``
(bit operations never raise under ANSI), and UTF-16 code units come from
``hex(encode(s, 'UTF-16BE'))``, so characters beyond the BMP hash as surrogate pairs
exactly as in Java.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original signature function for identical buckets:
#   multiply by 0xcc9e2d51, arithmetic shift right by 15,
#   multiply by 0x1b873593, arithmetic shift right by 13, absolute value.
MIX_MULTIPLIER_1 = 0xCC9E2D51
MIX_SHIFT_1 = 15
MIX_MULTIPLIER_2 = 0x1B873593
MIX_SHIFT_2 = 13
# Seeds used by the recommender's index.
DEFAULT_SEEDS = (5, 16)

_TWO31 = 1 << 31
_TWO32 = 1 << 32


def _as_int32_constant(v: int) -> int:
    return v - _TWO32 if v >= _TWO31 else v


def _wrap(x: str) -> str:
    """SQL: the signed 32-bit value with the low 32 bits of bigint ``x``."""
    return f"shiftright(shiftleft({x}, 32), 32)"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def java_string_hash_sql(s: str) -> str:
    """SQL for Java ``String.hashCode`` of the string expression ``s`` (as bigint)."""
    units = (f"transform(regexp_extract_all(hex(encode({s}, 'UTF-16BE')), '(.{{4}})', 1), "
             f"u -> cast(conv(u, 16, 10) as bigint))")
    return f"aggregate({units}, 0L, (h, u) -> {_wrap('h * 31 + u')})"


def _java_hash(s: str) -> int:
    h = 0
    for c in s:
        h = (h * 31 + ord(c)) & 0xFFFFFFFF
    return h


def seeded_sql(h: str, seed: int) -> str:
    """SQL for the value of a tag under one seed, from the tag's own string hash ``h`` (bigint);
    int in [0, 2^18). The hash of a string with a suffix is h * 31^length + hash(suffix)."""
    suffix = str(int(seed))
    k = _wrap(f"({h}) * {pow(31, len(suffix), 1 << 32)} + {_java_hash(suffix)}")
    k = _wrap(f"({k}) * ({_as_int32_constant(MIX_MULTIPLIER_1)})")
    k = f"shiftright({k}, {MIX_SHIFT_1})"
    k = _wrap(f"({k}) * ({_as_int32_constant(MIX_MULTIPLIER_2)})")
    k = f"shiftright({k}, {MIX_SHIFT_2})"
    return f"cast(abs({k}) as int)"


def java_string_hash(col: str) -> Column:
    return F.expr(_wrap(java_string_hash_sql(_quote(col)))).cast("int")


def minhash_seed(col: str, seed: int) -> Column:
    """Hash of the string column ``col`` under one seed."""
    return F.expr(seeded_sql(java_string_hash_sql(_quote(col)), seed))


def tag_hash_array(tags: str) -> Column:
    """The string hashes of a tag list, which all seeds share."""
    return F.expr(f"transform({_quote(tags)}, t -> {java_string_hash_sql('t')})")


def minhash(hashes: str, seed: int) -> Column:
    """Minimum value of a tag list under a seed, from its ``tag_hash_array`` column; NULL for
    an empty or NULL list."""
    return F.expr(f"array_min(transform({_quote(hashes)}, h -> {seeded_sql('h', seed)}))")


def signature_columns(hashes: str, seeds: Sequence[int] = DEFAULT_SEEDS,
                      prefix: str = "sig_") -> list[Column]:
    """One int column per seed (``sig_0``, ``sig_1``, ...): flat equi-join keys."""
    return [minhash(hashes, s).alias(f"{prefix}{i}") for i, s in enumerate(seeds)]


def signature_names(seeds: Sequence[int] = DEFAULT_SEEDS, prefix: str = "sig_") -> list[str]:
    return [f"{prefix}{i}" for i in range(len(seeds))]
