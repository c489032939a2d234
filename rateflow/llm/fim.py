"""Fill-in-middle transformation by repeated-capture matching.

A text is matched once by ``(unit)*`` with the regex library, which keeps every repetition
of a capture group: ``match.ends(1)`` holds the end of each unit, so its length is the number
of units and the two cut offsets are looked up in it. The default unit is one code point.
Which units are cut, and the form of the output, follow from a hash of doc_id, so a retried
task or another partitioning gives the same rows. No row is shuffled.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle,
``plain`` the text itself. A text that holds a marker stays plain, so the markers of the
other forms are the only ones in them and ``restored`` is exact.

Defined cases: null texts are empty and plain; a null doc_id hashes as no digits; a text that
the units don't cover from end to end is plain with n = 0; repeated rows get equal results.
Extra columns are ignored. Very long texts: a task needs about 60 bytes for each unit of its
longest single text, as the match keeps all captures; texts are matched one at a time and
passed on in slices of about SLICE_CHARS.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = r"(?s:.)"
# Fixed values of the contract: shares in percent, and the markers.
TRANSFORMED = 90
SPM_SHARE = 20
P, S, M = "<P>", "<S>", "<M>"
SLICE_CHARS = 1 << 20


def _numbers(doc_id: Column) -> list[Column]:
    """The first four 8-digit groups of the hash of a document's id, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _transform(unit: str, transformed: int, spm_share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            begin, size = 0, 0
            rows: list[tuple] = []
            numbers = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            for i, (text, (h1, h2, h3, h4)) in enumerate(zip(batch.column(1), numbers)):
                text = text.as_py() or ""
                match = units.fullmatch(text)
                ends = match.ends(1) if match else []
                n = len(ends)
                if not n or h3 % 100 >= transformed or P in text or S in text or M in text:
                    rows.append((n, "plain", None, None, text))
                else:
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = ends[low - 1] if low else 0, ends[high - 1] if high else 0
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    if h4 % 100 < spm_share:
                        rows.append((n, "spm", a, b - a, f"{S}{suffix}{P}{prefix}{M}{middle}"))
                    else:
                        rows.append((n, "psm", a, b - a, f"{P}{prefix}{S}{suffix}{M}{middle}"))
                size += len(text)
                if size >= SLICE_CHARS or i + 1 == batch.num_rows:
                    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), *arrays], names=names)
                    begin, size, rows = i + 1, 0, []
    return run


def transform(docs: DataFrame, unit: str = CODE_POINT, transformed: int = TRANSFORMED, spm_share: int = SPM_SHARE) -> DataFrame:
    """One row per document row: doc_id, n (units), form, prefix_chars, middle_chars (code points;
    null if plain) and output. ``unit`` is a regex without groups of its own that matches no
    empty text; ``transformed`` and ``spm_share`` are percentages."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"), *_numbers(F.col("doc_id")))
            .mapInArrow(_transform(unit, transformed, spm_share),
                        f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"))


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed one was made from."""
    # Markers can't overlap, and no piece holds one: there are four parts, the first empty.
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(output))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query, from those of transform()."""
    return result.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
