"""Small document tables and what all operators have to stand."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); with a column that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in ("row_key", "kept", "n", "ord", "spans", "row", "h"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
