"""Frames that the tests of the training-data operators share."""

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, parts=3):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src0")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(parts)


def awkward(frame):
    """The frame with other columns whose names an operator might use itself."""
    names = "hash cell bucket kept keep_id rank block slot size row task side place shard count".split()
    return frame.withColumns({name: F.lit("x") for name in names})


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)
