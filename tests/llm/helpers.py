"""Small tables with what every operator has to bear."""

import zlib

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, clashing=True):
    """documents rows; with columns named like the operators' own ones."""
    full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
    df = spark.createDataFrame(full, FIELDS)
    if clashing:
        from pyspark.sql import functions as F

        for c in ("size", "node", "n", "score", "removed", "pattern", "key", "label", "train", "hash", "features", "row"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


AWKWARD = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "Word " * 5000, "b"), (6, "same text here for all of us", "a"), (6, "same text here for all of us", "a"), (None, "no id at all, is it", None)]
