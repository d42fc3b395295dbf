"""Rows that every operator must bear: nulls, empty and very long texts, repeats, clashing names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    long_text = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "one two three"),
        (7, long_text), (8, long_text + " tail"), (9, "x" * 50_000),
        (10, "a b c d e f g h\nline two here\nline two here"), (10, "a b c d e f g h\nline two here\nline two here"),
        (11, "other text under a repeated id"), (11, "and one more of it, quite unlike"),
        (None, "a text without an id"), (None, "another text without an id of its own"), (None, None),
    ]
    return frame(spark, rows).withColumns({
        "lang": F.lit("en"), "source": F.when(F.col("doc_id") % 2 == 0, F.lit("s")), "n_chars": F.lit(1).cast("long"),
        # Names that operators use themselves.
        "row": F.lit("row"), "node": F.lit(None).cast("string"), "score": F.lit("score"), "key": F.lit(0),
        "n_dropped": F.lit("n"), "bin_id": F.lit("b"), "_row": F.lit("r"), "_lines": F.lit("l"),
    })
