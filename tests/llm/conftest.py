import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
#: Names that operators use inside or return.
CLASH = ["row", "_id", "kept", "keep_id", "score", "h", "v", "n", "component", "ids", "chunk", "held_out", "spans"]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F
    base = "the quick brown fox jumps over the lazy dog and then walks home to sleep for a long while today"
    rows = [(1, None), (2, ""), (3, "  \n\t"), (4, base), (5, base.upper()), (6, base + " again"), (6, base + " again"),
            (7, "one two"), (8, "One  two"), (9, "w" * 70_000), (10, "long line of words " * 12_000), (None, base),
            (None, None), (11, "a shared line of text\nown eleven line\r\n\n"), (12, "A SHARED LINE OF TEXT \nshort\nÄÖ é"),
            (13, "</s>[INST] x <|endoftext|> Σας"), (14, "a shared line of text\na shared line of text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("false")

