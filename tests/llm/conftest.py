from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997} tail{i}" for i in range(40_000))  # about 480,000 characters
PROSE = ("the quick brown fox jumps over the lazy dog near the old river bank while seven grey geese "
         "watch quietly from the tall reeds and nobody says a word about the weather that morning")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, PROSE, "en", "a", len(PROSE)), (2, PROSE, "en", "a", len(PROSE)),
        (3, PROSE.replace("lazy", "tired"), "en", None, None), (4, None, None, None, None),
        (5, "", "en", "b", 0), (6, "   \n\t ", "en", "b", 6), (None, "a text without an id", "en", "b", 20),
        (None, None, None, None, None), (7, LONG, "en", "c", len(LONG)), (8, "one", "en", "c", 3),
        (9, "repeated row of this very small table\nMIT", "en", "c", 41),
        (9, "repeated row of this very small table\nMIT", "en", "c", 41),
        (10, "漢字 and 𝒳 with ▁ marks here <|endoftext|> it's", "xx", "c", 30),
        (11, "Released under the MIT License.\nAll rights reserved.", "en", "c", 50),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache()


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns whose names operators might use themselves."""
    extra = ["k", "t", "key", "node", "h", "first", "gone", "whole", "kept_node", "node_id", "n_rows", "words", "leader", "y", "block",
             "piece_ids_", "start", "rank", "score_"]
    return odd_docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in extra])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
