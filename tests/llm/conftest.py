import pytest
from pyspark.sql import functions as F

#: Null ids and texts, empty and blank texts, ties, repeated rows, very long texts, odd white space, extra columns of clashing names.
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, "The quick brown fox jumps over the lazy dog near the river bank TODAY", "b"),
    (4, "", "b"), (5, None, "b"), (6, " \t\n ", None), (None, "no id here but some words to read", None), (None, None, None),
    (7, "Mail bob.smith@mail.example.com or call +49 170 1234567 now", "c"),
    (8, "Mail bob.smith@mail.example.com, ip 10.0.0.256 and 10.0.0.25, card 4111 1111 1111 1111.", "c"),
    (9, "x" * 150_000, "d"), (10, "long words here " * 8_000, "d"), (11, " " * 70_000 + "end", "d"),
    (12, "\u00e9\u00e0 \U0001F600\u3000 \x1c\u0085 odd\u00a0spaces don't 's 123,456", "\U0001F600"), (13, "one", "z"), (14, "two\nlines", "z"),
    (15, "a\nb\nc\n" * 500, "z"),
]


@pytest.fixture(scope="session")
def llm(spark):
    from kiln.llm.common import ship
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    df = llm.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    clash = ("rows", "spans", "key", "rep", "h", "size", "shard", "arc", "ids", "_m", "start", "score", "n_tokens", "more", "whole")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
