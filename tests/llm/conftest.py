import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word another third. " * 12000
ODD = [
    (None, "a text without an id that is short", "en", None, None),
    (1, None, "en", "s", 0),
    (2, "", None, "s", 0),
    (3, " \n\t ", "en", "s", 4),
    (4, LONG, "en", "s", len(LONG)),
    (5, "the same row", "en", "s", 12),
    (5, "the same row", "en", "s", 12),
    (6, "日本語 ▁ mark \x00 end", "ja", "s", 10),
    (7, "12 34 !! ??", "en", "s", 11),
]
#: Names that operators use for their own columns, and one that only differs in case.
CLASHING = ("score", "verdict", "measures", "kept", "fp", "row", "group", "language", "losses", "size", "shard")


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(n).alias(n) for n in CLASHING])


@pytest.fixture
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
