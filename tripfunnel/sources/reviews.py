"""Labelled review texts as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "text STRING, sentiment STRING"


def read_reviews(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Texts may hold commas, quotes and line breaks."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxCharsPerColumn", -1)
        .csv(path)
    )


def write_reviews(reviews: DataFrame, path: str, file_bytes: int = 64 << 20) -> None:
    """Files of about ``file_bytes``: multi-line CSV cannot be split when read back."""
    length = reviews.agg(F.avg(F.octet_length("text"))).first()[0] or 0
    rows = max(1, int(file_bytes / (length + 16)))
    (
        reviews.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows)
        .csv(path)
    )
