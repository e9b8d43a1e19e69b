"""Raw layer: JSON lines in, ``(event_id, payload, ingested_at, ...)`` out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.functions.scalar import clock
from tripfunnel.session import remove_folder
from tripfunnel.sources.id_index import IdIndex

LINE_SCHEMA = T.StructType(
    [T.StructField("line", T.StringType()), T.StructField("source_file", T.StringType())]
)


def read_jsonl(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """One row per non-blank line with the file it came from.

    A path that does not exist gives zero rows unless ``missing_ok`` is off.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LINE_SCHEMA)
        raise
    return lines.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file")
    ).filter(F.trim("line") != "")


def is_json_object(line: Column) -> Column:
    """True for a line that is one JSON object and nothing else, in strict JSON.

    Parsers stop at the end of the first value. So the line is parsed once, as the first element of an
    array whose second is the line's own hash: text after the object would push that out of its place.
    """
    seal = F.xxhash64(line)
    parsed = F.try_parse_json(F.concat(F.lit("["), line, F.lit(","), seal.cast("string"), F.lit("]")))
    whole = F.try_variant_get(parsed, "$[1]", "bigint") == seal
    return F.coalesce(F.ltrim(line).startswith("{") & whole, F.lit(False))


def fault(line: Column, event_id: Column) -> Column:
    """Why a line is no event, or null: the one rule of loading, ingest, staging and streams."""
    return F.when(~is_json_object(line), "malformed_json").when(
        F.coalesce(event_id, F.lit("")) == "", "missing_event_id"
    )


def to_raw(lines: DataFrame, as_of=None, batch_id: str | None = None) -> DataFrame:
    """Keep the text as it came and lift only the id out of it."""
    return lines.select(
        F.get_json_object("line", "$.event_id").alias("event_id"),
        F.col("line").alias("payload"),
        clock(as_of).alias("ingested_at"),
        F.col("source_file") if "source_file" in lines.columns
        else F.lit(None).cast("string").alias("source_file"),
        F.lit(batch_id).cast("string").alias("batch_id"),
    )


def load_raw(
    spark: SparkSession, path: str, target: str, as_of=None, rejects: str | None = None
) -> DataFrame:
    """Full refresh: the table at ``target`` becomes exactly the events in the files.

    Lines that are no events are stored at ``rejects`` with their reason; without that
    path a single one fails the load before anything is written.
    """
    lines = to_raw(read_jsonl(spark, path), as_of)
    marked = lines.withColumn("reason", fault(F.col("payload"), F.col("event_id")))
    refused = marked.filter(F.col("reason").isNotNull())
    if rejects is not None:
        refused.write.mode("overwrite").parquet(rejects)
    elif bad := refused.select("reason", "source_file").head(1):
        raise ValueError(f"{bad[0]['reason']} in {bad[0]['source_file']}")
    remove_folder(spark, f"{target.rstrip('/')}_ids")  # an index of the ids before
    marked.filter(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


@dataclass
class IngestResult:
    """Outcome of one incremental load; all parts are lazy."""

    parsed: DataFrame
    new_rows: DataFrame
    batch_id: str

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.filter(F.col("reason").isNotNull())

    @property
    def metrics(self) -> DataFrame:
        counted = self.parsed.agg(
            F.count(F.lit(1)).alias("lines_read"),
            F.count_if(F.col("reason") == "malformed_json").alias("malformed"),
            F.count_if(F.col("reason") == "missing_event_id").alias("without_id"),
        )
        known = F.col("lines_read") - F.col("malformed") - F.col("without_id") - F.col("inserted")
        return (
            counted.withColumn("inserted", self.new_rows.agg(F.count(F.lit(1))).scalar())
            .withColumn("already_known", known)
            .withColumn("batch_id", F.lit(self.batch_id))
        )


def ingest_incremental(
    lines: DataFrame,
    existing: DataFrame | IdIndex,
    batch_id: str,
    as_of=None,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> IngestResult:
    """Rows whose ``event_id`` the raw table does not hold yet.

    ``existing`` is a table with the column ``event_id`` or the index of one; against an index nothing
    on the table's side is shuffled, and a batch of few ids reads only the buckets they fall into.
    ``store`` keeps the parsed lines, so that rejects, counts and new rows parse nothing again.

    Lines that are not JSON objects and lines without an id go to ``rejects``.
    Within a batch one line per id is kept, the smallest ``(file, text)``: files
    have no order once they are split over tasks. The rank limit runs before the
    shuffle, so an id repeated in a third of the batch stays cheap.
    """
    parsed = to_raw(lines, as_of, batch_id).withColumn(
        "reason", fault(F.col("payload"), F.col("event_id"))
    )
    if store is not None:
        parsed = store(parsed)
    first = Window.partitionBy("event_id").orderBy(
        F.col("source_file").asc_nulls_last(), F.col("payload").asc_nulls_last()
    )
    valid = parsed.filter(F.col("reason").isNull()).drop("reason")
    once = valid.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1)
    held = existing.among(valid) if isinstance(existing, IdIndex) else existing
    # The batch is small next to the table: looking its ids up first lets Spark
    # scan the table's id column in place instead of shuffling all of it.
    known = held.select("event_id").join(
        valid.select("event_id").distinct(), "event_id", "left_semi"
    )
    return IngestResult(parsed, once.drop("_nth").join(known, "event_id", "left_anti"), batch_id)


def write_raw_by_day(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append to a raw table partitioned by ingest day, so later reads can prune."""
    df.withColumn("ingest_date", F.to_date("ingested_at")).write.mode(mode).partitionBy(
        "ingest_date"
    ).parquet(path)
