"""Late rows kept for inspection.

Stateful operators drop rows behind the watermark and only count them. Here a stream is split before them:
rows in time go to one table, on which the stateful streams run, and late rows to another, with the mark
they missed. The mark is the one by which Spark itself tells late rows: the newest event time of all
micro-batches before the last one (a batch's own successor still accepts what it accepted, so that chained
operators agree), less the lateness allowed. It is stored per micro-batch in the shared folder, so a batch
that is run again is split by the same mark and replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripfunnel.session import folder_names, remove_folder
from tripfunnel.streaming.events import LATE, merge_stream

_MARK = "newest_ms long"


def newest_of(spark: SparkSession, marks: str, before: int) -> int | None:
    """Milliseconds of the newest event of the batches before ``before``; None if there are none."""
    known = sorted(int(n.split("=")[1]) for n in folder_names(spark, marks) if n.startswith("batch="))
    earlier = [n for n in known if n < before]
    for old in earlier[:-10]:
        remove_folder(spark, f"{marks}/batch={old}")
    return spark.read.schema(_MARK).parquet(f"{marks}/batch={earlier[-1]}").first()[0] if earlier else None


def split_late(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, ts: str, late: str) -> None:
    """Writes one micro-batch as ``on_time/batch=n`` and ``late/batch=n`` below ``root``, and its mark."""
    newest = newest_of(spark, f"{root}/marks", batch_id - 1)
    micros = F.unix_micros(ts)
    mark = F.lit(newest).cast("long") * 1000 - F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {late})")
    is_late = F.coalesce(micros <= mark, F.lit(False))  # without a mark or an event time nothing is late
    batch.persist()
    try:
        batch.filter(~is_late).write.mode("overwrite").parquet(f"{root}/on_time/batch={batch_id}")
        missed = batch.filter(is_late).withColumns(
            {"missed_watermark": F.timestamp_micros(mark), "late_by_seconds": (mark - micros) / 1_000_000}
        )
        missed.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
        seen = batch.agg(F.max(F.floor(micros / 1000).cast("long"))).first()[0]
    finally:
        batch.unpersist()
    newest = max((n for n in (newest_of(spark, f"{root}/marks", batch_id), seen) if n is not None), default=None)
    spark.createDataFrame([(newest,)], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")


def split_stream(
    events: DataFrame, root: str, checkpoint: str, ts: str = "event_timestamp", late: str = LATE, every: str | None = None
) -> StreamingQuery:
    """Splits a stream of events into the tables ``on_time`` and ``late`` below ``root``."""
    return merge_stream(
        events, lambda batch, n: split_late(batch.sparkSession, batch, n, root, ts, late), checkpoint, every, mode="append"
    )


def on_time_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows in time as a stream, for stateful operators."""
    return spark.readStream.schema(schema).option("basePath", f"{root}/on_time").parquet(f"{root}/on_time/batch=*")


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All late rows so far: the event, the mark it missed, by how much, and the micro-batch that brought it."""
    kept = T.StructType([
        *schema.fields, T.StructField("missed_watermark", T.TimestampType()), T.StructField("late_by_seconds", T.DoubleType()),
        T.StructField("batch", T.LongType()),
    ])
    return spark.read.schema(kept).parquet(f"{root}/late")
