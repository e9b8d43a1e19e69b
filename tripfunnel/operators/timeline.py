"""Per-key timelines that stay parallel when one key owns most of the rows.

A window over ``partitionBy(key)`` puts a hot key into a single task. Here each key
is cut into time buckets: work inside a bucket is spread over the cluster, and only
one summary row per (key, bucket) is ordered per key. A bucket that holds a burst is cut
again, at quantiles of its rows' order, so that no task gets a burst as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfunnel.session import scratch_path

BUCKET = "_bucket"
PART = "_part"
#: Sampled rows that make up one part of a burst.
DRAWS = 32


def _bucket(ts: str, seconds: int) -> Column:
    """Start of the bucket in microseconds."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(seconds * 1_000_000))


def spread_bursts(marked: DataFrame, key: str, ts: str, order: Sequence[str], burst_rows: int) -> DataFrame:
    """Adds ``PART``: 0, or the range of ``(ts, *order)`` that a row of a burst lies in.

    A burst is a key and bucket of more than ``burst_rows`` rows. Its rows are sampled, and every
    ``DRAWS``-th of the sample in order is a cut. Rows of equal order stay in one part; staged events have
    distinct ids. Counting is one pass with a map-side combine. There are at most 10,000 bursts, since the
    limit rises with the rows; their cuts are stored and broadcast.
    """
    counts = marked.filter(F.col(key).isNotNull()).groupBy(key, BUCKET).agg(F.count("*").alias("_n"))
    total, peak = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(burst_rows, (total or 0) // 10_000)
    if not peak or peak <= limit:
        return marked.withColumn(PART, F.lit(0))
    moment = F.struct(F.col(ts), *[F.col(c) for c in order])
    bursts = counts.filter(F.col("_n") > limit).select(key, BUCKET)
    drawn = marked.select(key, BUCKET, moment.alias("_moment")).filter(F.rand(7) < DRAWS / limit)
    cuts = (
        drawn.join(F.broadcast(bursts), [key, BUCKET])
        .groupBy(key, BUCKET)
        .agg(F.sort_array(F.collect_list("_moment")).alias("_cuts"))
        .withColumn("_cuts", F.filter("_cuts", lambda _, i: i % DRAWS == DRAWS - 1))
    )
    path = scratch_path(marked.sparkSession, "cuts")
    cuts.write.parquet(path)  # drawn once: both uses of the timeline must be cut alike
    cuts = marked.sparkSession.read.schema(cuts.schema).parquet(path)
    part = F.size(F.filter("_cuts", lambda cut: cut <= moment))
    return marked.join(F.broadcast(cuts), [key, BUCKET], "left").withColumn(PART, F.greatest(part, F.lit(0))).drop("_cuts")


def sessionize(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    timeout_minutes: int = 30,
    number: str = "session_number",
) -> DataFrame:
    """Adds the running session number per user; a new session starts when the gap
    to the previous event is longer than the timeout. Users without id get null.

    Buckets are as wide as the timeout, so no session can break inside a bucket: the
    whole decision is made on one ``(first, last)`` row per user and bucket.
    """
    gap = timeout_minutes * 60_000_000
    bucketed = events.withColumn(BUCKET, _bucket(ts, timeout_minutes * 60))
    spans = (
        bucketed.filter(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .groupBy(user, BUCKET)
        .agg(
            F.min(F.unix_micros(ts)).alias("_first"),
            F.max(F.unix_micros(ts)).alias("_last"),
        )
    )
    by_user = Window.partitionBy(user).orderBy(BUCKET)
    previous = F.lag("_last").over(by_user)
    opens = F.when(previous.isNull() | (F.col("_first") - previous > gap), 1).otherwise(0)
    numbered = (
        spans.withColumn("_opens", opens)
        .withColumn(
            number,
            F.sum("_opens").over(by_user.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select(user, BUCKET, number)
    )
    return bucketed.join(numbered, [user, BUCKET], "left").drop(BUCKET)


def carry_forward(
    timeline: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str],
    carried: Mapping[str, Column],
    bucket_seconds: int = 300,
    burst_rows: int = 200_000,
) -> DataFrame:
    """Adds, per name, the last non-null value seen so far (own row included) within
    the key, in ``(ts, *order)`` order. Rows without key carry nothing over.
    """
    moment = F.struct(F.col(ts), *[F.col(c) for c in order])
    marked = spread_bursts(timeline.withColumn(BUCKET, _bucket(ts, bucket_seconds)), key, ts, order, burst_rows)
    marked = marked.withColumns({f"_set_{name}": value for name, value in carried.items()})
    in_bucket = (
        Window.partitionBy(key, BUCKET, PART).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy(key).orderBy(BUCKET, PART).rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        marked.filter(F.col(key).isNotNull())
        .groupBy(key, BUCKET, PART)
        .agg(
            *[
                F.max_by(f"_set_{name}", F.when(F.col(f"_set_{name}").isNotNull(), moment)).alias(
                    f"_end_{name}"
                )
                for name in carried
            ]
        )
    )
    starts = ends.select(
        key,
        BUCKET,
        PART,
        *[
            F.last(f"_end_{name}", ignorenulls=True).over(earlier).alias(f"_start_{name}")
            for name in carried
        ],
    )
    local = marked.withColumns(
        {
            f"_set_{name}": F.last(f"_set_{name}", ignorenulls=True).over(in_bucket)
            for name in carried
        }
    )
    return (
        local.join(starts, [key, BUCKET, PART], "left")
        .withColumns(
            {
                name: F.when(
                    F.col(key).isNotNull(), F.coalesce(f"_set_{name}", f"_start_{name}")
                )
                for name in carried
            }
        )
        .drop(BUCKET, PART, *[f"_set_{n}" for n in carried], *[f"_start_{n}" for n in carried])
    )


def running_count(
    timeline: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str],
    counted: Column,
    name: str,
    bucket_seconds: int = 300,
    burst_rows: int = 200_000,
) -> DataFrame:
    """Adds how many rows satisfying ``counted`` the key has had so far."""
    marked = spread_bursts(timeline.withColumn(BUCKET, _bucket(ts, bucket_seconds)), key, ts, order, burst_rows)
    marked = marked.withColumn("_one", F.when(counted, 1).otherwise(0).cast("long"))
    in_bucket = (
        Window.partitionBy(key, BUCKET, PART).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy(key).orderBy(BUCKET, PART).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        marked.filter(F.col(key).isNotNull())
        .groupBy(key, BUCKET, PART)
        .agg(F.sum("_one").alias("_sum"))
        .select(key, BUCKET, PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        marked.withColumn(name, F.sum("_one").over(in_bucket))
        .join(before, [key, BUCKET, PART], "left")
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop(BUCKET, PART, "_one", "_before")
    )
