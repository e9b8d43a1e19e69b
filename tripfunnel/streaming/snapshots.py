"""Snapshot tables that streams upsert into, bucketed by key and copied on write.

A snapshot has one row per key. Its rows lie in ``buckets`` by hash of the key; a bucket is a folder below
the version that wrote it last, and a small pointer table per version says which version every bucket has.
A batch rewrites the buckets it touches and no others, then writes its pointers, which makes it visible as
a whole. A batch that is run again starts from the pointers before it, so it never reads its own rows.

Versions that neither the newest pointers nor the ones before them name are removed, the latter for readers
that started earlier.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.session import folder_names, remove_folder

_POINTERS = "bucket int, version long, rows long"


@dataclass(frozen=True)
class Snapshot:
    """A snapshot below ``root`` with one row per ``key``; the number of buckets must not change."""

    spark: SparkSession
    root: str
    schema: str
    key: str = "user_id"
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _versions(self, table: str) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in folder_names(self.spark, f"{self.root}/{table}") if name.startswith("version="))

    def _pointers(self, before: int | None = None) -> dict[int, tuple[int, int]]:
        """Version and rows of every bucket, as the newest pointers (of versions below ``before``) have it."""
        known = [v for v in self._versions("pointers") if before is None or v < before]
        if not known:
            return {}
        stored = self.spark.read.schema(_POINTERS).parquet(f"{self.root}/pointers/version={known[-1]}")
        return {r["bucket"]: (r["version"], r["rows"]) for r in stored.collect()}  # one row per bucket

    def _read(self, pointers: dict[int, tuple[int, int]]) -> DataFrame:
        paths = [f"{self.root}/data/version={v}/bucket={b}" for b, (v, rows) in pointers.items() if rows]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def latest(self) -> DataFrame:
        """The newest snapshot."""
        return self._read(self._pointers())

    def upsert(self, merge: Callable[[DataFrame, DataFrame], DataFrame], batch: DataFrame, version: int) -> list[int]:
        """Replaces the buckets that ``batch`` touches by ``merge(their rows, batch)``; returns these buckets.

        ``merge`` gets all rows of the touched buckets and must give back those it does not change, too.
        """
        before = self._pointers(version)
        touched = [r[0] for r in batch.select(self._bucket().alias("bucket")).distinct().collect()]  # at most ``buckets``
        current = self._read({b: p for b, p in before.items() if b in touched})
        merged = merge(current, batch).withColumn("bucket", self._bucket())
        path = f"{self.root}/data/version={version}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = {}
        if touched:
            counted = self.spark.read.schema(f"{self.schema}, bucket int").parquet(path).groupBy("bucket").count()
            written = {r["bucket"]: r["count"] for r in counted.collect()}
        after = {**before, **{b: (version, written.get(b, 0)) for b in touched}}
        rows = [(b, v, n) for b, (v, n) in sorted(after.items())]
        pointers = self.spark.createDataFrame(rows, _POINTERS).coalesce(1)
        pointers.write.mode("overwrite").parquet(f"{self.root}/pointers/version={version}")
        self._clean(version, before, after)
        return sorted(touched)

    def _clean(self, version: int, *named: dict[int, tuple[int, int]]) -> None:
        """Removes what the newest pointers and those before them do not name."""
        used = {(v, b) for pointers in named for b, (v, _) in pointers.items()}
        for v in self._versions("data"):
            if v > version:
                continue
            path = f"{self.root}/data/version={v}"
            if not any(u == v for u, _ in used):
                remove_folder(self.spark, path)
                continue
            for name in folder_names(self.spark, path):
                if name.startswith("bucket=") and (v, int(name.split("=")[1])) not in used:
                    remove_folder(self.spark, f"{path}/{name}")
        for v in [v for v in self._versions("pointers") if v <= version][:-2]:
            remove_folder(self.spark, f"{self.root}/pointers/version={v}")

    def merging(self, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that upserts every micro-batch."""

        def apply(batch: DataFrame, batch_id: int) -> None:
            batch.persist()  # read for its buckets and for the merge
            try:
                self.upsert(merge, batch, batch_id)
            finally:
                batch.unpersist()

        return apply
