"""The ids a raw table holds, in buckets, so that a batch is compared with them where they lie."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.session import file_count, folder_names, has_file, make_folder, remove_folder

#: Batches of at most this many ids are looked up by value; their buckets alone are read.
FEW = 1000


class IdIndex:
    """Ids below ``path``, hashed into buckets and sorted; one writer at a time.

    A join on the id needs no exchange on this side, however large the table. A generation is a
    folder ``<number>-<buckets>``; it counts once Spark has marked it complete. Buckets grow in number
    when they would hold more than ``ids_per_bucket``, and a generation of more than ``most_files``
    files a bucket is merged into a new one.

    ``adding`` leaves a mark while raw rows and ids are being written. If a run dies between the two,
    the mark stays, ``whole`` is false, and the next run rebuilds the index from the raw table.
    Null ids are not kept. An index without ids answers with no rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, ids_per_bucket: int = 2_000_000, most_files: int = 50
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.ids_per_bucket, self.most_files = ids_per_bucket, most_files

    def _generations(self) -> list[str]:
        complete = [
            name for name in folder_names(self.spark, self.path)
            if "-" in name and has_file(self.spark, f"{self.path}/{name}/_SUCCESS")
        ]
        return sorted(complete, key=lambda name: int(name.split("-")[0]))

    def _table(self, generation: str) -> str:
        """The session's name for a generation; the definition lies over files that may exist already."""
        folder = f"{self.path}/{generation}"
        name = f"ids_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
        self.spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {name} (event_id STRING) USING parquet
            CLUSTERED BY (event_id) SORTED BY (event_id) INTO {generation.split('-')[1]} BUCKETS
            LOCATION '{folder}'"""
        )
        self.spark.catalog.refreshTable(name)
        return name

    def _append(self, ids: DataFrame, generation: str) -> None:
        buckets = int(generation.split("-")[1])
        ids.select("event_id").repartition(buckets, "event_id").write.insertInto(self._table(generation))

    def whole(self) -> bool:
        """Whether the index exists and no run died while adding to it."""
        return bool(self._generations()) and "open" not in folder_names(self.spark, self.path)

    def rebuild(self, ids: DataFrame) -> None:
        """The index of exactly these ids, as a new generation; earlier ones go afterwards."""
        ids = ids.select("event_id").filter(F.col("event_id").isNotNull())
        earlier = folder_names(self.spark, self.path)
        last = max((int(name.split("-")[0]) for name in earlier if "-" in name), default=0)
        buckets = max(8, 1 << (ids.count() // self.ids_per_bucket).bit_length())
        self._append(ids.distinct(), f"{last + 1}-{buckets}")
        for name in earlier:
            remove_folder(self.spark, f"{self.path}/{name}")

    def ids(self) -> DataFrame:
        generations = self._generations()
        if not generations:
            return self.spark.createDataFrame([], "event_id string")
        return self.spark.table(self._table(generations[-1]))

    def among(self, batch: DataFrame) -> DataFrame:
        """The ids that may be in ``batch``: for a small one by value, so that only the buckets and row
        groups that can hold them are read; for a larger one all, to be joined in place.
        """
        some = batch.select("event_id").filter(F.col("event_id").isNotNull()).distinct().limit(FEW + 1).collect()
        if len(some) > FEW:
            return self.ids()
        return self.ids().filter(F.col("event_id").isin([row["event_id"] for row in some]))

    @contextmanager
    def adding(self, ids: DataFrame) -> Iterator[None]:
        """Around the write of the raw rows with these new ids (a stored table, read once more here)."""
        make_folder(self.spark, f"{self.path}/open")
        yield
        generation = self._generations()[-1]
        self._append(ids, generation)
        buckets = int(generation.split("-")[1])
        crowded = self.ids().count() > 2 * buckets * self.ids_per_bucket
        if crowded or file_count(self.spark, f"{self.path}/{generation}") > self.most_files * buckets:
            self.rebuild(self.ids())
        remove_folder(self.spark, f"{self.path}/open")
