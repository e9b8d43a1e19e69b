"""What the training-data operators share: stored tables, Arrow batches, words, samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.session import scratch_path

#: Characters that separate words.
BLANK = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared ``spark.checkpoint.dir`` and read back.

    Cuts the lineage in a way that survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """Arrow batches of ``df`` through ``work``; Spark's partitions stay as they are."""
    return df.mapInArrow(work, schema)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """One output batch from lists or arrays by column name."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def utf8_of(texts: list[str | None]) -> list[bytes]:
    """UTF-8 of each text; null as no bytes."""
    return [b"" if t is None else t.encode() for t in texts]


def spans(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive items of at most ``most`` in sum; a larger item stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def fold(id_column: str, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds``; a null id has fold null."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def held_out(id_column: str, folds: int, out: int) -> Column:
    """Whether a row is held out from fitting. A row without an id cannot be told, so it counts as held out."""
    return F.coalesce(fold(id_column, folds) == out, F.lit(True))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, text: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes of text, so that memory does not grow with long texts."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    for start, end in spans(lengths.to_pylist(), most):
        yield batch.slice(start, end - start)


def annotate(df: DataFrame, text: str, work: Callable[[], Callable], name: str, kind: T.DataType) -> DataFrame:
    """``df`` with one more column; all others pass through. ``work`` gives, once per task, the function
    that turns a list of texts into values.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def run(batches):
        make = work()
        for batch in batches:
            for part in slices(batch, text):
                made = pa.array(make(texts_of(part, text)), type=arrow_type(kind))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])

    return df.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def sample_by_hash(df: DataFrame, id_column: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of the id: the same ones on every run."""
    return df.orderBy(F.xxhash64(F.col(id_column).cast("string")), F.col(id_column)).limit(rows)


def finite_vector(vector: Column) -> Column:
    """Whether the list is there and none of its components is null, NaN or infinite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number), F.lit(False))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
