"""Line de-duplication: long lines of many documents stay only in the document with the largest id.

Lines meet as hashes. Every document gives one record per distinct long line: 128 bits of hash of the
line's key, the document's id, and the positions it stands at. The records are range-partitioned by hash
and document, and sorted by them inside each partition, largest document first, so that a task streams
over them with a few rows of state: the first document of a hash keeps its lines; from the moment that
enough documents have passed, the others lose theirs.

A hash may reach over the ends of partitions (a line may be in a third of all documents; its records
then fill many partitions and are never held together). The records of a partition's first hash, and
those of its last hash that are still undecided, stay open, and the partition says which documents it saw
for either, the first ``least_documents`` of them: two short lists a partition settle the open records.

What comes back per document is its keep bitmap, packed and compressed; texts are not shuffled for it.
``apply`` lays the bitmaps over the documents.

Defined cases: a null or empty text is one empty line, which is never dropped. Rows with one id are one
document, so they lose or keep a line together, and an equal id and text has an equal bitmap. A row
without an id belongs to one nameless document that comes after all others. A line repeated inside its
document counts once and goes or stays with all its copies. An empty table gives an empty result; all
columns of the documents pass through ``apply``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import free_name, map_batches, stored

#: Characters taken off both ends of a line; bytes.lower() lowers A-Z alone.
BLANK = b" \t\n\x0b\x0c\r"
#: Bytes of a text whose lines are looked at together.
PIECE = 1 << 20


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces that end at line ends; the newlines between the pieces are left out."""
    start = 0
    while len(text) - start > PIECE:
        end = text.rfind(b"\n", start, start + PIECE)
        if end < 0:
            end = text.find(b"\n", start + PIECE)
            if end < 0:
                break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def points(text: bytes) -> int:
    """Code points of UTF-8."""
    return len(text) if text.isascii() else len(text.decode("utf-8", "surrogatepass"))


def long_lines(text: bytes, least: int) -> Iterator[dict[bytes, list[int]]]:
    """For each piece of a text: the digest of every long line's key, and the line numbers that hold it."""
    number = 0
    for piece in pieces(text):
        found: dict[bytes, list[int]] = defaultdict(list)
        for number, line in enumerate(piece.split(b"\n"), number):
            if len(line) >= least:
                key = line.strip(BLANK).lower()
                if len(key) >= least and points(key) >= least:
                    found[xxhash.xxh3_128_digest(key)].append(number)
        number += 1
        yield found


def _records(least: int, id_type: pa.DataType, remembered: int = 500_000):
    """One row per document, piece and distinct long line. Equal documents of a task are looked at once."""
    kinds = {"hash": pa.binary(), "doc": id_type, "u1": pa.int64(), "u2": pa.int64(), "lines": pa.list_(pa.int32())}

    def run(batches):
        done: set = set()
        rows: list[tuple] = []

        def made():
            columns = zip(*rows) if rows else [[]] * len(kinds)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))
            rows.clear()
            return batch

        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                unit = at["u1"][i].as_py(), at["u2"][i].as_py()
                if unit in done:
                    continue
                if len(done) >= remembered:
                    done.clear()
                done.add(unit)
                doc = at["doc"][i].as_py()
                for found in long_lines(at["text"][i].as_py(), least):
                    rows.extend((h, doc, *unit, lines) for h, lines in found.items())
                    if len(rows) > 20_000:
                        yield made()
        yield made()

    return run


def changes(column: pa.Array) -> np.ndarray:
    """For all rows but the first, whether the value differs from the row before; nulls are alike."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.fill_null(pc.equal(before, after), False)
    both_null = pc.and_(pc.is_null(before), pc.is_null(after))
    return ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)


class Stream:
    """Follows the records of one partition, sorted by hash and, within it, from the largest document down."""

    def __init__(self, least: int):
        self.least = least
        self.first = True  # still in the first hash of the partition
        self.held: list[pa.RecordBatch] = []  # undecided records of the hash at the end of what was read

    def feed(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """Decided records as ``drop``, records of the first hash as ``open``, its documents as ``seen``."""
        batch = pa.Table.from_batches([*self.held, batch]).combine_chunks().to_batches()[0]
        self.held = []
        n = batch.num_rows
        new_hash = np.concatenate([[True], changes(batch.column(0))])
        new_doc = new_hash | np.concatenate([[True], changes(batch.column(1))])
        group = np.cumsum(new_hash) - 1
        starts = np.flatnonzero(new_hash)
        nth = np.cumsum(new_doc) - np.cumsum(new_doc)[starts][group]  # of the document within its hash, from 0
        documents = np.bincount(group, weights=new_doc).astype(np.int64)
        last = group == group[-1]
        if self.first:
            head = group == 0
            if len(starts) == 1:
                # One hash so far: carry the documents that count and one row, let the other records go.
                keep = new_doc & (nth < self.least)
                yield "open", batch.filter(pa.array(self._fresh(n)))
                self.held, self.carried = [batch.filter(pa.array(keep))], int(keep.sum())
                return
            yield "open", batch.filter(pa.array(head & self._fresh(n)))
            yield "seen", batch.filter(pa.array(head & new_doc & (nth < self.least)))
            self.first = False
            decided = ~head
        else:
            # What was carried of an already decided hash has been given out before.
            decided = self._fresh(n)
        enough = documents[group] >= self.least
        yield "drop", batch.filter(pa.array(decided & enough & (nth > 0)))
        if documents[-1] >= self.least:
            keep = last & new_doc & (nth < self.least)
            self.held, self.carried = [batch.filter(pa.array(keep))], int(keep.sum())
        else:
            self.held, self.carried = [batch.filter(pa.array(last))], 0

    carried = 0

    def _fresh(self, n: int) -> np.ndarray:
        return np.arange(n) >= self.carried

    def end(self) -> Iterator[tuple[str, pa.RecordBatch]]:
        """The partition's last hash: its documents, and its records if too few documents have been seen."""
        for batch in self.held:
            if batch.num_rows:
                if not self.first and not self.carried:
                    yield "open", batch
                new_doc = np.concatenate([[True], changes(batch.column(1))])
                yield "seen", batch.filter(pa.array(new_doc & (np.cumsum(new_doc) <= self.least)))


def _streamed(least_documents: int):
    def run(batches):
        stream = Stream(least_documents)

        def tagged(parts):
            for kind, part in parts:
                if part.num_rows:
                    if kind == "seen":  # no more than the hash and the document
                        empty = pa.nulls(part.num_rows, part.schema.field("lines").type)
                        part = part.set_column(part.schema.get_field_index("lines"), "lines", empty)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([kind] * part.num_rows)], names=[*part.schema.names, "kind"])

        for batch in batches:
            if batch.num_rows:
                yield from tagged(stream.feed(batch))
        yield from tagged(stream.end())

    return run


def _pack(batches):
    """The positions of each unit as a compressed bitmap: bit 1 keeps a line, lines behind its end are kept."""
    for batch in batches:
        lines = batch.column(batch.schema.get_field_index("lines"))
        packed = []
        for i in range(batch.num_rows):
            dropped = lines[i].values.to_numpy()
            keep = np.ones((int(dropped.max()) // 8 + 1) * 8, dtype=bool)
            keep[dropped] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("u1", "u2")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=["u1", "u2", "keep"])


def unpack(keep: bytes) -> np.ndarray:
    """The bitmap as booleans; it may go on a little behind the last line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8)).astype(bool)


def _named(docs: DataFrame, text: str, id_column: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column: two hashes of id and text, equal for equal documents."""
    name = free_name(docs, "unit")
    pair = [F.xxhash64(F.lit(salt), F.col(id_column), F.col(text)) for salt in (1, 2)]
    return docs.withColumn(name, F.struct(pair[0].alias("u1"), pair[1].alias("u2"))), name


def bitmaps(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", least_points: int = 40, least_documents: int = 5
) -> DataFrame:
    """``u1``, ``u2`` and the compressed bitmap ``keep`` of every document that loses a line."""
    named, unit = _named(docs.select(id_column, text), text, id_column)
    id_field = T.StructField("doc", docs.schema[id_column].dataType)
    schema = T.StructType([
        T.StructField("hash", T.BinaryType()), id_field, T.StructField("u1", T.LongType()), T.StructField("u2", T.LongType()),
        T.StructField("lines", T.ArrayType(T.IntegerType())),
    ])
    from pyspark.sql.pandas.types import to_arrow_type

    read = named.filter(F.octet_length(text) >= least_points).select(
        F.col(id_column).alias("doc"), F.col(text).cast("binary").alias("text"), f"{unit}.*"
    )
    records = stored(map_batches(read, _records(least_points, to_arrow_type(id_field.dataType)), schema), "lines")
    order = [F.col("hash"), F.col("doc").desc_nulls_last(), F.col("u1"), F.col("u2")]
    streamed = stored(
        records.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _streamed(least_documents), T.StructType([*schema.fields, T.StructField("kind", T.StringType())])
        ),
        "streamed",
    )
    # At most ``least_documents`` documents of two hashes from each partition.
    seen = streamed.filter("kind = 'seen'").select("hash", "doc").distinct().groupBy("hash").agg(
        F.count("*").alias("documents"), F.max("doc").alias("largest")
    )
    decided = seen.filter(F.col("documents") >= least_documents).drop("documents")
    # The documents of a hash in several partitions are known in full only here, so its largest is, too.
    loses = (
        streamed.filter("kind = 'open'")
        .join(F.broadcast(decided), "hash")
        .filter(~F.col("doc").eqNullSafe(F.col("largest")))
        .select("u1", "u2", "hash", "lines")
    )
    dropped = streamed.filter("kind = 'drop'").select("u1", "u2", "hash", "lines").unionByName(loses)
    # Copies of a document repeat its records; they are combined before they are gathered.
    once = dropped.select("u1", "u2", F.explode("lines").alias("line")).groupBy("u1", "u2", "line").agg(F.lit(1).alias("one"))
    gathered = once.groupBy("u1", "u2").agg(F.collect_list("line").alias("lines"))
    return map_batches(gathered, _pack, "u1 long, u2 long, keep binary")


def kept_text(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text, the number of its lines, and how many are dropped."""
    lines = text.count(b"\n") + 1
    if keep is None:
        return text, lines, 0
    flags = unpack(keep)
    out, at = [], 0
    for piece in pieces(text):
        part = piece.split(b"\n")
        here = flags[at : at + len(part)]
        at += len(part)
        out.extend(line for line, k in zip(part, here.tolist()) if k)
        out.extend(part[len(here) :])
    return b"\n".join(out), lines, lines - len(out)


def _laid(as_digest: bool):
    def run(batches):
        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(part.schema.get_field_index("__text"))
                keeps = part.column(part.schema.get_field_index("__keep"))
                rows = []
                for i in range(part.num_rows):
                    left, lines, gone = kept_text(texts[i].as_py() or b"", keeps[i].as_py())
                    rows.append((hashlib.sha256(left).hexdigest() if as_digest else left.decode("utf-8", "replace"), lines, gone))
                others = [n for n in at if n not in ("__text", "__keep")]
                made = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(n)) for n in others]
                    + [pa.array(c, t) for c, t in zip(made, (pa.string(), pa.int64(), pa.int64()))],
                    names=[*others, "__made", "__lines", "__dropped"],
                )

    return run


def _with_bitmaps(docs: DataFrame, text: str, id_column: str, as_digest: bool, **options) -> DataFrame:
    """Columns of ``docs`` numbered ``c0`` and so on, then ``__made``, ``__lines``, ``__dropped``."""
    named, unit = _named(docs, text, id_column)
    found = bitmaps(docs, text, id_column, **options)
    found = stored(found.withColumnRenamed("keep", "__keep"), "bitmaps")
    numbered = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    body = named.select(*numbered, f"{unit}.*", F.col(f"`{text}`").cast("binary").alias("__text"))
    met = body.join(found, ["u1", "u2"], "left").drop("u1", "u2")
    schema = T.StructType([
        *met.drop("__text", "__keep").schema.fields, T.StructField("__made", T.StringType()),
        T.StructField("__lines", T.LongType()), T.StructField("__dropped", T.LongType()),
    ])
    return met.mapInArrow(_laid(as_digest), schema)


def apply(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the lines dropped from ``text``; a null text stays null. All other columns pass."""
    made = _with_bitmaps(docs, text, id_column, False, **options)
    was_null = F.col(f"c{docs.columns.index(text)}").isNull()
    new = F.when(was_null, None).otherwise(F.col("__made"))
    return made.select(*[(new if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def digests(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_dropped`` and ``kept_sha256`` of what is left."""
    made = _with_bitmaps(docs.select(id_column, text), text, id_column, True, **options)
    return made.select(
        F.col("c0").alias(id_column), F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
        F.col("__made").alias("kept_sha256"),
    )
