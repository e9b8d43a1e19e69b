"""Line de-duplication against its definition."""

import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripfunnel.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
LOWER = {c: chr(c + 32) for c in range(65, 91)}


def key_of(line):
    return line.strip(BLANK).translate(LOWER)


def direct(rows, least_points=40, least_documents=5):
    """Rows of (id, text) to (id, lines, dropped lines, text left)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_points:
                holders[key_of(line)].add(i)
    rank = lambda i: (i is not None, i)
    owner = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= least_documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if owner.get(key_of(line), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def made(spread=400):
    pick = random.Random(9)
    common = [f"The common line number {n} that many of the documents share" for n in range(40)]
    rows = []
    for i in range(spread):
        lines = [pick.choice(["", "short", "SHORT line", f"a line of its own, no other document has it: {i} {n}"]) for n in range(pick.randrange(9))]
        lines += [pick.choice((str.upper, str.lower, lambda s: f" \t{s}\r\x0b"))(c) for c in common if pick.random() < 0.06]
        if i % 3 == 0:
            lines += ["one line that stands in a third of all documents, twice", "x", "one line that stands in a third of all documents, twice"]
        pick.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    few = "a line of four documents only, which is one too few to drop"
    rows += [(1000 + i, f"{few}\n{few}") for i in range(4)]
    five = "ÄÖÜ ä line of exactly forty points: " + "日本語のé"[:5]
    rows += [(2000 + i, f"\n{five[:40]}") for i in range(5)] + [(3000, five[:39])]
    rows += [(i, None if i % 2 else "") for i in range(4000, 4004)]
    rows += [rows[0]] * 3 + [(3, rows[6][1])]  # equal rows, and an id with two texts
    rows += [(None, rows[0][1]), (None, "one line that stands in a third of all documents, twice\n" * 3)]
    return rows


@pytest.mark.parametrize("partitions", [1, 3, 37])
def test_lines_equal_the_definition(spark, partitions, monkeypatch):
    rows = made()
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = line_dedup.digests(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = [(i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in direct(rows)]
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, expected))
    assert sum(gone for *_, gone, _ in expected) > 500


def test_apply_passes_other_columns(spark, clashing, none):
    line = "the same long line in every one of the documents here"
    docs = clashing.withColumn("text", F.concat_ws("\n", "text", F.lit(line))).withColumn("c0", F.lit("mine")).withColumn("u1", F.lit(1)).withColumn("__text", F.lit(2))
    left = line_dedup.apply(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert [r["doc_id"] for r in left.filter(F.col("text").contains(line)).collect()] == [7]
    assert {r["c0"] for r in left.collect()} == {"mine"}
    assert line_dedup.apply(none).count() == 0 and line_dedup.digests(none).count() == 0
    named = spark.createDataFrame([(c, f"{line}\n{c}") for c in "abcdef"] + [("g", None)], "doc_id string, text string")
    assert sorted(map(str, (r["text"] for r in line_dedup.apply(named).collect()))) == sorted(["a", "b", "c", "d", "e", f"{line}\nf", "None"])


def test_a_text_in_pieces_keeps_its_line_numbers(monkeypatch):
    text = "\n".join(["short", "", "é" * 50, "w" * 200, "\n", "v" * 60] * 20).encode()
    whole = defaultdict(list)
    for number, line in enumerate(text.split(b"\n")):
        if len(line.decode().strip()) >= 40:
            whole[line].append(number)
    for size in (1, 64, 150, 10_000):
        monkeypatch.setattr(line_dedup, "PIECE", size)
        found = defaultdict(list)
        for part in line_dedup.long_lines(text, 40):
            for digest, numbers in part.items():
                found[digest] += numbers
        assert sorted(found.values()) == sorted(whole.values())
        keep = line_dedup._pack(iter([pa.RecordBatch.from_pydict({"u1": [1], "u2": [2], "lines": [[0, 3]]})]))
        bitmap = next(keep).to_pydict()["keep"][0]
        left, lines, gone = line_dedup.kept_text(text, bitmap)
        original = text.split(b"\n")
        assert left == b"\n".join(line for i, line in enumerate(original) if i not in (0, 3))
        assert (lines, gone) == (len(original), 2)
