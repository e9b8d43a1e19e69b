"""SimHash, vectors and components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tripfunnel.llm import queries, simhash, vector_dedup
from tripfunnel.llm.components import components, local_roots


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_components_of_chains_hubs_and_repeats(spark):
    pick = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, 500 + i) for i in range(1, 300)]
    loose = [(pick.randrange(1000, 1400), pick.randrange(1000, 1400)) for _ in range(200)]
    links = chain + hub + loose + chain[:5] + [(b, a) for a, b in hub[:9]] + [(7, 7)]
    pick.shuffle(links)
    sets = Sets({n for link in links for n in link})
    for a, b in links:
        sets.join(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: sets.find(n) for n in sets.up if n != 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    a, b = np.array(links).T
    root = local_roots(2000, a, b)
    assert all(root[n] == sets.find(n) for n in sets.up)


def direct_fingerprint(text):
    """Bit by bit, as the definition says."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def direct_components(fingerprint, most=3):
    """The least id reachable, over all pairs; ids by fingerprint."""
    ids = sorted(fingerprint)
    sets = Sets(ids)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fingerprint[a] ^ fingerprint[b]).bit_count() <= most:
                sets.join(a, b)
    return {i: sets.find(i) for i in ids}


def test_simhash_equals_brute_force(spark, small, odd):
    docs = small.select("doc_id", "text").unionByName(
        odd.filter("doc_id <> 4").dropDuplicates(["doc_id"]).select((F.col("doc_id") + 90000).alias("doc_id"), "text")
    )
    fingerprint = {r["doc_id"]: direct_fingerprint(r["text"]) for r in docs.collect()}
    expected = direct_components(fingerprint)
    for cell_rows in (4096, 4):  # with 4, nearly every cell is split into pairs of blocks
        found = simhash.near_duplicates(docs, cell_rows=cell_rows).withColumn("hex", simhash.hex16(F.col("fp"))).collect()
        assert {r["doc_id"]: r["hex"] for r in found} == {i: f"{f:016x}" for i, f in fingerprint.items()}
        assert {r["doc_id"]: r["component_id"] for r in found} == expected
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))


def test_popcounts_bound_the_distance_and_cells_lose_no_pair(spark):
    pick = random.Random(5)
    points = {pick.getrandbits(64) for _ in range(60)}
    for p in list(points):  # neighbours at 1 to 5 bits, and a dense cluster
        for bits in (1, 2, 3, 4, 5):
            q = p
            for b in pick.sample(range(64), bits):
                q ^= 1 << b
            points.add(q)
    center = pick.getrandbits(64)
    points |= {center ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)}
    points = sorted(points)
    array = np.array(points, dtype=np.uint64)
    unary = simhash.popcounts(array)
    exact = np.bitwise_count(array[:, None] ^ array[None])
    assert (np.bitwise_count(unary[:, None] ^ unary[None]) <= exact).all()
    for most in (1, 3, 4):
        masks = [np.uint64(m) for _, m in simhash.cell_masks(most, 4)]
        meet = np.zeros(exact.shape, dtype=bool)
        for m in masks:
            meet |= (unary & m)[:, None] == (unary & m)[None]
        assert meet[exact <= most].all()
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in points], "fp long")
    expected = direct_components({i: p for i, p in enumerate(points)})
    for cell_rows in (4096, 8):
        ties = simhash.link_forest(frame, cell_rows=cell_rows).collect()
        sets = Sets(range(len(points)))
        number = {int(np.uint64(p).astype(np.int64)): i for i, p in enumerate(points)}
        for r in ties:
            sets.join(number[r["a"]], number[r["b"]])
        assert {i: sets.find(i) for i in range(len(points))} == expected


def test_simhash_of_odd_rows(odd, none, clashing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7] and ids.count(None) == 1
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def vectors(spark):
    pick = np.random.default_rng(2)
    rows, near = [], pick.normal(size=8)
    for i in range(160):
        label = int(pick.integers(3))
        v = near + pick.normal(size=8) * pick.choice([0.0, 0.05, 0.2]) if i % 3 else pick.normal(size=8)
        rows.append((i, [float(x) for x in v.astype(np.float32)], label))
    for i in range(160, 180):  # copies and multiples
        rows.append((i, rows[i - 160][1], rows[i - 160][2]))
    rows.append((200, [2.0 * x for x in rows[0][1]], rows[0][2]))
    odd = [
        (300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [None] + rows[0][1][1:], 1), (304, [float("nan")] * 8, 1),
        (305, [float("inf")] * 8, 1), (306, rows[0][1], None), (307, rows[0][1][:4], rows[0][2]), (308, rows[0][1][:4], rows[0][2]),
        (309, [1e38] * 8, 2), (310, [3e38] * 8, 2), (None, rows[1][1], rows[1][2]), (5, rows[5][1], rows[5][2]),
    ]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")


def test_vectors_equal_brute_force(spark):
    frame = vectors(spark)
    rows = frame.collect()
    sound = [
        i for i, r in enumerate(rows)
        if r["label"] is not None and r["embedding"] and all(x is not None and np.isfinite(x) for x in r["embedding"]) and any(r["embedding"])
    ]
    sets, links = Sets(range(len(rows))), [0] * len(rows)
    for a in sound:
        for b in sound:
            x, y = np.array(rows[a]["embedding"], dtype=np.longdouble), np.array(rows[b]["embedding"], dtype=np.longdouble)
            if a != b and rows[a]["label"] == rows[b]["label"] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[a] += 1
                    sets.join(a, b)
    least = {}
    for i, r in enumerate(rows):
        if r["vec_id"] is not None:
            least[sets.find(i)] = min(least.get(sets.find(i), r["vec_id"]), r["vec_id"])
    expected = sorted(((str(r["vec_id"]), links[i], least.get(sets.find(i))) for i, r in enumerate(rows)), key=str)
    for options in ({}, {"cell_points": 10, "block": 4, "chunk": 8}):  # one cell; many cells in many blocks
        found = vector_dedup.near_duplicates(frame, **options).collect()
        assert sorted(((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in found), key=str) == expected
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_vectors_equal_their_sql_twin(spark):
    """Also on rows with planted links: a tenth of the vectors, slightly turned."""
    import duckdb

    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    turned = F.transform("embedding", lambda x, i: F.when(i % 9 == 0, x + 0.01).otherwise(x).cast("float"))
    planted = frame.filter("vec_id % 10 = 0").select((F.col("vec_id") + 100000).alias("vec_id"), turned.alias("embedding"), "label")
    for rows in (frame, frame.unionByName(planted)):
        con = duckdb.connect()
        con.register("embeddings", rows.toArrow())
        expected = con.sql(queries.ORACLE["op3_vector_dedup"]).fetchall()
        found = vector_dedup.near_duplicates(rows).select("vec_id", "n_links", "component_id", "kept").collect()
        assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(r["n_links"] for r in found) >= 2 * planted.count()


def test_vectors_of_odd_tables(spark):
    frame = vectors(spark)
    assert vector_dedup.near_duplicates(frame.limit(0)).count() == 0
    assert vector_dedup.near_duplicates(frame.filter("vec_id between 300 and 305")).filter("n_links = 0 and kept").count() == 6
    more = frame.withColumn("point", F.lit(1)).withColumn("n_links", F.lit(2)).withColumn("cells", F.lit(3))
    kept = vector_dedup.keep_one(more)
    assert kept.columns == more.columns and 0 < kept.count() < more.count()
