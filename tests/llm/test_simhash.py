import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from abtest_spark.llm.common import connected_components
from abtest_spark.llm.simhash import POSITION_SETS, drop_near_duplicates, fingerprints, near_pairs, simhash_groups
from abtest_spark.llm.xxh64 import hash_windows

DOCS = "doc_id long, text string, lang string, fp string, rep long, component_id string"


def direct(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    out = 0
    for bit in range(64):
        n = sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams)
        out |= (2 * n > len(grams)) << bit
    return out


def components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_hash_of_every_length():
    data = bytes(random.Random(1).choices(range(256), k=6000))
    spans = [(i, i + n) for n in [*range(1, 140), 2047, 2048, 5000] for i in (0, 3)]
    got = hash_windows(data, np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in spans]


def test_fingerprints_against_direct_computation():
    r = random.Random(2)
    texts = ["", " \n", "One", "one TWO", "É x é", "w" * 9000 + " a b c", "no break space"]
    texts += [" ".join(r.choices(["a", "Bb", "ccc", "ß", "long" * 12], k=r.randint(1, 40))) for _ in range(60)]
    assert [int(x) for x in fingerprints([t.encode() for t in texts], 3)] == [direct(t) for t in texts]


def test_any_five_positions_hold_a_set():
    from itertools import combinations

    assert all(any(set(s) <= set(five) for s in POSITION_SETS) for five in combinations(range(8), 5))


def test_pairs_against_all_pairs(spark):
    r = random.Random(3)
    prints = {r.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for bits in (1, 2, 3, 4):
            q = p
            for b in r.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    want = {
        (min(i, j), max(i, j))
        for i, p in rows
        for j, q in rows
        if i < j and bin((p ^ q) & (2**64 - 1)).count("1") <= 3
    }
    got = near_pairs(spark.createDataFrame(rows, "rep long, fp long")).collect()
    assert len(got) == len(want) and {(min(a, b), max(a, b)) for a, b, _ in got} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(5, 5), (None, 3), (201, 200), (200, 201)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def docs(spark):
    r = random.Random(4)
    base = [" ".join(r.choices([f"w{k}" for k in range(500)], k=300)) for _ in range(6)]
    near = [t + " extra" for t in base[:3]]
    rows = [(i, t) for i, t in enumerate([*base, *near, base[0], "", None, " \t", "A b", "a  B"])]
    rows += [(None, base[1]), (3, base[3])]
    return spark.createDataFrame([(i, t, "en", "x", 7, "y") for i, t in rows], DOCS), rows


def test_groups_with_nulls_ties_and_clashing_columns(spark):
    df, rows = docs(spark)
    got = simhash_groups(df).collect()
    prints = {i: direct(t) for i, t in rows if i is not None}
    linked = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    want = components(prints, linked)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got if r.doc_id is not None) == sorted(
        (i, f"{direct(t):016x}", want[i]) for i, t in rows if i is not None
    )
    assert [(r.fingerprint, r.component_id) for r in got if r.doc_id is None] == [(f"{direct(rows[1][1]):016x}", None)]
    assert want[6] == 0 and want[10] == want[11] == want[12] == 10 or want[11] == 10
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert simhash_groups(df).count() == 0 and drop_near_duplicates(df).count() == 0


def test_query_against_all_pairs(spark):
    from abtest_spark.llm.queries import QUERIES

    rows = QUERIES["op9_simhash_near_dedup"](spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    prints = {i: direct(t) for i, t in texts.items()}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = components(prints, linked)
    assert sorted(map(tuple, rows)) == sorted((i, f"{prints[i]:016x}", want[i]) for i in prints)


def test_no_duplicate_free_rows_lost(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    assert drop_near_duplicates(df).count() == 50


def test_a_repeated_id_loses_no_other_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in "abc")
    rows = [(5, a, "en"), (5, b, "en"), (5, b, "de"), (5, b, "de"), (7, a, "en"), (2, c, "en"), (5, c, "fr"), (9, None, "en"), (9, "", "en")]
    kept = []
    for order in (rows, rows[::-1], rows * 2):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        kept.append(sorted(map(tuple, drop_near_duplicates(df).collect()), key=str))
        assert {(r.doc_id, r.component_id) for r in simhash_groups(df).collect()} == {(5, 5), (7, 5), (2, 2), (5, 2), (9, 9)}
    assert kept[0] == kept[1] == kept[2]
    assert [(i, t) for i, t, _ in kept[0]] == [(2, c), (5, a), (5, b), (9, None)]
