import math

import numpy as np
from pyspark.sql import functions as F

from abtest_spark.llm.pivots import exact_topk
from abtest_spark.llm.rp_forest import near_duplicate_vectors

ROWS = "vec_id long, embedding array<float>, label int, rep long, copies string, leaves string, score int"


def vectors(n_base=60, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n_base, 16))
    out = [(v, k % 3) for k, v in enumerate(base)]
    out += [(base[k] + rng.normal(size=16) * s, k % 3) for k in range(20) for s in (0.05, 0.2, 0.35, 0.5)]
    out += [(base[0], 0)] * 5 + [(base[1] * 3, 1), (base[2], 0)]  # copies, a multiple, another label
    out += [(base[30] + rng.normal(size=16) * 0.02, 0) for _ in range(80)]  # a dense clump
    return [(np.asarray(v, np.float32).tolist(), k) for v, k in out]


def odd():
    nan, inf = float("nan"), float("inf")
    return [
        (None, 0), ([0.0] * 16, 0), ([0.0] * 16, 0), ([], 0), ([nan] + [1.0] * 15, 0), ([inf] + [1.0] * 15, 0),
        ([None] + [1.0] * 15, 0), ([1.0] * 16, None), ([1.0] * 16, None), ([1.0, 2.0], 0), ([1.0, 2.0], 0),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "c", "l", 2) for i, (v, k) in enumerate(rows)], ROWS)


def linked(a, b):
    (v, k), (w, m) = a, b
    if v is None or w is None or k is None or k != m or len(v) != len(w) or None in v or None in w:
        return False
    v, w = np.asarray(v, float), np.asarray(w, float)
    if not (np.isfinite(v).all() and np.isfinite(w).all() and v.any() and w.any()):
        return False
    return v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= 0.93


def check_links(rows, got):
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and linked(rows[i], rows[j])]
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        new = label[:]
        for i, j in pairs:
            new[i] = min(new[i], new[j])
        if new == label:
            break
        label = new
    n = [0] * len(rows)
    for i, _ in pairs:
        n[i] += 1
    assert sorted(got) == [(i, n[i], label[i], label[i] == i) for i in range(len(rows))]


def test_links_against_all_pairs(spark):
    rows = vectors() + odd()
    got = near_duplicate_vectors(frame(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    check_links(rows, map(tuple, got.collect()))


def test_blocks_of_an_oversize_leaf(spark, monkeypatch):
    from abtest_spark.llm import rp_forest

    monkeypatch.setattr(rp_forest, "LEAF_MAX", 16)
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 40)
    rows = vectors()
    check_links(rows, map(tuple, near_duplicate_vectors(frame(spark, rows)).collect()))


def test_empty_and_idless(spark):
    assert near_duplicate_vectors(frame(spark, [])).count() == 0
    df = frame(spark, [([1.0, 0.0], 1)] * 3).withColumn("vec_id", F.when(F.col("vec_id") > 0, F.col("vec_id")))
    got = sorted(map(tuple, near_duplicate_vectors(df).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False)]


def test_forest_recall_on_a_table(spark):
    """Share of the brute-force links of sf0.01 found, at the query's parameters."""
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    want = ((x @ x.T >= 0.93) & (label[:, None] == label[None])).sum() - len(rows)
    got = QUERIES["op1_embedding_near_dedup"](spark, d).agg(F.sum("n_links")).first()[0]
    assert 0.9 * want <= got <= want


def topk(rows, k):
    ok = {}
    for i, (v, _) in enumerate(rows):
        if v is not None and None not in v and all(map(math.isfinite, v)):
            ok[i] = [math.floor(64 * x) for x in v]
    out = []
    for q in ok:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(ok[q], ok[c], strict=False)), c) for c in ok if c != q)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(best, 1)]
    return sorted(out)


def test_topk_against_all_scores(spark):
    rows = vectors() + odd()
    got = exact_topk(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == topk(rows, 20)


def test_topk_in_many_cells_with_ties(spark, monkeypatch):
    from abtest_spark.llm import pivots

    monkeypatch.setattr(pivots, "ROW_BLOCK", 40)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 3)
    monkeypatch.setattr(pivots, "BANDS", (2, 8))
    rows = vectors() + [([1.0] * 16, 0)] * 30 + odd()
    got = exact_topk(frame(spark, rows), F.col("vec_id") % 20 == 0, k=7)
    assert sorted(map(tuple, got.collect())) == topk(rows, 7)


def test_topk_empty_few_and_repeated_ids(spark):
    query = F.col("vec_id") % 20 == 0
    assert exact_topk(frame(spark, []), query).count() == 0
    assert exact_topk(frame(spark, [([1.0], 0)]), query).count() == 0
    few = [([1.0, 2.0], 0), ([3.0, 1.0], 0), ([0.5, 0.5], 0)]
    df = frame(spark, few)
    assert sorted(map(tuple, exact_topk(df.unionByName(df), query).collect())) == topk(few, 20)


def test_topk_query_against_all_scores(spark):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    got = QUERIES["op2_exact_topk"](spark, d).collect()
    assert sorted(map(tuple, got)) == topk([(r.embedding, r.label) for r in rows], 20)


def test_planted_pairs_are_found_in_trees_of_many_leaves(spark, monkeypatch):
    """Pairs just above the threshold (cosine 0.931 to 0.95), trees of at least 64 leaves: recall of links."""
    from abtest_spark.llm import rp_forest

    made = []
    fitted = rp_forest.Tree.__init__

    def fit(self, *args):
        fitted(self, *args)
        made.append(int(np.isnan(self.cut_at).sum()))

    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 48)
    monkeypatch.setattr(rp_forest.Tree, "__init__", fit)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(4000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(800, 64))
    side -= (side * base[:800]).sum(1, keepdims=True) * base[:800]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = rng.uniform(0.931, 0.95, size=(800, 1))
    x = np.concatenate([base, base[:800] * cos + side * np.sqrt(1 - cos**2)]).astype(np.float32)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    want = near.sum(1)
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(df.repartition(4)).collect()}
    assert len(made) == rp_forest.TREES and min(made) >= 64
    assert want.sum() >= 1600 and all(got[i] <= n for i, n in enumerate(want.tolist()))
    assert sum(got.values()) >= 0.98 * want.sum()
