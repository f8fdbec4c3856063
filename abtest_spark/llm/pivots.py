"""Exact top-k inner products by pivot-table elimination.

Every row stores its distances to a fixed set of pivots. For a query q and a
candidate c the triangle inequality gives |d(q, p) - d(c, p)| <= d(q, c) for
every pivot p; the largest of these lower bounds turns into an upper bound of
the inner product through 2 q.c = |q|^2 + |c|^2 - d(q, c)^2. Candidates are
evaluated in bands of falling bound until the k-th best score exceeds every
bound that is left, so the result is exact.

The work is a stated query set against all rows, cut into (query block x row
block) cells of fixed size; a cell is one task's unit and holds bounded memory
whatever the table's size. The cells' k best rows are merged by one window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 16
PIVOT_SAMPLE = 2048  # rows (smallest id hashes) among which the pivots are chosen
QUERY_BLOCK = 2048
ROW_BLOCK = 8192
BANDS = (256, 1024, 4096)  # ranks by bound at which a cell looks whether it can stop
SLAB = 64  # queries of a cell handled at once


def finite_vector(vec: Column) -> Column:
    """True where ``vec`` is not null and holds neither null nor non-finite components."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & good, F.lit(False))


def quantized(vec: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sample row farthest from those chosen."""
    if len(sample) == 0:
        return sample
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def cell_topk(qid, q, cid, c, pivots, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, score) of the k best rows of one cell, ties to the smaller id."""
    q2, c2 = (q * q).sum(1), (c * c).sum(1)
    dq = np.sqrt(((q[:, None] - pivots[None]) ** 2).sum(2)).astype(np.float32)
    dc = np.stack([np.sqrt(((c - p) ** 2).sum(1)) for p in pivots], 1).astype(np.float32)
    bands = [b for b in BANDS if b < len(c)]
    edges = [0, *bands, len(c)]
    found = ([], [], [])
    for at in range(0, len(q), SLAB):
        s = slice(at, at + SLAB)
        low = np.zeros((len(q[s]), len(c)), np.float32)
        for p in range(len(pivots)):
            np.maximum(low, np.abs(dq[s, p, None] - dc[None, :, p]), out=low)
        total = q2[s, None] + c2[None]
        bound = ((total - low * low) / 2 + (total * 1e-5 + 1e-2)).astype(np.float32)  # rounding allowed for
        bound[qid[s, None] == cid[None]] = -np.inf
        order = np.argpartition(-bound, [b - 1 for b in bands], axis=1) if bands else np.argsort(-bound, axis=1)
        for i in range(len(bound)):
            ids, scores, kth = np.zeros(0, np.int64), np.zeros(0), -np.inf
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                rows = order[i, lo:hi]
                rows = rows[bound[i, rows] >= max(kth, np.finfo(np.float32).min)]
                if len(rows) == 0:
                    break  # every later bound is lower: exact stop
                ids = np.concatenate((ids, cid[rows]))
                scores = np.concatenate((scores, c[rows] @ q[at + i]))
                if len(scores) > k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                if len(scores) >= k:
                    kth = scores.min()
            found[0].append(np.full(len(ids), qid[at + i]))
            found[1].append(ids)
            found[2].append(scores)
    return tuple(np.concatenate(x) if x else np.zeros(0) for x in found)


def exact_topk(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    scale: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product per query row.

    Vectors that are null or hold null or non-finite components, and rows with
    a null id, take no part. Ids are keys: of rows that repeat an id the
    smallest vector counts. Shorter vectors are read as zero-padded; an empty
    vector scores zero. Equal scores go to the smaller id. Fewer rows than k:
    all. Scores are exact up to 2^53 and clipped to the long range beyond.
    Other columns are not read; an empty table gives no rows.
    """
    vecs = (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"), is_query.alias("is_query"))
        .where(F.col("id").isNotNull() & finite_vector(F.col("raw")))
        .select("id", quantized(F.col("raw"), scale).alias("v"), F.coalesce("is_query", F.lit(False)).alias("is_query"))
        .groupBy("id")
        .agg(F.min("v").alias("v"), F.max("is_query").alias("is_query"))
    )
    size = vecs.agg(F.count("*"), F.sum(F.col("is_query").cast("long")), F.max(F.size("v"))).first()
    n, n_query, width = size[0], size[1] or 0, max(size[2] or 0, 1)
    sample = [r["v"] for r in vecs.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").collect()]
    pivots = choose_pivots(_matrix(sample, width), PIVOTS)
    n_row_blocks, n_query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-n_query // QUERY_BLOCK))

    def block(of: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(of))

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long")))

    queries = vecs.where("is_query").select(
        block(n_query_blocks, 1).alias("qb"), every(n_row_blocks).alias("rb"), "id", "v"
    )
    stored = vecs.select(every(n_query_blocks).alias("qb"), block(n_row_blocks, 2).alias("rb"), "id", "v")

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        got = cell_topk(
            q["id"].to_numpy(), _matrix(q["v"], width), c["id"].to_numpy(), _matrix(c["v"], width), pivots, k
        )
        score = np.clip(got[2], -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        return pd.DataFrame({"query_id": got[0].astype(np.int64), "vec_id": got[1].astype(np.int64), "score": score})

    best = (
        queries.groupBy("qb", "rb")
        .cogroup(stored.groupBy("qb", "rb"))
        .applyInPandas(cell, "query_id long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
