"""Embedding near-duplicates by a random-projection tree forest.

Each tree splits recursively: one random direction per level, a node's
threshold at the median of its rows' projections. Rows within the spill margin
of a threshold go to both sides, so close pairs seldom part. Directions and
thresholds are fitted on a bounded sample; every row is routed through every
tree. Rows are compared within leaves (per label), pairs are verified by cosine
in double precision, and the verified pairs of all trees are united.

A pair may meet in several leaves. It is counted only in the smallest leaf
number that both rows share, so link counts add up without a list of pairs:
a leaf returns one row for each linked vector (count, smallest local member).
Exact copies of a vector are one row with a multiplicity. A leaf with more than
``LEAF_MAX`` rows is compared as pairs of blocks, each block pair a unit of its
own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.common import connected_components, cut
from abtest_spark.llm.pivots import finite_vector

TREES = 6
SPILL = 0.03  # margin on projections of unit vectors
SAMPLE = 16_384  # rows (smallest id hashes) on which thresholds are fitted
LEAF_ROWS = 512  # rows of one label that a leaf should hold
LEAF_MAX = 1024  # rows compared in one piece
MAX_DEPTH = 24
BROADCAST_ROWS = 200_000  # oversize leaves beyond this number are joined by shuffle


class Tree:
    """Directions per level and thresholds per node of one fitted tree (NaN: leaf)."""

    def __init__(self, sample: np.ndarray, leaf: float, spill: float, rng: np.random.Generator):
        dim = sample.shape[1]
        self.spill = spill
        self.directions = rng.standard_normal((MAX_DEPTH, dim))
        self.directions /= np.maximum(np.linalg.norm(self.directions, axis=1, keepdims=True), 1e-12)
        self.left, self.cut_at = [0], [np.nan]
        todo = [(0, 0, np.arange(len(sample)))]
        while todo:
            node, depth, rows = todo.pop()
            if len(rows) <= max(leaf, 1) or depth == MAX_DEPTH:
                continue
            p = sample[rows] @ self.directions[depth]
            at = float(np.median(p))
            low, high = rows[p <= at + spill], rows[p > at - spill]
            if max(len(low), len(high)) > 0.95 * len(rows):
                continue  # a dense clump: no direction parts it
            self.cut_at[node], self.left[node] = at, len(self.cut_at)
            self.cut_at += [np.nan, np.nan]
            self.left += [0, 0]
            todo += [(self.left[node], depth + 1, low), (self.left[node] + 1, depth + 1, high)]
        self.cut_at, self.left = np.array(self.cut_at), np.array(self.left)

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf node) pairs, each row in one leaf at least."""
        p = x @ self.directions.T
        rows, nodes, depth, out = np.arange(len(x)), np.zeros(len(x), np.int64), 0, []
        while len(rows):
            at = self.cut_at[nodes]
            leaf = np.isnan(at)
            out.append((rows[leaf], nodes[leaf]))
            rows, nodes, at = rows[~leaf], nodes[~leaf], at[~leaf]
            if len(rows) == 0:
                break
            side = p[rows, depth]
            low, high = side <= at + self.spill, side > at - self.spill
            rows, nodes = (
                np.concatenate((rows[low], rows[high])),
                np.concatenate((self.left[nodes[low]], self.left[nodes[high]] + 1)),
            )
            depth += 1
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def unit_rows(vectors, width: int) -> np.ndarray:
    """Unit vectors in double precision, zero-padded or cut to ``width``."""
    if all(len(v) == width for v in vectors):
        x = np.array(list(vectors), np.float64).reshape(len(vectors), width)
    else:
        x = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            x[i, : min(len(v), width)] = np.asarray(v, np.float64)[:width]
    top = np.abs(x).max(1, keepdims=True, initial=0)
    x = np.divide(x, top, out=np.zeros_like(x), where=top > 0)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def smallest_member(linked: np.ndarray) -> np.ndarray:
    """Smallest row index in each row's component of a boolean link matrix."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None], len(label)).min(1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare_leaf(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Linked rows of one leaf (or block pair): links counted here, smallest local member."""
    pdf = pdf.sort_values("rep", kind="stable")
    here, first, second = (int(pdf[c].iloc[0]) for c in ("leaf", "b1", "b2"))
    x = unit_rows(pdf["vec"], len(pdf["vec"].iloc[0]))
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    block = pdf["block"].to_numpy()
    if first != second:
        linked &= block[:, None] != block[None]
    every = np.concatenate(pdf["leaves"].to_numpy())
    of = np.repeat(np.arange(len(pdf)), pdf["leaves"].map(len).to_numpy())
    earlier, at = np.unique(every[every < here], return_inverse=True)
    member = np.zeros((len(pdf), len(earlier)), np.float32)
    member[of[every < here], at] = 1
    counted = linked & (member @ member.T == 0)
    links = counted @ pdf["copies"].to_numpy(np.float64)
    has = linked.any(1)
    rep = pdf["rep"].to_numpy()
    return pd.DataFrame(
        {"rep": rep[has], "links": links[has].astype(np.int64), "low": rep[smallest_member(linked)][has]}
    )


def near_duplicate_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows``.

    Links join rows of equal, non-null label, equal length and cosine >=
    ``threshold``. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null label, link with nothing:
    n_links 0, component_id their own id. Rows with a null id link with nothing
    and have a null component (kept false). Rows that repeat an id count as
    vectors of their own. Other columns are not read; an empty table gives no
    rows.
    """
    base = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vec_col).alias("vec"),
        F.col(label_col).cast("string").alias("label"),
    ).withColumn(
        "valid",
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & finite_vector(F.col("vec"))
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)),
    )
    distinct = cut(
        base.where("valid").groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    sizes = distinct.groupBy("label").agg(F.count("*").alias("n"))
    total, squares = sizes.agg(F.sum("n"), F.sum(F.col("n") * F.col("n").cast("double"))).first()
    total, alike = total or 0, (squares or 1.0) / max(total or 1, 1) ** 2  # chance that two rows share a label
    sample = distinct.orderBy(F.xxhash64("rep"), "rep", "label").limit(SAMPLE).select("vec").collect()
    width = max((len(r["vec"]) for r in sample), default=1)
    points = unit_rows([r["vec"] for r in sample], width)
    rng = np.random.default_rng(seed)
    trees = [Tree(points, LEAF_ROWS / alike * len(points) / max(total, 1), SPILL, rng) for _ in range(TREES)]
    offset = np.concatenate(([0], np.cumsum([len(t.cut_at) for t in trees])))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = unit_rows(pdf["vec"], width)
            parts = [t.route(x) for t in trees]
            row = np.concatenate([p[0] for p in parts])
            leaf = np.concatenate([p[1] + o for p, o in zip(parts, offset[:-1], strict=True)])
            order = np.lexsort((leaf, row))
            ends = np.cumsum(np.bincount(row, minlength=len(pdf)))[:-1]
            yield pdf.assign(leaves=np.split(leaf[order], ends) if len(pdf) else [])

    kind = distinct.schema["vec"].dataType.simpleString()
    routed = cut(
        distinct.mapInPandas(route, f"label string, vec {kind}, rep long, copies long, leaves array<long>")
    )
    leaves = routed.select(F.explode("leaves").alias("leaf"), "label", F.size("vec").alias("dim"), "rep")
    over = leaves.groupBy("leaf", "label", "dim").count().where(F.col("count") > LEAF_MAX)
    over = cut(over.select("leaf", "label", "dim", F.ceil(F.col("count") / LEAF_MAX).alias("blocks")))
    placed = routed.select(
        F.explode("leaves").alias("leaf"), "label", F.size("vec").alias("dim"), "rep", "copies", "vec", "leaves"
    )
    n_over = over.count()
    if n_over:
        placed = placed.join(F.broadcast(over) if n_over <= BROADCAST_ROWS else over, ["leaf", "label", "dim"], "left")
    else:
        placed = placed.withColumn("blocks", F.lit(1).cast("long"))
    placed = (
        placed.withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        .withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("b1", F.least("block", "other"))
        .withColumn("b2", F.greatest("block", "other"))
    )
    found = cut(
        placed.groupBy("leaf", "label", "dim", "b1", "b2").applyInPandas(
            lambda pdf: compare_leaf(pdf, threshold), "rep long, links long, low long"
        )
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    named = (
        distinct.join(counts, "rep", "left")
        .join(parts, distinct["rep"] == parts["node"], "left")
        .select(
            "label",
            "vec",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    linked = (
        base.where("valid")
        .join(named, ["label", "vec"], "left")
        .select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    )
    alone = base.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
