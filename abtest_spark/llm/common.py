"""Helpers shared by the operators: shared folder, lineage cuts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abtest_spark.session import checkpoint_dir


ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 500  # rows of an Arrow batch: texts are long, and a batch is held whole in the JVM and in Python


def bounded_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches to ARROW_ROWS rows, which bounds the memory of tasks with texts."""
    if int(spark.conf.get(ARROW_CONF)) > ARROW_ROWS:
        spark.conf.set(ARROW_CONF, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, readable by every executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame) -> Column:
    """The whole row as one struct column, so that an operator's own column names clash with none of it."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def unpacked(df: DataFrame, row: str, replaced: dict[str, Column], added: dict[str, Column]) -> list[Column]:
    """Columns of ``df`` out of its packed row; ``replaced`` keep their place, ``added`` stand in for columns of their name."""
    kept = [replaced.get(c, F.col(row)[c]).alias(c) for c in df.columns if c not in added]
    return kept + [c.alias(name) for name, c in added.items()]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def shared_fs(uri: str):
    """(filesystem, path) of a folder in the shared store, for files that Spark has no writer for."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.split(":", 1)[1].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges(a long, b long)``; component = smallest node reachable.

    Alternating large-star / small-star rounds: each is one grouped minimum
    (partial aggregation collapses a hub's edges map-side) and one join back on
    the node, which adaptive skew handling can split. Every round is
    checkpointed and the edge set never grows, so work per round is linear in
    the edges. Null or equal end points are ignored; no edges give no rows.
    """
    e = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = cut(
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
