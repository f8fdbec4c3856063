"""Layer storage: one writer and one reader for bronze/silver/gold.

Layers are directories ``{root}/{layer}`` in a columnar format (parquet by
default; any format whose jar is on the classpath, e.g. ``delta``, works the
same). Writes are idempotent overwrites, so a rerun never fails on an existing
path, and a written layer is the lineage cut for everything downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abtest_spark.schema import LAYER_SCHEMAS


def layer_path(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/{layer}"


def read_layer(spark: SparkSession, root: str, layer: str, fmt: str = "parquet") -> DataFrame:
    """The stored layer. Layers of the model are read with their declared
    schema (column order included), others with the schema found in the files."""
    reader = spark.read.format(fmt)
    schema = LAYER_SCHEMAS.get(layer) if fmt == "parquet" else None
    if schema is None:
        return reader.load(layer_path(root, layer))
    return reader.schema(schema).load(layer_path(root, layer)).select(*[c.split()[0] for c in schema.split(", ")])


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    fmt: str = "parquet",
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    files_per_partition: int | None = None,
    dynamic: bool = False,
) -> None:
    """Write one layer.

    ``cluster_by`` range-partitions on those columns first (a distributed
    sort, no single-task global order), then ``sort_by`` sorts within each
    output file, so files hold contiguous key ranges and row-group statistics
    prune well on later filters. ``partition_by`` writes Hive-style folders
    (e.g. gold by ``day``), which turns day lookups into folder pruning.
    An overwrite replaces the whole layer; with ``dynamic`` only the partitions
    present in ``df`` (a backfill of given days, a micro-batch). By default each partition value is written
    by one task (one file: right for small tables such as gold); for large
    layers ``files_per_partition`` spreads every value over that many tasks by
    a deterministic hash of the row, so one heavy day never lands in one task.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by)
    elif partition_by and files_per_partition:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(int(files_per_partition)))
        out = out.repartition(*[F.col(c) for c in partition_by], spread)
    elif partition_by:
        out = out.repartition(*partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    writer = out.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.save(layer_path(root, layer))


def write_bucketed(
    df: DataFrame, root: str, layer: str, table: str, buckets: int, bucket_by: str = "user_id", sort_by: Sequence[str] = ()
) -> DataFrame:
    """Write a layer as a catalog table bucketed (and sorted) by ``bucket_by``; returns the table.

    A session or metastore table remembers the buckets, so later joins and
    aggregates on that column need no shuffle of the layer. Rows are first
    dealt to the buckets' tasks: one file per bucket. The files are at
    ``{root}/{layer}`` and can be read as plain parquet too.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, bucket_by).write.format("parquet").mode("overwrite").bucketBy(buckets, bucket_by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer.option("path", layer_path(root, layer)).saveAsTable(table)
    return spark.table(table)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV export (e.g. of gold), written in parallel part files."""
    df.write.option("header", True).mode(mode).csv(path)
