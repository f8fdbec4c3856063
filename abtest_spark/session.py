"""SparkSession construction and shared-storage settings."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Day boundaries come from timestamp_ntz values,
# so the session time zone only matters for the zoned validity check; pin it
# anyway so results never depend on the machine.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # The call site of every Column expression in error messages: about half of the time it takes to build a large plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(
    app: str = "abtest_spark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared filesystem path set by the operator; it
    is an error if it is missing there. Only with a ``local`` master (unit
    tests, local bench) a scratch folder is created, registered and removed at
    exit, so lineage cutting still works. Sessions without a SparkContext handle
    (Spark Connect) manage the folder on the server; the configured value is
    returned as is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context on this client
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="abtest-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def sizing_conf(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 1024**3,
    expansion: float = 3.0,
    max_waves: int = 20,
) -> dict:
    """Partition settings for a given input size, to pass as ``extra``.

    ``expansion`` is the size of the widest shuffle relative to the input (the
    experiment explode roughly triples rows before the partial aggregation).
    Shuffle partitions are chosen so a partition holds about
    ``target_partition_bytes`` of that shuffle, at least two and at most
    ``max_waves`` waves of tasks (the cap keeps map x reduce shuffle blocks
    manageable; partitions then grow instead). AQE coalesces small partitions
    to the advisory size and splits skewed ones. The partition count also
    sets the hot-key threshold of the skew-aware attach (hot above total / P
    rows) and bounds its broadcast table at P rows.

    100 TB of events on 1000 executors x 8 cores: 160,000 shuffle partitions
    of about 2 GB of the widest shuffle, 512 MiB file splits (about 200,000
    scan tasks); the hot-key table stays below 160,000 rows (a few MB).
    """
    shuffle_bytes = int(input_bytes * expansion)
    wanted = -(-shuffle_bytes // target_partition_bytes)
    partitions = min(max(2 * total_cores, wanted), max_waves * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
