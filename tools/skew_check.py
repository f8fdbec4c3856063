"""Hot-key check: per-task shuffle reads of the purchase-statistics attach.

Usage: python tools/skew_check.py [sf_dir]

Derives a skewed raw stream from ``events`` (every third event is moved to
one user, so that user holds a third of all rows), forces shuffle joins
(broadcast off, as when per-user statistics are too large to broadcast) and
AQE skew handling off, then runs
  * a plain equi-join of events with the per-user statistics, and
  * ``attach_per_key`` (hot keys salted),
and also the deduplication of a stream where a third of the rows are copies
of one row, gold (per-user window over reduced rows) and the event-rank twin
(range-partitioned order); it reports, from Spark's event log, the largest
number of shuffle records read by one task of each.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from abtest_spark.functions.columns import parsed_ts  # noqa: E402
from abtest_spark.operators.gold import gold_aggregated_from_events  # noqa: E402
from abtest_spark.operators.joins import attach_per_key  # noqa: E402
from abtest_spark.operators.quality import deduplicate  # noqa: E402
from abtest_spark.operators.silver import event_rank, user_purchase_stats  # noqa: E402
from abtest_spark.session import get_spark  # noqa: E402
from abtest_spark.sources.raw import raw_from_events, read_table  # noqa: E402


def _events(path):
    import zstandard

    for f in sorted(glob.glob(f"{path}/*/events_*")):
        with open(f, "rb") as fh:
            stream = fh
            if f.endswith(".zstd"):
                stream = zstandard.ZstdDecompressor().stream_reader(fh)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="abtest-skew-")
    os.makedirs(f"{scratch}/events")
    partitions = 16
    spark = get_spark(
        app="abtest_skew_check",
        master="local[8]",
        shuffle_partitions=partitions,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"{scratch}/events",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.checkpoint.dir": f"{scratch}/ckpt",
        },
    )
    events = read_table(spark, sf_dir, "events")
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    ev = raw_from_events(skewed).withColumn("_ts", parsed_ts("timestamp"))
    stats = user_purchase_stats(ev)
    total = ev.count()
    sc = spark.sparkContext

    sc.setJobDescription("plain join")
    plain = ev.join(stats.withColumnRenamed("user_id", "_u"), F.col("user_id").eqNullSafe(F.col("_u")), "left")
    plain.write.format("noop").mode("overwrite").save()

    sc.setJobDescription("salted attach")
    salt_cols = [c for c in ev.columns if c != "user_id"]
    salted = attach_per_key(ev, stats, "user_id", "n_rows", salt_cols, partitions)
    salted.write.format("noop").mode("overwrite").save()

    raw = raw_from_events(skewed)
    # A third of all rows are copies of one row.
    copies = raw_from_events(events).withColumn("_i", F.monotonically_increasing_id())
    cols = [c for c in copies.columns if c != "_i"]
    copies = copies.select(*[F.when(F.col("_i") % 3 == 0, F.lit(None)).otherwise(F.col(c)).alias(c) for c in cols])
    sc.setJobDescription("dedupe")
    deduplicate(copies).write.format("noop").mode("overwrite").save()
    sc.setJobDescription("gold")
    gold_aggregated_from_events(raw).write.format("noop").mode("overwrite").save()
    sc.setJobDescription("event_rank")
    event_rank(raw, target_partitions=partitions).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_desc, reads, per_stage = {}, {}, {}
    for e in _events(f"{scratch}/events"):
        if e["Event"] == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description", "")
            for sid in e["Stage IDs"]:
                stage_desc[sid] = desc
        elif e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {})
            rec = m.get("Total Records Read", 0)
            key = stage_desc.get(e["Stage ID"], "")
            reads[key] = max(reads.get(key, 0), rec)
            per_stage.setdefault((key, e["Stage ID"]), []).append(rec)
    if os.environ.get("SKEW_DETAIL"):
        for (k, sid), recs in sorted(per_stage.items()):
            if max(recs) > 0:
                print(k, sid, "tasks", len(recs), "max", max(recs), "sum", sum(recs), file=sys.stderr)
    print(json.dumps({
        "rows": total,
        "hot_user_rows": total // 3,
        "average_rows_per_partition": total // partitions,
        "max_task_shuffle_records": {
            k: v for k, v in reads.items() if k in ("plain join", "salted attach", "dedupe", "gold", "event_rank")
        },
    }))


if __name__ == "__main__":
    main()
