"""Incremental gold over a file stream equals batch gold over all rows,
including a late BUY that flags earlier days, and a retried batch."""

import os
import tempfile

from pyspark.sql import functions as F

from abtest_spark.operators import gold as G
from abtest_spark.sources import layers as L
from abtest_spark.streaming.gold_stream import process_batch, start_gold_stream


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_matches_batch(spark, raw_df):
    base = tempfile.mkdtemp(prefix="abtest-stream-")
    src, root = os.path.join(base, "src"), os.path.join(base, "out")
    first = [
        (1, "2024-01-01 10:00:00", "VIEW", 1, "MLA", "{e=1}"),
        (2, "2024-01-01 11:00:00", "VIEW", 2, "MLB", "{e=2}"),
        (2, "2024-01-02 11:00:00", "BUY", 3, "MLB", "{e=2}"),
        (3, None, "VIEW", 4, "MLA", "{e=1}"),
        (3, None, "VIEW", 4, "MLA", "{e=1}"),
    ]
    second = [
        (1, "2024-01-03 09:00:00", "BUY", 5, "MLA", "{e=1}"),  # flags user 1 on day 1
        (2, "2024-01-01 11:00:00", "VIEW", 2, "MLB", "{e=2}"),  # duplicate of an earlier row
        (4, "2024-01-03 10:00:00", "VIEW", 6, "MLA", "{e=2}"),
    ]
    L.export_csv(raw_df(first), os.path.join(src, "part1"))
    q = start_gold_stream(spark, os.path.join(src, "*"), root)
    q.awaitTermination()
    L.export_csv(raw_df(second), os.path.join(src, "part2"))
    q = start_gold_stream(spark, os.path.join(src, "*"), root)
    q.awaitTermination()

    everything = raw_df(first + second)
    got = L.read_layer(spark, root, "gold_aggregated")
    assert _same(got, G.gold_aggregated_from_events(everything))
    got_t = L.read_layer(spark, root, "gold_tunnel")
    assert _same(got_t, G.gold_tunnel_from_events(everything))
    day1 = got.where((F.col("day") == "2024-01-01") & (F.col("variant_id") == "1")).first()
    assert day1["purchases"] == 1

    # A retried batch (same epoch, same rows) changes nothing.
    process_batch(raw_df(second), 1, root)
    assert _same(L.read_layer(spark, root, "gold_aggregated"), G.gold_aggregated_from_events(everything))
    assert L.read_layer(spark, root, "bronze_stream").count() == 6


def test_stream_many_micro_batches(spark):
    """Raw stream from the events table in three drops, one file per trigger:
    several epochs inside one available-now run equal the batch result."""
    from abtest_spark.sources.raw import load_raw

    base = tempfile.mkdtemp(prefix="abtest-stream3-")
    src, root = os.path.join(base, "src"), os.path.join(base, "out")
    raw = load_raw(spark, "/root/testdata/sf0.001")
    day = F.dayofmonth(F.col("timestamp").try_cast("timestamp_ntz"))
    drops = [
        raw.where(F.coalesce(day <= 10, F.lit(True))),
        raw.where(day.between(11, 20)),
        raw.where(day > 20),
    ]
    for i, part in enumerate(drops):
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"drop={i}"))
    q = start_gold_stream(spark, os.path.join(src, "drop=*"), root, fmt="parquet", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    assert _same(L.read_layer(spark, root, "gold_aggregated"), G.gold_aggregated_from_events(raw))
    assert _same(L.read_layer(spark, root, "gold_tunnel"), G.gold_tunnel_from_events(raw))
    assert L.read_layer(spark, root, "user_stats").select("epoch").distinct().count() == 3


def test_affected_days_are_narrow(spark, raw_df):
    import datetime as dt

    root = tempfile.mkdtemp(prefix="abtest-days-")
    day = lambda d: dt.date(2024, 1, d)
    e = "{x=1, y=2}"
    b0 = [
        (1, "2024-01-01 10:00:00", "VIEW", 1, "MLA", e),
        (1, "2024-01-02 10:00:00", "VIEW", 2, "MLA", e),
        (1, "2024-01-03 10:00:00", "BUY", 3, "MLA", e),
        (2, "2024-01-01 11:00:00", "VIEW", 4, "MLA", e),
    ]
    b1 = [(1, "2024-01-05 10:00:00", "VIEW", 5, "MLA", e)]  # no purchase
    b2 = [(2, "2024-01-04 10:00:00", "BUY", 6, "MLA", e), (2, None, "VIEW", 7, "MLA", e)]  # first BUY of user 2
    b3 = [(1, "2024-01-06 10:00:00", "BUY", 8, "MLA", e)]  # later BUY of user 1
    assert process_batch(raw_df(b0), 0, root) == [day(1), day(2), day(3), None]  # first BUY of user 1
    assert process_batch(raw_df(b1), 1, root) == [day(5)]
    assert process_batch(raw_df(b2), 2, root) == [day(1), day(4), None]
    assert process_batch(raw_df(b3), 3, root) == [day(3), day(5), day(6)]
    everything = raw_df(b0 + b1 + b2 + b3)
    assert _same(L.read_layer(spark, root, "gold_aggregated"), G.gold_aggregated_from_events(everything))
    assert _same(L.read_layer(spark, root, "gold_tunnel"), G.gold_tunnel_from_events(everything))


def test_random_batches_match_batch_gold(spark, raw_df):
    import random

    rng = random.Random(43)
    root = tempfile.mkdtemp(prefix="abtest-randstream-")
    seen = []
    for epoch in range(5):
        batch = []
        for i in range(40):
            batch.append(
                (
                    rng.choice([1, 2, 3, 4, None]),
                    rng.choice([None, "x"] + [f"2024-01-0{d} {h:02d}:00:00" for d in range(1, 8) for h in (8, 20)]),
                    rng.choice(["VIEW", "VIEW", "CLICK", "BUY"]),
                    rng.randrange(4),
                    "MLA",
                    rng.choice(["{e=1, f=2}", "{e=2, f=1}", "{}", None]),
                )
            )
        batch += seen[: rng.randrange(5)]  # replays of earlier rows
        seen += batch
        process_batch(raw_df(batch), epoch, root)
        everything = raw_df(seen)
        assert _same(L.read_layer(spark, root, "gold_aggregated"), G.gold_aggregated_from_events(everything)), epoch
    assert _same(L.read_layer(spark, root, "gold_tunnel"), G.gold_tunnel_from_events(raw_df(seen)))
