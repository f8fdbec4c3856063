"""Bronze data-quality checks and deduplication.

Nothing is dropped except exact duplicates: nulls, unparseable timestamps and
malformed experiment strings are counted and returned as rows, never removed
(``drop_invalid`` is an explicit opt-in).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.functions.columns import is_invalid_ts, is_malformed_experiments
from abtest_spark.schema import EVENT_KEY, NULL_PROFILE_COLUMNS


def null_profile(df: DataFrame, cols: Sequence[str] = NULL_PROFILE_COLUMNS) -> DataFrame:
    """One row: number of NULLs per column (0 on an empty input)."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def invalid_timestamps(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Rows whose timestamp does not parse (NULL included)."""
    return df.where(is_invalid_ts(col))


def duplicate_groups(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Key groups occurring more than once, with their size.

    A group of copies may be huge; the count is partially aggregated on the
    map side, so each task ships one row per distinct key.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def deduplicate(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One row per key (null-safe); map-side combined like an aggregate."""
    return df.dropDuplicates(list(keys))


def residual_duplicates(bronze: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Self-check after deduplication: number of key groups still repeated."""
    return duplicate_groups(bronze, keys).agg(F.count(F.lit(1)).alias("residual_duplicate_groups"))


def residual_counts(bronze: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One row: key groups still repeated after deduplication, and their rows."""
    return duplicate_groups(bronze, keys).agg(
        F.count(F.lit(1)).alias("residual_duplicate_groups"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("residual_duplicate_rows"),
    )


def malformed_experiments(df: DataFrame, col: str = "experiments") -> DataFrame:
    """Rows whose experiments text has no ``word=word`` substring.

    A NULL experiments value is neither valid nor malformed (it only shows up
    in the null profile).
    """
    return df.where(is_malformed_experiments(col))


def drop_invalid(df: DataFrame) -> DataFrame:
    """Opt-in cleaning: drop rows with unparseable time or missing user/event."""
    return df.where(~is_invalid_ts("timestamp") & F.col("user_id").isNotNull() & F.col("event_name").isNotNull())


def grouped_by_key(raw: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Every distinct row with its multiplicity ``_n`` (map-side combined, so
    a huge group of copies ships one row per task). Its keys are bronze."""
    return raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def quality_metrics(keys: Sequence[str] = EVENT_KEY) -> list:
    """The bronze checks as aggregate columns over ``grouped_by_key`` rows:
    row-level checks are multiplicity-weighted sums, key-level checks are
    counts. Usable in ``agg`` or, during a write, in ``observe``."""
    if not (set(NULL_PROFILE_COLUMNS) | {"timestamp"}) <= set(keys):
        raise ValueError("the quality checks need the profiled columns in the key")
    n = F.col("_n")

    def weighted(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")

    row_level = {f"null_{c}": F.col(c).isNull() for c in NULL_PROFILE_COLUMNS}
    row_level["invalid_timestamps"] = is_invalid_ts("timestamp")
    return [
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("raw_rows"),
        *[weighted(cond).alias(name) for name, cond in row_level.items()],
        F.count_if(n > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_rows_removed"),
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(is_malformed_experiments("experiments")).alias("malformed_experiments"),
    ]


def quality_report(raw: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """All bronze checks as ``(check, n)`` rows, from one scan and one shuffle.

    One grouped aggregate by the event key gives every distinct row with its
    multiplicity; the checks of ``quality_metrics`` are one aggregate over
    it. The residual self-check re-groups those distinct rows on the same key
    (same partitioning, no new shuffle) and reports repeated groups and their
    rows.
    """
    grouped = grouped_by_key(raw, keys)
    checks = grouped.agg(*quality_metrics(keys))
    residual = (
        grouped.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_groups"), F.sum("_n").alias("_rows"))
        .where(F.col("_groups") > 1)
        .agg(
            F.count(F.lit(1)).alias("residual_duplicate_groups"),
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("residual_duplicate_rows"),
        )
    )
    # Each part is a single-row aggregate; lay them out as rows.
    parts = []
    for frame in (checks, residual):
        kv = F.array(
            *[F.struct(F.lit(c).alias("check"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n")) for c in frame.columns]
        )
        parts.append(frame.select(F.explode(kv).alias("_kv")).select("_kv.check", "_kv.n"))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# Quality of a table that grows by batches: a mergeable state instead of a reread
# ---------------------------------------------------------------------------

#: Row-level faults as bits of a state row's ``faults``.
FAULTS = (*[f"null_{c}" for c in NULL_PROFILE_COLUMNS], "invalid_timestamps", "malformed_experiments")


def _fault_bits() -> Column:
    conditions = [F.col(c).isNull() for c in NULL_PROFILE_COLUMNS]
    conditions += [is_invalid_ts("timestamp"), F.coalesce(is_malformed_experiments("experiments"), F.lit(False))]
    bits = F.lit(0)
    for i, c in enumerate(conditions):
        bits = bits + F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def key_hash(keys: Sequence[str] = EVENT_KEY) -> Column:
    """SHA-256 of the key columns, nulls and column ends told apart."""
    parts = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in keys]
    return F.unhex(F.sha2(F.concat_ws(",", *parts).cast("binary"), 256))


def quality_state(batch: DataFrame, state: DataFrame | None = None, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One row per distinct event of a batch of raw rows: key (hash), copies, faults, written, and the event's columns.

    ``written`` is 1 for events that ``state`` (of the batches before) does not
    hold: these are to be appended to bronze; the others were written already.
    """
    rows = grouped_by_key(batch, keys).select(
        key_hash(keys).alias("key"), F.col("_n").alias("copies"), _fault_bits().alias("faults"), *keys
    )
    if state is None:
        return rows.withColumn("written", F.lit(1).cast("long"))
    known = state.where("written > 0").select("key").distinct().withColumn("_known", F.lit(1))
    joined = rows.join(known, "key", "left")
    return joined.withColumn("written", F.when(F.col("_known").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")).drop("_known")


def merge_states(states: DataFrame) -> DataFrame:
    """One row per event of several states: copies and writes add up, faults are the event's own."""
    return states.groupBy("key").agg(
        F.sum("copies").alias("copies"), F.first("faults").alias("faults"), F.sum("written").alias("written")
    )


def state_report(state: DataFrame) -> DataFrame:
    """The ``quality_report`` rows of all batches behind a merged state, without reading raw or bronze again.

    ``residual_*`` count events that were written to bronze more than once.
    """
    n = F.col("copies")
    sums = {name: F.sum(F.when(F.col("faults").bitwiseAND(F.lit(1 << i)) != 0, n)) for i, name in enumerate(FAULTS)}
    sums["malformed_experiments"] = F.count_if(F.col("faults").bitwiseAND(F.lit(1 << (len(FAULTS) - 1))) != 0)
    again = F.col("written") > 1
    checks = state.agg(
        F.sum(n).alias("raw_rows"),
        *[c.alias(name) for name, c in sums.items()],
        F.count_if(n > 1).alias("duplicate_groups"),
        F.sum(n - 1).alias("duplicate_rows_removed"),
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(again).alias("residual_duplicate_groups"),
        F.sum(F.when(again, F.col("written"))).alias("residual_duplicate_rows"),
    )
    rows = [F.struct(F.lit(c).alias("check"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n")) for c in checks.columns]
    return checks.select(F.explode(F.array(*rows)).alias("_kv")).select("_kv.check", "_kv.n")
