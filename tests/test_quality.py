"""Bronze checks (FIXTURES F-1) and semantics 1-4."""

from abtest_spark.operators import quality as Q

EXP = "{a=1}"


def test_duplicates_null_safe(raw_df):
    rows = [
        (1, "2024-01-01 10:00:00", "VIEW", None, "MLA", EXP),
        (1, "2024-01-01 10:00:00", "VIEW", None, "MLA", EXP),
        (2, "2024-01-01 10:00:00", "VIEW", 5, "MLA", EXP),
    ]
    df = raw_df(rows)
    groups = Q.duplicate_groups(df).collect()
    assert len(groups) == 1 and groups[0]["count"] == 2
    assert Q.deduplicate(df).count() == 2
    assert Q.residual_duplicates(Q.deduplicate(df)).first()[0] == 0


def test_dedupe_idempotent(raw_df):
    rows = [(i % 3, None, "VIEW", None, None, None) for i in range(9)]
    once = Q.deduplicate(raw_df(rows))
    assert once.count() == 3
    assert Q.deduplicate(once).count() == 3


def test_invalid_timestamps_include_null(raw_df):
    rows = [
        (1, "not-a-time", "VIEW", 1, "MLA", EXP),
        (1, None, "VIEW", 2, "MLA", EXP),
        (1, "2024-01-01 10:00:00", "VIEW", 3, "MLA", EXP),
    ]
    df = raw_df(rows)
    assert Q.invalid_timestamps(df).count() == 2
    prof = Q.null_profile(df).first().asDict()
    assert prof == {"user_id": 0, "event_name": 0, "timestamp": 1, "experiments": 0}


def test_malformed_experiments_substring_rule(raw_df):
    rows = [
        (1, "2024-01-01 10:00:00", "VIEW", 1, "MLA", "{a/b=1}"),
        (1, "2024-01-01 10:00:00", "VIEW", 2, "MLA", "{}"),
        (1, "2024-01-01 10:00:00", "VIEW", 3, "MLA", ""),
        (1, "2024-01-01 10:00:00", "VIEW", 4, "MLA", None),
    ]
    bad = {r["item_id"] for r in Q.malformed_experiments(raw_df(rows)).collect()}
    assert bad == {2, 3}


def test_null_profile_empty_input_is_zero(raw_df):
    prof = Q.null_profile(raw_df([])).first().asDict()
    assert set(prof.values()) == {0}


def test_quality_report_counts(raw_df):
    rows = [
        (1, "2024-01-01 10:00:00", "VIEW", None, "MLA", EXP),
        (1, "2024-01-01 10:00:00", "VIEW", None, "MLA", EXP),
        (None, "not-a-time", None, 1, "MLA", "{}"),
        (2, None, "BUY", 2, "MLB", None),
    ]
    rep = {r["check"]: r["n"] for r in Q.quality_report(raw_df(rows)).collect()}
    assert rep["raw_rows"] == 4
    assert rep["bronze_rows"] == 3
    assert rep["duplicate_groups"] == 1
    assert rep["duplicate_rows_removed"] == 1
    assert rep["invalid_timestamps"] == 2
    assert rep["null_timestamp"] == 1
    assert rep["null_user_id"] == 1
    assert rep["null_event_name"] == 1
    assert rep["null_experiments"] == 1
    assert rep["malformed_experiments"] == 1
    assert rep["residual_duplicate_groups"] == 0
    assert rep["residual_duplicate_rows"] == 0


def test_nothing_but_duplicates_dropped(raw_df):
    rows = [
        (None, None, None, None, None, None),
        (1, "bad", "VIEW", 1, "MLA", "{}"),
    ]
    assert Q.deduplicate(raw_df(rows)).count() == 2
    assert Q.drop_invalid(raw_df(rows)).count() == 0


def test_quality_report_against_direct_computation(raw_df):
    import datetime as dt
    import random
    import re

    def invalid(v):
        try:
            dt.datetime.fromisoformat(v)
            return False
        except (TypeError, ValueError):
            return True

    rng = random.Random(31)
    rows = []
    for i in range(300):
        rows.append(
            (
                rng.choice([1, 2, None]),
                rng.choice([None, "nope", "2024-01-01 10:00:00", "2024-01-02 11:30:00"]),
                rng.choice(["VIEW", "BUY", None]),
                rng.randrange(3),
                rng.choice(["MLA", None]),
                rng.choice(["{a=1}", "{}", "", "{x/y=2}", "{bad}", None]),
            )
        )
    rows += rows[:80] + rows[:10]
    distinct = set(rows)
    counts = {r: rows.count(r) for r in distinct}
    want = {
        "raw_rows": len(rows),
        "null_user_id": sum(r[0] is None for r in rows),
        "null_event_name": sum(r[2] is None for r in rows),
        "null_timestamp": sum(r[1] is None for r in rows),
        "null_experiments": sum(r[5] is None for r in rows),
        "invalid_timestamps": sum(invalid(r[1]) for r in rows),
        "duplicate_groups": sum(c > 1 for c in counts.values()),
        "duplicate_rows_removed": sum(c - 1 for c in counts.values()),
        "bronze_rows": len(distinct),
        "malformed_experiments": sum(r[5] is not None and not re.search(r"\w+=\w+", r[5]) for r in distinct),
        "residual_duplicate_groups": 0,
        "residual_duplicate_rows": 0,
    }
    got = {r["check"]: r["n"] for r in Q.quality_report(raw_df(rows)).collect()}
    assert got == want


def test_one_parser_for_check_and_value(spark):
    import datetime as dt

    from abtest_spark.functions.columns import is_invalid_ts, parsed_ts

    cases = {
        "2024-01-01 23:30:00-05:00": dt.datetime(2024, 1, 2, 4, 30),
        "2024-01-01T23:30:00Z": dt.datetime(2024, 1, 1, 23, 30),
        "2024-01-01 23:30:00+0530": None,
        "2024-01-01 10:00:00.5 Europe/Madrid": dt.datetime(2024, 1, 1, 9, 0, 0, 500000),
        "2024-01-01 10:00:00": dt.datetime(2024, 1, 1, 10),
        "2024-01-05": dt.datetime(2024, 1, 5),
        "12:30:00": None,
        "T12:30:00Z": None,
        "not-a-time": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "timestamp string")
    for zone in ("UTC", "America/Bogota"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r[0]: (r[1], r[2]) for r in df.select("timestamp", parsed_ts(), is_invalid_ts()).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert all(bad == (value is None) for value, bad in got.values())
        for text, want in cases.items():
            if text != "2024-01-01 23:30:00+0530":  # offsets without a colon: as Spark reads them
                assert got[text][0] == want, (zone, text, got[text])


def _counts(df):
    return {r["check"]: r["n"] for r in df.collect()}


def test_states_of_batches_give_the_report_of_one_load(raw_df):
    rows = [
        (1, "2024-01-01 00:00:00", "BUY", 1, "s", "{a=1}"),
        (1, "2024-01-01 00:00:00", "BUY", 1, "s", "{a=1}"),
        (None, None, None, None, None, None),
        (None, "never", "VIEW", 2, "s", "{}"),
        (2, "2024-01-02 00:00:00", "VIEW", 2, None, "{a=2}"),
        (2, "2024-01-02 00:00:00", "VIEW", 2, "", "{a=2}"),
        (2, "2024-01-02 00:00:00", "VIEW", None, "2", "{a=2}"),
    ]
    batches = [rows[:3], rows[1:5], rows[2:] + rows[:1]]
    states, merged = [], None
    for b in batches:
        states.append(Q.quality_state(raw_df(b), merged))
        merged = Q.merge_states(states[0] if len(states) == 1 else merged.unionByName(states[-1].select(*merged.columns)))
    together = raw_df([r for b in batches for r in b])
    assert _counts(Q.state_report(merged)) == _counts(Q.quality_report(together))
    appended = [s.where("written = 1").count() for s in states]
    assert sum(appended) == together.distinct().count()


def test_state_knows_events_written_twice(raw_df):
    """Batches that ignored each other leave residual duplicates: the state counts them as a reread of bronze would."""
    rows = [(i % 4, "2024-01-01 00:00:00", "VIEW", i % 4, "s", "{a=1}") for i in range(9)]
    batches = [raw_df(rows[:5]), raw_df(rows[3:]), raw_df(rows[8:])]
    states = [Q.quality_state(b) for b in batches]
    merged = Q.merge_states(states[0].unionByName(states[1]).unionByName(states[2]))
    got = _counts(Q.state_report(merged))
    bronze = Q.deduplicate(batches[0]).unionByName(Q.deduplicate(batches[1])).unionByName(Q.deduplicate(batches[2]))
    want = Q.residual_counts(bronze).first()
    assert (got["residual_duplicate_groups"], got["residual_duplicate_rows"]) == tuple(want)
    assert want["residual_duplicate_groups"] == 4


def test_key_hash_tells_nulls_and_column_ends_apart(raw_df):
    from pyspark.sql import functions as F

    rows = [(1, "a", "b", 1, "s", None), (1, "a", "b", 1, None, "s"), (1, "a,b", None, 1, "s", "x"), (1, "a", "b,", 1, "s", "x"), (1, "a", "b", 1, "-", "x"), (1, "a", "b", 1, None, "x")]
    assert raw_df(rows).select(F.hex(Q.key_hash())).distinct().count() == len(rows)
    empty = raw_df(rows).where("false")
    assert set(_counts(Q.state_report(Q.merge_states(Q.quality_state(empty)))).values()) == {0}
