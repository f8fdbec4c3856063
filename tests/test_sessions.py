"""Sessions: pauses, ties, untimed events, the anonymous user."""

import datetime as dt
import random

from abtest_spark.operators import sessions as SE

EVENT = (1, "s", "{e=1}")


def bronze(raw_df, rows):
    return raw_df([(u, t, e, *EVENT) for u, t, e in rows])


def at(minutes, seconds=0):
    return (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes, seconds=seconds)).isoformat(" ")


def plainly(rows, gap=dt.timedelta(minutes=30)):
    out = []
    for user in {r[0] for r in rows}:
        mine = []
        for u, t, e in rows:
            if u == user:
                try:
                    mine.append((dt.datetime.fromisoformat(t) if t else None, e))
                except ValueError:
                    mine.append((None, e))
        runs = [[m for m in mine if m[0] is None]]
        for m in sorted((m for m in mine if m[0] is not None), key=lambda m: m[0]):
            if len(runs) > 1 and m[0] - runs[-1][-1][0] <= gap:
                runs[-1].append(m)
            else:
                runs.append([m])
        for run in runs:
            if run:
                buys = [t for t, e in run if e == "BUY"]
                steps = {e for _, e in run if e is not None}
                out.append((user, run[0][0], run[-1][0], len(run), len(steps), len(buys), buys[-1] if buys else None, bool(buys)))
    return sorted(out, key=repr)


def test_pause_of_exactly_the_gap_and_ties(raw_df):
    rows = [
        (1, at(0), "VIEW"), (1, at(30), "CART"), (1, at(30), "BUY"), (1, at(60, 1), "VIEW"), (1, at(200), "BUY"),
        (1, None, "VIEW"), (1, "not a time", "BUY"), (2, at(5), None), (None, at(0), "VIEW"), (None, at(1), "BUY"), (None, at(99), "VIEW"),
    ]
    got = SE.user_sessions(bronze(raw_df, rows)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plainly(rows)


def test_random_rows_over_partitions(raw_df):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, at(rng.randrange(900), rng.choice([0, 0, 1]))]), rng.choice(["VIEW", "BUY", None])) for _ in range(700)]
    rows += [(7, at(i), "VIEW") for i in range(0, 2000, 29)]
    got = SE.user_sessions(bronze(raw_df, rows).repartition(6)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plainly(rows)
    assert SE.user_sessions(bronze(raw_df, rows).where("false")).collect() == []


def test_summary(raw_df):
    rows = [(1, at(0), "VIEW"), (1, at(10), "BUY"), (1, at(100), "VIEW"), (1, None, "VIEW")]
    r = SE.session_summary(SE.user_sessions(bronze(raw_df, rows))).first()
    assert tuple(r) == (1, 3, 1, 4, 2, 600)
