"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is repaired by edits of its rows, in order: Keep, Rerole,
Delete, Insert. The repaired roles must read system?, (user, assistant)+, or be
none at all, which an automaton of four states accepts: nothing yet, after
system, after user, after assistant. A letter of the audit and a state give the
next state, so an audit (K, R, D, I in order) names its repair.

Costs of rows lo..hi from one state to another come as vectors of four: a
forward one from the start, a backward one from the end, which meet at the
middle row. The crossing state with the least sum is on a cheapest path; then
both halves are solved alike, so a few vectors are held besides the rows.
A forward vector also ranks its four cheapest audits. These all end by spending
the same row, so none is the beginning of another, and the rank alone tells
which crossing leads to the ASCII-least audit.

A conversation of ordinary size is solved where its rows are sorted together.
Longer ones (by a counted limit) are cut by a range shuffle into parts of
bounded size: each part's cost matrix (four entry by four exit states) is
computed on its own, the matrices of one conversation are chained, and each
part is then solved between its fixed entry and exit states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.common import cut
from abtest_spark.llm.words import Memo

LONG_ROWS = 50_000  # rows from which a conversation is cut into parts of about this many rows
LONG_BYTES = 64 << 20  # bytes of text from which it is, whatever its rows
MEMO = 50_000  # short conversations' edits remembered per task and generation
MEMO_ROWS = 64  # rows up to which they are

SPACES = " \t\n\x0b\x0c\r"
STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
NEXT = (USER, USER, ASSISTANT, USER)  # state after a user or assistant turn, whichever is due
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
TAIL = ("", "II", "I", "")  # inserts that lead from a state to an accepted one
FAR = 1 << 60
LARGEST = (1 << 63) - 1
LEGAL = ("su", "ua", "au")


def _keeps(state: int, initial: str) -> int | None:
    """State after a kept row of this initial, None where it may not follow."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _steps(kind: str) -> list[list[tuple[int, str]]]:
    """[state][next state] -> (cost, edits) that spend one row of this kind, inserts before it included."""
    table = [[(FAR, "")] * STATES for _ in range(STATES)]
    initial, cut_short = kind.lower(), kind.isupper()
    for start in range(STATES):
        state = start
        for n in range(3):  # two inserts come round to every state that inserts can reach
            ways = [(state, 3, "D")]
            if kind != "x":
                ways.append((NEXT[state], 2 + cut_short, "R"))
                kept = _keeps(state, initial)
                if kept is not None:
                    ways.append((kept, int(cut_short), "K"))
            for to, cost, letter in ways:
                table[start][to] = min(table[start][to], (cost + 2 * n, "I" * n + letter))
            state = NEXT[state]
    return table


#: Kinds of rows: x must go; s, u, a by their initial, o with another; upper case if truncated.
KINDS = {k: _steps(k) for k in "xsuaoSUAO"}
#: The ways of each kind that exist: next state -> ((state, cost, edits), ...).
INTO = {
    k: [[(p, *table[p][q]) for p in range(STATES) if table[p][q][0] < FAR] for q in range(STATES)]
    for k, table in KINDS.items()
}
BACK = {
    k: [[(q, table[p][q][0]) for q in range(STATES) if table[p][q][0] < FAR] for p in range(STATES)]
    for k, table in KINDS.items()
}


def _vector(state: int) -> list[tuple[int, int]]:
    return [(0, 0) if s == state else (FAR, 0) for s in range(STATES)]


def forward(kinds: str, lo: int, hi: int, vector: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(cost, rank of the audit) of each state after rows lo..hi, from such a vector before them."""
    for i in range(lo, hi):
        reached = []
        for q, ways in enumerate(INTO[kinds[i]]):
            best = None
            for p, cost, edits in ways:
                before = vector[p]
                if before[0] < FAR:
                    way = (before[0] + cost, before[1], edits)
                    if best is None or way < best:
                        best = way
            if best is not None:
                reached.append((best[1], best[2], q, best[0]))
        reached.sort()
        vector = [(FAR, 0)] * STATES
        for rank, (_, _, q, cost) in enumerate(reached):
            vector[q] = (cost, rank)
    return vector


def backward(kinds: str, lo: int, hi: int, vector: list[int]) -> list[int]:
    """Cost of rows lo..hi from each state, given the cost of what follows from each state."""
    for i in range(hi - 1, lo - 1, -1):
        vector = [min([cost + vector[q] for q, cost in ways], default=FAR) for ways in BACK[kinds[i]]]
    return vector


def solve(kinds: str, lo: int, hi: int, entry: int, leave: int, out: list[str]) -> None:
    """Appends the least audit of rows lo..hi from state ``entry`` to state ``leave``."""
    if hi - lo <= 1:
        if hi > lo:
            out.append(KINDS[kinds[lo]][entry][leave][1])
        return
    middle = (lo + hi) // 2
    ahead = forward(kinds, lo, middle, _vector(entry))
    behind = backward(kinds, middle, hi, [0 if s == leave else FAR for s in range(STATES)])
    crossing = min(range(STATES), key=lambda s: (ahead[s][0] + behind[s], ahead[s][1]))
    solve(kinds, lo, middle, entry, crossing, out)
    solve(kinds, middle, hi, crossing, leave, out)


def _last(vector: list[tuple[int, int]]) -> int:
    """The state in which a cheapest repair ends, before the inserts that complete it."""
    return min(range(STATES), key=lambda s: (vector[s][0] + 2 * len(TAIL[s]), vector[s][1]))


def edits(kinds: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation of rows of these kinds."""
    vector = forward(kinds, 0, len(kinds), _vector(START))
    leave = _last(vector)
    out: list[str] = []
    solve(kinds, 0, len(kinds), START, leave, out)
    return vector[leave][0] + 2 * len(TAIL[leave]), "".join(out) + TAIL[leave]


def matrix(kinds: str) -> tuple[list[int], list[int]]:
    """(costs, ranks) of the rows from each entry state (rows of four) to each exit state."""
    rows = [forward(kinds, 0, len(kinds), _vector(s)) for s in range(STATES)]
    return [c for row in rows for c, _ in row], [r for row in rows for _, r in row]


def chain(matrices: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(entry, exit) state of each part on the least repair of the parts in order."""
    vector, came = _vector(START), []
    for costs, ranks in matrices:
        reached, from_state = [], [START] * STATES
        for q in range(STATES):
            ways = [
                (vector[p][0] + costs[STATES * p + q], vector[p][1], ranks[STATES * p + q], p)
                for p in range(STATES)
                if vector[p][0] < FAR and costs[STATES * p + q] < FAR
            ]
            if ways:
                cost, before, inside, p = min(ways)
                reached.append((before, inside, q, cost))
                from_state[q] = p
        vector = [(FAR, 0)] * STATES
        for rank, (_, _, q, cost) in enumerate(sorted(reached)):
            vector[q] = (cost, rank)
        came.append(from_state)
    state, out = _last(vector), []
    for from_state in reversed(came):
        out.append((from_state[state], state))
        state = from_state[state]
    return out[::-1]


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str], int]:
    """(roles, texts) after the audit's edits, and the state behind them."""
    new_roles, new_texts, row = [], [], 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            state = _keeps(state, roles[row][:1])
            new_roles.append(roles[row])
        else:
            state = NEXT[state]
            new_roles.append(ROLE_OF[state])
        new_texts.append("" if letter == "I" else texts[row])
        row += letter != "I"
    return new_roles, new_texts, state


def fault_counts(
    kinds: list[str], faults: list[str], roles: list[str], turns: list[int | None], role: str | None, turn: int | None
) -> tuple[int, int, int, int, int]:
    """(gaps, blank, duplicate, truncated, illegal); ``role`` and ``turn`` are the last ones before these rows, if any."""
    gaps = illegal = 0
    for r in roles:
        illegal += role is not None and role[:1] + r[:1] not in LEGAL
        role = r
    for t in turns:
        if t is not None:
            gaps += turn is not None and max(0, t - turn - 1)
            turn = t
    return min(gaps, LARGEST), faults.count("b"), faults.count("d"), faults.count("t"), illegal


def kind_of(fault: str, role: str) -> str:
    if fault in ("b", "d"):
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "t" else initial


REPAIRED = (
    "conv string, part int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, roles array<string>, texts array<string>"
)
NAMES = [f.split()[0] for f in REPAIRED.split(", ")]


def _row(conv, part, counts, cost, audit, roles, texts) -> tuple:
    return (conv, part, *counts, cost, audit, roles, texts)


def _solve_whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations of rows sorted by conv and order; one may run over several batches."""
    memo = Memo(edits, MEMO)
    conv, held = None, None  # held: turns, roles, texts, faults of the conversation at hand

    def finish() -> tuple:
        turns, roles, texts, faults = held
        seen: set[tuple[str, str]] = set()
        for i, said in enumerate(zip(roles, texts, strict=True)):
            if faults[i] != "b" and said in seen:
                faults[i] = "d"
            seen.add(said)
        kinds = "".join(map(kind_of, faults, roles))
        cost, audit = memo[kinds] if len(kinds) <= MEMO_ROWS else edits(kinds)
        new_roles, new_texts, _ = repaired(audit, START, roles, texts)
        return _row(conv, 0, fault_counts(kinds, faults, roles, turns, None, None), cost, audit, new_roles, new_texts)

    for pdf in batches:
        done = []
        for c, there, known, turn, role, text, fault in zip(
            pdf["conv"], pdf["there"], pdf["known"], pdf["turn"], pdf["role"], pdf["text"], pdf["fault"], strict=True
        ):
            if held is None or c != conv:
                if held is not None:
                    done.append(finish())
                conv, held = c, ([], [], [], [])
            if there:
                for values, value in zip(held, (int(turn) if known else None, role, text, fault), strict=True):
                    values.append(value)
        if done:
            yield pd.DataFrame(done, columns=NAMES)
    if held is not None:
        yield pd.DataFrame([finish()], columns=NAMES)


SEGMENT = "conv string, part int, costs array<long>, ranks array<long>, role string, turn long"


def _unroll(pdf: pd.DataFrame) -> tuple[list[int | None], list[str], list[str], list[str]]:
    """Turns, roles, texts and faults of a part's rows; a row stands for ``n`` equal ones, all but the first duplicates."""
    turns, roles, texts, faults = [], [], [], []
    for known, turn, role, text, fault, n in zip(
        pdf["known"], pdf["turn"], pdf["role"], pdf["text"], pdf["fault"], pdf["n"], strict=True
    ):
        turns += [int(turn) if known else None] * n
        roles += [role] * n
        texts += [text] * n
        faults += [fault] + ["b" if fault == "b" else "d"] * (n - 1)
    return turns, roles, texts, faults


def _segment(pdf: pd.DataFrame) -> pd.DataFrame:
    """One part's cost matrix, its last role and its last turn."""
    turns, roles, _, faults = _unroll(pdf.sort_values("place"))
    costs, ranks = matrix("".join(map(kind_of, faults, roles)))
    last = next((t for t in reversed(turns) if t is not None), None)
    row = (pdf["conv"].iloc[0], pdf["part"].iloc[0], costs, ranks, roles[-1], last)
    return pd.DataFrame([row], columns=["conv", "part", "costs", "ranks", "role", "turn"]).astype({"turn": "Int64"})


ENTRY = "conv string, part int, entry int, leave int, final boolean, role string, turn long"


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of each part of one conversation, with the last role and turn before it."""
    pdf = pdf.sort_values("part")
    turns = [None if pd.isna(t) else int(t) for t in pdf["turn"]]
    before, last = [], None
    for t in turns:
        before.append(last)
        last = t if t is not None else last
    states = chain([(list(c), list(r)) for c, r in zip(pdf["costs"], pdf["ranks"], strict=True)])
    return pd.DataFrame(
        {
            "conv": pdf["conv"].to_numpy(),
            "part": pdf["part"].to_numpy(),
            "entry": [s for s, _ in states],
            "leave": [s for _, s in states],
            "final": [False] * (len(pdf) - 1) + [True],
            "role": [None, *pdf["role"].tolist()[:-1]],
            "turn": pd.array(before, dtype="Int64"),
        }
    )


def _solve_part(rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    """The repair of one part between its entry and exit states."""
    turns, roles, texts, faults = _unroll(rows.sort_values("place"))
    end = ends.iloc[0]
    kinds = "".join(map(kind_of, faults, roles))
    out: list[str] = []
    solve(kinds, 0, len(kinds), int(end["entry"]), int(end["leave"]), out)
    audit = "".join(out) + (TAIL[int(end["leave"])] if end["final"] else "")
    cost = forward(kinds, 0, len(kinds), _vector(int(end["entry"])))[int(end["leave"])][0]
    cost += 2 * len(TAIL[int(end["leave"])]) if end["final"] else 0
    new_roles, new_texts, _ = repaired(audit, int(end["entry"]), roles, texts)
    turn = None if pd.isna(end["turn"]) else int(end["turn"])
    counts = fault_counts(kinds, faults, roles, turns, end["role"], turn)
    row = _row(rows["conv"].iloc[0], rows["part"].iloc[0], counts, cost, audit, new_roles, new_texts)
    return pd.DataFrame([row], columns=NAMES)


def _solve_long(rows: DataFrame, n_rows: int, long_rows: int) -> DataFrame:
    """The parts of long conversations: ``rows`` as prepared by repair_conversations, of these alone."""
    spark = rows.sparkSession
    place = ["conv", "known", "turn", "role", "digest"]
    # Equal rows become one with a count, partly summed in the tasks, so copies of one row are no hot key.
    rows = rows.groupBy(*place, "text", "fault").agg(F.count("*").cast("int").alias("n"))
    said = rows.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "known", "turn")
    # The first place of what is said at several; the join may be split by adaptive skew handling.
    again = said.groupBy("c", "r", "d").agg(F.min(F.struct("known", "turn")).alias("first"), F.count("*").alias("m")).where("m > 1")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeat = (F.col("fault") != "b") & F.coalesce(F.col("first") < F.struct("known", "turn"), F.lit(False))
    rows = rows.join(again, same, "left").withColumn("fault", F.when(repeat, "d").otherwise(F.col("fault")))
    parts = max(-(-n_rows // long_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = (
        rows.drop("c", "r", "d", "first", "m")
        .repartitionByRange(parts, *place)
        .sortWithinPartitions(*place)
        .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    )
    laid = cut(laid)
    light = laid.withColumn("text", F.lit(""))
    segments = light.groupBy("conv", "part").applyInPandas(_segment, SEGMENT)
    ends = segments.groupBy("conv").applyInPandas(_chained, ENTRY)  # a row per part
    return laid.groupBy("conv", "part").cogroup(ends.groupBy("conv", "part")).applyInPandas(_solve_part, REPAIRED)


def repair_conversations(
    rows: DataFrame,
    conv: Column,
    turn: Column,
    role: Column,
    text: Column,
    there: Column | None = None,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """The repair of every conversation: conv_id, whole, part, gaps, blank, duplicate, truncated, illegal, cost, audit, roles, texts.

    Rows are taken by turn (nulls first); those of one turn by role and the
    SHA-256 of their text. A row's first fault of
    blank, duplicate (role and text seen earlier) and truncated counts. Keep
    costs 0, Rerole 2, Delete 3, Insert 2, a row truncated and not deleted 1;
    blank and duplicate rows must go. Among the cheapest edits the audit is the
    ASCII-least. ``roles`` and ``texts`` are the repaired turns.

    A conversation of at most ``long_rows`` rows and ``long_bytes`` bytes of
    text is one row (whole, part 0). A longer one is a row per part, in the
    order of ``part``: audits, roles and texts follow one another, numbers add
    up. Null roles and texts are one space; an empty role is none of the three;
    rows where ``there`` is false only name their conversation, and one that
    has no other row has zeros and an empty audit. Null conversation ids are
    one conversation. Gaps above 2^63 - 1 are that number. Other columns are not
    read; an empty table gives no rows.
    """
    said = F.coalesce(text, F.lit(" "))
    shown = F.rtrim(said, F.lit(SPACES))
    ends_well = F.substring(shown, -1, 1).isin(".", "!", "?")
    base = rows.select(
        conv.cast("string").alias("conv"),
        (F.lit(True) if there is None else there).alias("there"),
        turn.isNotNull().alias("known"),
        F.coalesce(turn.cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        said.alias("text"),
        F.sha2(said.cast("binary"), 256).alias("digest"),
        F.when(shown == "", "b").when(~ends_well, "t").otherwise("").alias("fault"),
    )
    kind = rows.select(conv.alias("c")).schema["c"].dataType
    sizes = base.where("there").groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    large = sizes.where((F.col("n") > long_rows) | (F.col("size") > long_bytes))
    n_long = large.agg(F.sum("n")).first()[0]
    ordinary = base
    if n_long:
        large = cut(large.select(F.col("conv").alias("c")))
        ordinary = base.join(large, F.col("conv").eqNullSafe(F.col("c")), "left_anti")
    ordered = ordinary.repartition("conv").sortWithinPartitions("conv", "known", "turn", "role", "digest")
    whole = ordered.drop("digest").mapInPandas(_solve_whole, REPAIRED)
    found = whole.withColumn("whole", F.lit(True))
    if n_long:
        parts = base.where("there").join(large, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
        found = found.unionByName(_solve_long(parts.drop("there"), n_long, long_rows).withColumn("whole", F.lit(False)))
    return found.select(F.col("conv").cast(kind).alias("conv_id"), "whole", *[c for c in NAMES if c != "conv"])


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there) after the damage that crc32 of ``conv_id:turn`` modulo 20 deals.

    0 drops a row (``there`` is false), 1 empties its text, 2 removes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes its role user.
    Nulls are read as one space, but a null turn stays null.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    deal = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(deal == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(deal == 1, "").when(deal == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (deal != 0).alias("there"),
        F.explode(F.when(deal == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(found: DataFrame) -> DataFrame:
    """One row per conversation: its numbers, its audit and the SHA-256 of ``role:text`` lines of its repair.

    The digest of a conversation in parts is a chain over its bytes, so its
    lines pass one task in order; they are read as a stream and not held.
    """
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    whole = found.where("whole").select(
        "conv_id", *TOTALS, "audit", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256")
    )
    parts = found.where("not whole")
    kind = found.schema["conv_id"].dataType
    numbered = parts.select(
        F.col("conv_id").cast("string").alias("conv"), "part", *TOTALS, "audit", F.posexplode_outer(lines).alias("line", "said")
    )
    first = F.coalesce(F.col("line"), F.lit(0)) == 0
    numbered = numbered.withColumns({c: F.when(first, F.col(c)) for c in [*TOTALS, "audit"]})

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = None, None  # state: totals, audits, digest, lines so far

        def finish() -> pd.DataFrame:
            row = (conv, *state[0], "".join(state[1]), state[2].hexdigest())
            return pd.DataFrame([row], columns=["conv", *TOTALS, "audit", "repaired_sha256"])

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if state is None or row.conv != conv:
                    if state is not None:
                        yield finish()
                    conv, state = row.conv, [[0] * len(TOTALS), [], hashlib.sha256(), 0]
                if row.audit is not None:
                    state[0] = [a + int(getattr(row, c)) for a, c in zip(state[0], TOTALS, strict=True)]
                    state[1].append(row.audit)
                if row.said is not None:
                    state[2].update((("\n" if state[3] else "") + row.said).encode())
                    state[3] += 1
        if state is not None:
            yield finish()

    ordered = numbered.repartition("conv").sortWithinPartitions("conv", "part", "line")
    types = "conv string, " + ", ".join(f"{c} long" for c in TOTALS) + ", audit string, repaired_sha256 string"
    long = ordered.mapInPandas(hashed, types).withColumn("conv_id", F.col("conv").cast(kind)).drop("conv")
    return whole.unionByName(long)
