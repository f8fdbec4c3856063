import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from abtest_spark.llm import conversation as C
from abtest_spark.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"
ROLES = re.compile(r"(s?(ua)+)?")
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def exhaustive(kinds):
    """Every edit sequence with at most two inserts in a row: the least (cost, audit) whose roles are legal."""
    best = None

    def go(i, roles, audit, cost, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(kinds) and ROLES.fullmatch(roles):
            best = min(best or (cost, audit), (cost, audit))
        if inserts < 2:
            for r in "ua":
                go(i, roles + r, audit + "I", cost + 2, inserts + 1)
        if i < len(kinds):
            k = kinds[i]
            go(i + 1, roles, audit + "D", cost + 3, 0)
            if k != "x":
                go(i + 1, roles + k.lower(), audit + "K", cost + k.isupper(), 0)
                for r in "ua":
                    go(i + 1, roles + r, audit + "R", cost + 2 + k.isupper(), 0)

    go(0, "", "", 0, 0)
    return best


def test_least_of_all_edits():
    rng = random.Random(3)
    cases = {"".join(rng.choice("xsuaoSUAO") for _ in range(n)) for n in range(5) for _ in range(60)}
    for kinds in sorted(cases):
        assert C.edits(kinds) == exhaustive(kinds), kinds


def greedy(kinds):
    """Costs to go from every row and state, then the smallest letter that stays cheapest."""
    go = [[2 * len(t) for t in C.TAIL]]
    for k in reversed(kinds):
        go.append([min(c + go[-1][q] for q, (c, _) in enumerate(row)) for row in C.KINDS[k]])
    go.reverse()
    state, i, audit, total = 0, 0, "", go[0][0]
    while i < len(kinds) or go[i][state]:
        moves = []
        if i < len(kinds):
            k = kinds[i]
            moves.append(("D", 3, i + 1, state))
            if k != "x":
                kept = C._keeps(state, k.lower())
                if kept is not None:
                    moves.append(("K", int(k.isupper()), i + 1, kept))
                moves.append(("R", 2 + k.isupper(), i + 1, C.NEXT[state]))
        moves.append(("I", 2, i, C.NEXT[state]))
        letter, _, i, state = min(m for m in moves if m[1] + go[m[2]][m[3]] == go[i][state])
        audit += letter
    return total, audit


def test_long_sequences_and_parts():
    rng = random.Random(4)
    for n in (1, 2, 7, 40, 333):
        for _ in range(8):
            kinds = "".join(rng.choice("xsuaoSUAOuaua") for _ in range(n))
            want = greedy(kinds)
            assert C.edits(kinds) == want
            cuts = sorted(rng.sample(range(1, n), min(n - 1, 4)))
            parts = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
            ends = C.chain([C.matrix(p) for p in parts])
            out = []
            for p, (a, b) in zip(parts, ends, strict=True):
                C.solve(p, 0, len(p), a, b, out)
            assert "".join(out) + C.TAIL[ends[-1][1]] == want[1]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        said = [" " if v is None else v for v in (conv, turn, role, text)]
        deal = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        role, text = said[2:]
        if deal == 0:
            continue
        if deal == 1:
            text = ""
        if deal == 2:
            text = re.sub("[.!?]", "", text)
        if deal == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if deal == 3 else 1)
    return out


def order(r):
    return r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()


def plainly(rows, dealt):
    """The contract with Python loops over whole conversations."""
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in dealt if r[0] == conv], key=order)
        seen, faults = set(), []
        for _, _, role, text in mine:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        roles = [r[2] for r in mine]
        kinds = "".join(
            "x" if f in ("b", "d") else (i.upper() if f else i)
            for f, i in ((f, r[:1] if r[:1] in ("s", "u", "a") else "o") for f, r in zip(faults, roles, strict=True))
        )
        cost, audit = greedy(kinds)
        lines, state, i = [], 0, 0
        for letter in audit:
            if letter == "D":
                i += 1
                continue
            role = roles[i] if letter == "K" else {2: "user", 3: "assistant"}[C.NEXT[state]]
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(role + ":" + ("" if letter == "I" else mine[i][3]))
            i += letter != "I"
        turns = {r[1] for r in mine if r[1] is not None}
        want[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return want


def run(df, **limits):
    rows = C.damaged(df)
    cols = [F.col(c) for c in ("conv_id", "turn", "role", "text", "there")]
    return C.digests(C.repair_conversations(rows, *cols, **limits))


def as_dict(df):
    got = df.collect()
    out = {r.conv_id: tuple(r[c] for c in [*COLUMNS, "repaired_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


def some_rows(n, convs, seed):
    rng = random.Random(seed)
    texts = ["Hi.", "Hi.", "", None, " \t", "no end", "Why?  ", "Yes!\n", "é日", "x" * 300 + ".", "a.b", "?"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "sudo"]
    ids = [None, *range(convs)]
    turns = [None, *range(-2, 12), 10**6]
    return [(rng.choice(ids), rng.choice(turns), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = some_rows(600, 40, 1) + [(77, 3, "user", "One.")] * 5
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", audit string, part int").repartition(4)
    assert as_dict(run(df)) == plainly(rows, damage(rows))


@pytest.mark.parametrize("limits", [{"long_rows": 12}, {"long_bytes": 200}, {"long_rows": 1, "long_bytes": 1}])
def test_long_conversations_in_parts(spark, limits):
    rows = some_rows(400, 6, 2) + [(99, i // 2, "user", "Same.") for i in range(120)] + [(98, 1, "assistant", "x")] * 50
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    found = C.repair_conversations(C.damaged(df), *[F.col(c) for c in ("conv_id", "turn", "role", "text", "there")], **limits)
    assert found.where("not whole").groupBy("conv_id").count().agg(F.max("count")).first()[0] > 2
    assert as_dict(C.digests(found)) == plainly(rows, damage(rows))


def test_nothing_left_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 1, "user", "Hi.")], ROWS)
    assert as_dict(run(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(df.where("false")).collect() == []


def test_huge_turns_do_not_overflow(spark):
    df = spark.createDataFrame([(1, -(2**63), "user", "A."), (1, 2**63 - 1, "assistant", "B.")], ROWS)
    cols = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    assert C.repair_conversations(df, *cols).first()["gaps"] == 2**63 - 1


def test_repaired_turns_are_given(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be."), (1, 1, "assistant", "B."), (1, 2, "user", "C.")], ROWS)
    r = C.repair_conversations(df, *[F.col(c) for c in ("conv_id", "turn", "role", "text")]).first()
    assert (r.cost, r.audit) == (4, "KIKKI")
    assert list(zip(r.roles, r.texts, strict=True)) == [
        ("system", "Be."), ("user", ""), ("assistant", "B."), ("user", "C."), ("assistant", "")
    ]


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = as_dict(QUERIES["op13_conversation_repair"](spark, sf))
    assert got == plainly(rows, damage(rows))
    assert len({v[6] for v in got.values()}) > 5
    assert all(len(list(g)) for _, g in groupby(sorted(got)))
