import hashlib
import random
import re

import pytest

from abtest_spark.llm import fim
from abtest_spark.llm.fim import digests, draws, fill_in_middle, restore, restored, rotate, transform
from abtest_spark.llm.queries import QUERIES

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plainly(doc_id, text):
    """The contract, said with string slices."""
    text = text or ""
    hx = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hx[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("piece", [1, 2, 3, 1 << 20])
def test_rotation_exchanges_blocks_in_place(monkeypatch, piece):
    monkeypatch.setattr(fim, "PIECE", piece)
    for n in range(8):
        for i in range(n + 1):
            for j in range(i, n + 1):
                buffer = bytearray(range(n))
                rotate(buffer, i, j, n)
                assert list(buffer) == [*range(i), *range(j, n), *range(i, j)]


@pytest.mark.parametrize("piece", [1, 3, 7, 1 << 20])
def test_any_text_and_cuts(monkeypatch, piece):
    monkeypatch.setattr(fim, "PIECE", piece)
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("abZ \n<>PSM09é日😀\x00") for _ in range(rng.randrange(30)))
        units = UNITS.findall(text)
        h1, h2, form = rng.randrange(1 << 32), rng.randrange(1 << 32), rng.choice(["psm", "spm"])
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        n, got, n_p, n_m, out = transform(text.encode(), h1, h2, form)
        assert n == len(units) and restore(out, got).decode() == text
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
            assert (got, n_p, n_m, out.decode()) == ("plain", None, None, text)
        else:
            want = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
            assert (got, n_p, n_m, out.decode()) == (form, len(p), len(m), want)


TEXTS = [
    "", None, "one", "one two, three\n", "a<P>b", "<", "<S", "x<M", "été 日本 😀 déjà", "é‍", "...", "\x00\t", "w " * 5000,
    "A" * 70000, "<P", ">", "S>", "ß" * 999,
]


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(i % 40 if i % 17 else None, TEXTS[i % len(TEXTS)], "x", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n int").repartition(3)
    out = fill_in_middle(df).withColumn("back", restored_column())
    got = sorted([tuple(r)[1:6] for r in out.collect()], key=repr)
    assert got == sorted([plainly(i, t) for i, t, _, _ in rows], key=repr)
    assert sorted(r.back for r in out.collect()) == sorted(t or "" for _, t, _, _ in rows)


def restored_column():
    from pyspark.sql import functions as F

    return restored(F.col("output"), F.col("form"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert digests(fill_in_middle(empty)).collect() == []


def test_draws_are_the_hash_groups(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(7,), (None,)], "doc_id long").select(draws(F.col("doc_id")).alias("h"))
    for r, name in zip(df.collect(), ("1:7", "1:null"), strict=True):
        hx = hashlib.sha256(name.encode()).hexdigest()
        assert list(r.h) == [int(hx[8 * k : 8 * k + 8], 16) for k in range(4)]


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_fill_in_middle"](spark, sf).collect()
    assert len(got) == len(texts)
    forms = set()
    for r in got:
        n, form, p, m, out = plainly(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, p, m, sha(out), sha(texts[r.doc_id] or ""))
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}
