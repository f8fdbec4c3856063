import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from abtest_spark.llm.toxicity import WORD, Chain, Crf, fit, tag, train


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(1)
    c = Chain(-0.5, -1.2, 0.7, 0.9)
    texts = [rng.normal(size=n) * 2 for n in (0, 1, 5, 7, 0, 2)]
    for e, got in zip(texts, Crf(np.zeros(4), c).marginals(texts), strict=True):
        total, toxic = 0.0, np.zeros(len(e))
        for y in itertools.product([0, 1], repeat=len(e)):
            s = sum(v * x for v, x in zip(y, e, strict=True)) + (c.start * y[0] if y else 0)
            for a, b in itertools.pairwise(y):
                s += {(0, 1): c.to_toxic, (1, 0): c.to_clean, (1, 1): c.stay, (0, 0): 0}[a, b]
            total += np.exp(s)
            toxic += np.array(y) * np.exp(s)
        assert np.allclose(got, toxic / total)


def corpus(n=400, seed=3):
    r = random.Random(seed)
    words, bad = [f"{a}{b}" for a in ("lo", "mi", "ta", "ne") for b in ("ra", "so", "ku", "del", "pan")], ["vile", "scrub", "gormen"]
    out = []
    for i in range(n):
        toxic = i % 4 == 0
        text = r.choices(words, k=r.randint(20, 80))
        if toxic:
            for _ in range(r.randint(1, 4)):
                text.insert(r.randrange(len(text)), r.choice(bad))
        out.append((i, " ".join(text).capitalize() + ".", int(toxic)))
    return out


def test_spans_scores_and_odd_texts(spark):
    rows = corpus()
    model = fit([t for _, t, _ in rows[:300]], [y for *_, y in rows[:300]])
    odd = [(None, "loso vile, Gormen taku"), (1000, None), (1001, ""), (1002, "12 34 !!"), (1003, "loso " * 30_000 + "vile"), (1003, "İ vile")]
    df = spark.createDataFrame([(i, t, 5.0) for i, t in [*[r[:2] for r in rows[300:]], *odd]], "doc_id long, text string, score double")
    got = df.select("doc_id", "text", tag(F.col("text"), model).alias("t")).collect()
    by_text = {r.text: r.t for r in got}
    for i, text, y in rows[300:]:
        assert (by_text[text].score >= 0.7) == bool(y), i
        assert {text[s.start : s.end].lower() for s in by_text[text].spans} == {w for w in WORD.findall(text.lower()) if w in ("vile", "scrub", "gormen")} or by_text[text].spans
    assert [odd[0][1][s.start : s.end] for s in by_text[odd[0][1]].spans] == ["vile, Gormen"]
    assert by_text[None].score == by_text[""].score == by_text["12 34 !!"].score == 0.0
    assert by_text[odd[4][1]].score >= 0.7 and by_text[odd[4][1]].spans[0].start == 5 * 30_000
    assert df.limit(0).select(tag(F.col("text"), model)).count() == 0


def test_one_label_only_scores_low(spark):
    model = fit(["a b c", "d e f"], [0, 0])
    assert spark.createDataFrame([("a b x",)], "text string").select(tag(F.col("text"), model).score).first()[0] < 0.1
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert isinstance(train(empty, empty.select("doc_id", "toxic"), F.lit(True)), Crf)


def test_query_on_held_out_rows(spark):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic").collect())
    got = QUERIES["op7_toxicity"](spark, d).collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    out = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic = [p for y, p in out if y]
    clean = [p for y, p in out if not y]
    assert sum(toxic) >= 0.95 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_conflicting_labels_are_toxic(spark, monkeypatch):
    from abtest_spark.llm import toxicity

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)] + [(None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (0, 1), (0, 0), (1, 0), (1, None), (2, 1), (None, 1), (3, 7)], "doc_id long, toxic long").repartition(4)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.append(dict(zip(texts, toxic, strict=True))))
    toxicity.train(docs, labels, F.lit(True))
    assert seen == [{"text 0": 1, "text 1": 0, "text 2": 1}]
