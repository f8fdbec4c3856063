import hashlib

import corpus_pipeline as cp
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from abtest_spark.llm.pfor import tokenizer_file
from abtest_spark.llm.pii import Feistel, pseudonymize_text
from abtest_spark.llm.queries import PII_KEY
from abtest_spark.llm.simhash import fingerprints

SF = "/root/testdata/sf0.001"
ODD = [(None, None, None, None, None), (-1, "", "en", "src0", 0), (-2, "!!! 12", None, None, 6), (-3, "the of and", None, "src1", 10)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema)).unionByName(docs.limit(3)).cache()
    named = cp.language_id(spark, docs, SF)
    assert named.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in named.collect()} == {None, -1, -2}
    single = cp.simhash_dedup(spark, docs, SF)
    prints = {r.doc_id: int(fingerprints([(r.text or "").encode()], 3)[0]) for r in docs.collect() if r.doc_id is not None}
    label = dict.fromkeys(prints)
    for i in sorted(prints):
        if label[i] is None:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] is None:
                    label[j] = i
                    todo += [k for k in prints if label[k] is None and (prints[j] ^ prints[k]).bit_count() <= 3]
    ids = [r.doc_id for r in single.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(set(label.values())) and single.columns == docs.columns
    hidden = cp.pii(spark, docs, SF)
    f = Feistel(PII_KEY.encode())
    want = []
    for i, t, lang, source, _ in docs.collect():
        new = None if t is None else pseudonymize_text(f, t)[0]
        want.append((i, new, lang, source, None if new is None else len(new)))
    assert hidden.columns == docs.columns and rows_of(hidden) == sorted(want, key=str)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        assert name == "bpe" or out.columns == docs.columns


def test_run_against_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
    library = Tokenizer.from_file(tokenizer_file())
    want = []
    for r in docs.select("doc_id", F.col("text")).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    assert rows_of(cp.run(spark, SF)) == sorted(want, key=str)
