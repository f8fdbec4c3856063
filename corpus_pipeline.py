"""Corpus pipeline: language ID, SimHash near-dedup, PII, mixture, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages are
written as Parquet and reread by the next. All but the last return the columns
of ``documents``. A stage works on whatever its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abtest_spark.llm import lang_id
from abtest_spark.llm.common import bounded_batches, scratch, table
from abtest_spark.llm.pfor import tokenizer_file
from abtest_spark.llm.pii import pseudonymize_documents
from abtest_spark.llm.queries import PII_KEY, mixed
from abtest_spark.llm.simhash import drop_near_duplicates
from abtest_spark.llm.transducer import digests, encode_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified stay; ``lang`` becomes the identified one."""
    bounded_batches(spark)
    model = lang_id.train(docs, F.col("text"), F.col("lang"))
    none = F.lit(None).cast("string")
    found = lang_id.identify(docs, model, F.col("text"), F.col("lang"), F.col("source"), none)
    return found.where("__kept").withColumn("lang", F.col("__lang")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: three-word shingles, three bits."""
    bounded_batches(spark)
    return drop_near_duplicates(docs, shingle=3, max_bits=3).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; ``n_chars`` follows the new text."""
    bounded_batches(spark)
    moved = pseudonymize_documents(docs, PII_KEY)
    return moved.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mixture, once per epoch they are chosen in."""
    bounded_batches(spark)
    return mixed(docs).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    bounded_batches(spark)
    return digests(encode_documents(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("pii", pii),
    ("mixture", mixture),
    ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Feistel pseudonyms and BPE have no SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None
