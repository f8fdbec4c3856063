"""Language identification by Bayesian evidence fusion.

For every row four kinds of evidence are multiplied: the likelihood of its text
under each language's character model, the likelihood of the declared language
(markup or column), the likelihood of the address suffix, and a prior from its
host. The character models are trigram counts summed over all labelled rows.
The other three come from grouped aggregations of the text's own best language:
declared (for labelled rows the label once more) and suffix tables by language, and host counts smoothed toward their
site's, which are smoothed toward the whole table's (a row's own count is taken
out of its host's and its site's).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.common import cut, packed, unpacked

MAX_LANGUAGES = 64  # labels (the most frequent) that are languages of the model
BINS = 1 << 15  # hashed byte trigrams
SMOOTH = 0.5  # added to every trigram count
DEPENDENCE = 0.25  # share of a text's trigrams counted as independent
PRIOR_ROWS = 10.0  # rows that the level above is worth in a smoothed prior
TABLE_SMOOTH = 1.0  # added to the declared and suffix counts
MIN_POSTERIOR = 0.5
MAX_STRANGE = 4.0  # nats per trigram below the language's own mean from which a text is of no known language
BROADCAST_KEYS = 200_000  # host and site tables up to this many rows (counted) are broadcast

#: A-Z lower-cased, other ASCII but letters to spaces; other bytes stay.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def trigram_codes(text: str) -> np.ndarray:
    """Hashed byte trigrams around every letter of ``text``, word edges as spaces."""
    raw = f" {text} ".encode(errors="replace").translate(LETTERS)
    b = np.frombuffer(b" ".join([b"", *raw.split(), b""]), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    code = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(17)
    return code[b[1:-1] != 32].astype(np.int64)


class LanguageModel:
    """Languages in alphabetical order and their log-probabilities per trigram; ``left_out``: labelled rows of others."""

    def __init__(self, counts: dict[str, np.ndarray], left_out: int = 0):
        self.left_out = left_out
        self.langs = sorted(counts)
        table = np.array([counts[k] for k in self.langs], np.float64).reshape(-1, BINS) + SMOOTH
        p = table / table.sum(1, keepdims=True)
        self.log = np.ascontiguousarray(np.log(p).T.astype(np.float32))
        self.typical = (p * np.log(p)).sum(1).tolist()


def train(rows: DataFrame, text: Column, lang: Column, most: int = MAX_LANGUAGES) -> LanguageModel:
    """Trigram counts of all rows whose ``lang`` is not null, per language, summed by Spark.

    Labels beyond the ``most`` frequent ones (ties by name) are no languages of
    the model, whatever junk the column holds; ``left_out`` says how many rows
    they have. Such rows are identified like any other.
    """
    labels = rows.select(lang.alias("k")).where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    labels = cut(labels)
    kept = labels.orderBy(F.desc("n"), "k").limit(most).collect()
    left_out = (labels.agg(F.sum("n")).first()[0] or 0) - sum(r["n"] for r in kept)
    known = [r["k"] for r in kept]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for t, k in zip(pdf["t"], pdf["k"], strict=True):
                total.setdefault(k, np.zeros(BINS, np.int64))
                total[k] += np.bincount(trigram_codes(t), minlength=BINS)
        for k, v in total.items():
            bins = np.flatnonzero(v)
            yield pd.DataFrame({"k": k, "bin": bins, "n": v[bins]})

    found = (
        rows.select(text.alias("t"), lang.alias("k"))
        .where(F.col("t").isNotNull() & F.col("k").isin(known))
        .mapInPandas(count, "k string, bin long, n long")
        .groupBy("k", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy("k")
        .agg(F.collect_list(F.struct("bin", "n")).alias("bins"))  # at most BINS entries
        .collect()
    )
    counts = {}
    for r in found:
        counts[r["k"]] = np.zeros(BINS, np.int64)
        for b, n in r["bins"]:
            counts[r["k"]][b] = n
    return LanguageModel(counts, left_out)


def text_evidence(text: Column, model: LanguageModel) -> Column:
    """struct(n trigrams, sums of log-probabilities per language); a null text has none."""
    width = len(model.langs)

    @F.pandas_udf("n long, sums array<double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, sums = [], []
            for t in batch:
                codes = trigram_codes(t) if t else np.zeros(0, np.int64)
                n.append(len(codes))
                total = np.zeros(width)
                for at in range(0, len(codes), 1 << 16):
                    total += model.log[codes[at : at + (1 << 16)]].sum(0, dtype=np.float64)
                sums.append(total)
            yield pd.DataFrame({"n": n, "sums": sums})

    return scored(text)


def site_of(host: Column) -> Column:
    """The last three labels of a host name: what hosts of one site share."""
    return F.regexp_extract(host, r"([^.]+(?:\.[^.]+){0,2})$", 1)


def identify(
    rows: DataFrame,
    model: LanguageModel,
    text: Column,
    declared: Column,
    host: Column,
    suffix: Column,
    accepted: list[str] | None = None,
) -> DataFrame:
    """``rows`` plus __lang, __posterior, __text_lang, __kept.

    Null evidence counts for nothing; a text without letters gives none, so its
    language is what the other evidence says, and it is not kept. Kept are rows
    whose best language is in ``accepted`` (all known ones by default), has a
    posterior of MIN_POSTERIOR or more, and whose text is not stranger than
    MAX_STRANGE. Equal posteriors go to the alphabetically first language.
    Repeated rows and other columns stay as they are (input columns of the added
    names are replaced); an empty table gives no rows; without any labelled row nothing is kept and the language is null.
    """
    if not model.langs:
        none = {"__lang": F.lit(None).cast("string"), "__posterior": F.lit(None).cast("double")}
        none |= {"__text_lang": F.lit(None).cast("string"), "__kept": F.lit(False)}
        return rows.select(packed(rows).alias("__row")).select(*unpacked(rows, "__row", {}, none))
    width = len(model.langs)
    names = F.array(*[F.lit(k) for k in model.langs])
    base = rows.select(
        packed(rows).alias("__row"),
        text_evidence(text, model).alias("__e"),
        F.lower(F.regexp_extract(declared, "^([A-Za-z]+)", 1)).alias("__declared"),
        F.lower(host).alias("__host"),
        F.lower(suffix).alias("__suffix"),
    )
    base = base.withColumns(
        {
            "__site": site_of(F.col("__host")),
            "__own": F.when(F.col("__e.n") > 0, F.array_position("__e.sums", F.array_max("__e.sums")).cast("int") - 1),
        }
    )

    def per_language(table: DataFrame, key: str) -> DataFrame:
        """(key, counts array by language) of the rows with a text."""
        counts = [F.sum((F.col("__own") == k).cast("long")) for k in range(width)]
        return table.where(F.col("__own").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.array(*counts).alias("c"))

    slim = cut(base.select("__declared", "__host", "__site", "__suffix", "__own"))
    hosts, sites = (cut(per_language(slim, k)) for k in ("__host", "__site"))
    everything = slim.where("__own is not null").groupBy("__own").count().collect()  # one row per language
    total = np.zeros(width)
    for r in everything:
        total[r["__own"]] = r["count"]
    whole = ((total + 1) / (total.sum() + width)).tolist()

    def likelihoods(key: str) -> DataFrame:
        """log P(value | language) of the values of ``key``."""
        counts = per_language(slim, key)
        sums = counts.select(F.count("*").alias("values"), *[F.sum(F.col("c")[k]).alias(f"s{k}") for k in range(width)]).first()
        out = [
            F.log((F.col("c")[k] + TABLE_SMOOTH) / ((sums[f"s{k}"] or 0) + TABLE_SMOOTH * (sums["values"] + 1)))
            for k in range(width)
        ]
        return cut(counts.select(key, F.array(*out).alias("c")))

    def attach(df: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
        small = table.count() <= BROADCAST_KEYS
        table = table.select(F.col(key), F.col("c").alias(name))
        return df.join(F.broadcast(table) if small else table, key, "left")

    for table, key, name in (
        (hosts, "__host", "__h"),
        (sites, "__site", "__p"),
        (likelihoods("__declared"), "__declared", "__d"),
        (likelihoods("__suffix"), "__suffix", "__s"),
    ):
        base = attach(base, table, key, name)

    def others(counts: Column, k: int) -> Column:
        """Count of language k in the row's host or site without the row itself."""
        return F.greatest(F.coalesce(counts[k], F.lit(0)) - (F.coalesce(F.col("__own"), F.lit(-1)) == k).cast("int"), F.lit(0))

    def smoothed(counts: Column, above: list[Column]) -> list[Column]:
        rest = [others(counts, k) for k in range(width)]
        size = sum(rest, F.lit(0.0))
        return [(rest[k] + PRIOR_ROWS * above[k]) / (size + PRIOR_ROWS) for k in range(width)]

    base = base.withColumn("__site_prior", F.array(*smoothed(F.col("__p"), [F.lit(w) for w in whole])))
    base = base.withColumn("__prior", F.array(*smoothed(F.col("__h"), [F.col("__site_prior")[k] for k in range(width)])))
    logs = [
        F.log(F.col("__prior")[k])
        + DEPENDENCE * F.col("__e.sums")[k]
        + F.coalesce(F.col("__d")[k], F.lit(0.0))
        + F.coalesce(F.col("__s")[k], F.lit(0.0))
        for k in range(width)
    ]
    base = base.withColumn("__logs", F.array(*logs)).withColumn("__top", F.array_max("__logs"))
    best = F.array_position("__logs", F.col("__top")).cast("int") - 1
    mass = F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    typical = F.array(*[F.lit(t) for t in model.typical])
    mean = F.get(F.col("__e.sums"), F.col("__best")) / F.col("__e.n")
    known = model.langs if accepted is None else accepted
    base = (
        base.withColumn("__best", best)
        .withColumn("__lang", F.get(names, F.col("__best")))
        .withColumn("__posterior", 1 / mass)
        .withColumn("__text_lang", F.get(names, F.col("__own")))
        .withColumn(
            "__kept",
            (F.col("__e.n") > 0)
            & (F.col("__posterior") >= MIN_POSTERIOR)
            & F.col("__lang").isin(list(known))
            & F.coalesce(mean >= F.get(typical, F.col("__best")) - MAX_STRANGE, F.lit(False)),
        )
    )
    added = {c: F.col(c) for c in ("__lang", "__posterior", "__text_lang", "__kept")}
    return base.select(*unpacked(rows, "__row", {}, added))


MARKUP = re.compile(r"<(script|style|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[A-Za-z/!?][^<>]*>", re.S | re.I)


def visible_text(page: Column) -> Column:
    """``page`` without markup, character references decoded; null stays null."""

    @F.pandas_udf("string")
    def shown(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import html

        for batch in batches:
            yield pd.Series([None if p is None else html.unescape(MARKUP.sub(" ", p)) for p in batch], dtype=object)

    return shown(page)


def declared_language(page: Column) -> Column:
    """The html element's lang attribute, null if it has none."""
    found = F.regexp_extract(page, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.regexp_extract(host, r"([^.]+)\.?$", 1))
