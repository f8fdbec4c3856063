"""URL filter: address rules, and gradient-boosted trees on lexical features for the rest.

A rule (host, path, verdict) fits its host and all subdomains below its path;
the longest fitting rule decides. Rows that a rule decides are the labelled
URLs from which the trees are trained; they judge every other row.

Features are Spark expressions: lengths, depth, digit ratio, entropy, parameter
counts and suffix statistics, the latter being smoothed shares of blocked URLs
by last label, last two labels and first path segment, counted over all
distinct labelled URLs by grouped aggregations (a labelled URL's own count is
taken out of its share). Trees are fitted on a bounded sample of distinct
labelled URLs on the driver: logistic loss, histogram splits, second-order
leaves.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.common import cut, packed, unpacked

SAMPLE = 20_000  # distinct labelled URLs that the trees are fitted on (smallest hashes)
TREES = 60
DEPTH = 3
BINS = 32  # histogram bins per feature
RATE = 0.2  # shrinkage of each tree
RIDGE = 1.0  # added to a leaf's second derivatives
LEAF_WEIGHT = 1.0  # least sum of second derivatives of a leaf
PRIOR_URLS = 5.0  # URLs that the overall share is worth in a suffix's share
BLOCK_FROM = 0.5  # probability from which the trees block
PLACES = 6  # decimals of fractional features, so that equal ones do not differ in their last bits
BROADCAST_KEYS = 200_000  # suffix tables up to this many rows (counted) are broadcast

LEXICAL = (
    "length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens",
    "entropy", "host_entropy", "parameters", "longest_label", "secure",
)
SUFFIXES = ("last_label", "last_two", "segment")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    found = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits, null if none; of equal lengths the first in the alphabet."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, at, below = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(at + below)
        out = F.when(fits, rule).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character of the text's own character distribution; 0 for the empty text."""
    n = F.char_length(text).cast("double")
    share = lambda c: F.char_length(F.replace(text, c)).cast("double")  # noqa: E731 - characters left without c
    bits = lambda c: F.when(share(c) < n, -(1 - share(c) / n) * F.log2(1 - share(c) / n)).otherwise(0.0)
    parts = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c == "", 0.0).otherwise(bits(c)))
    return F.when(n > 0, F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), PLACES)).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> Column:
    """The features of ``LEXICAL`` as array<double>, in that order."""
    address = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(address, r"\?([^#]*)", 1)
    length = F.char_length(address).cast("double")
    labels = F.split(host, r"\.")
    longest = F.array_max(F.transform(labels, lambda x: F.char_length(x))).cast("double")
    values = (
        length,
        F.char_length(host).cast("double"),
        F.char_length(path).cast("double"),
        F.char_length(query).cast("double"),
        _count(path, "/[^/]+"),
        F.when(host == "", 0.0).otherwise(F.size(labels).cast("double")),
        F.round(_count(address, "[0-9]") / F.greatest(length, F.lit(1.0)), PLACES),
        _count(host, "[0-9]"),
        _count(host, "-"),
        entropy(address),
        entropy(host),
        _count(query, "[^&]+"),
        longest,
        address.startswith("https:").cast("double"),
    )
    return F.array(*values)


def suffix_keys(host: Column, path: Column) -> dict[str, Column]:
    """What the shares of blocked URLs are counted by."""
    return {
        "last_label": F.regexp_extract(host, r"([^.]*)$", 1),
        "last_two": F.regexp_extract(host, r"([^.]*(?:\.[^.]*)?)$", 1),
        "segment": F.regexp_extract(path, "^/([^/]*)", 1),
    }


class Trees:
    """Gradient-boosted trees of fixed depth as flat arrays: feature and threshold per node, value per leaf."""

    def __init__(self, base: float, features: np.ndarray, thresholds: np.ndarray, leaves: np.ndarray):
        self.base, self.features, self.thresholds, self.leaves = base, features, thresholds, leaves

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees of rows ``x`` and labels ``y`` (0 or 1). Without both labels no tree is grown and everything has probability 0."""
    inner = 2**DEPTH - 1
    if len(y) == 0 or y.min() == y.max():
        return Trees(-np.inf, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = []  # values between bins, ascending
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="lower"))
        edges.append((values[:-1] + values[1:]) / 2)
    code = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score, made = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            at = (node - first) * BINS
            best = np.zeros(width)
            for f in range(x.shape[1]):
                bins = at + code[:, f]
                g = np.bincount(bins, slope, width * BINS).reshape(width, BINS)
                h = np.bincount(bins, curve, width * BINS).reshape(width, BINS)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAF_WEIGHT) | (ht - hl < LEAF_WEIGHT)] = 0
                split = gain.argmax(1)
                top = gain[np.arange(width), split]
                for k in np.flatnonzero(top > best + 1e-9).tolist():
                    best[k], feature[first + k] = top[k], f
                    threshold[first + k] = edges[f][split[k]] if split[k] < len(edges[f]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = RATE * np.bincount(at, slope, inner + 1) / (np.bincount(at, curve, inner + 1) + RIDGE)
        score = score + leaf[at]
        made.append((feature, threshold, leaf))
    return Trees(base, *(np.stack(m) for m in zip(*made, strict=True)))


class UrlModel:
    """Fitted trees, the overall share of blocked URLs, and the tables (key, n, blocked) by suffix kind."""

    def __init__(self, trees: Trees, share: float, tables: dict[str, tuple[DataFrame, bool]]):
        self.trees, self.share, self.tables = trees, share, tables


def _with_shares(rows: DataFrame, keys: dict[str, Column], tables: dict, share: float, own: Column | None) -> DataFrame:
    """``rows`` plus __shares: array of the smoothed blocked share of each suffix; ``own`` is a row's own label, if counted."""
    for kind, key in keys.items():
        counts, small = tables[kind]
        counts = counts.select(F.col("key").alias(f"__{kind}"), F.struct("n", "blocked").alias(f"__{kind}_n"))
        rows = rows.withColumn(f"__{kind}", key)
        rows = rows.join(F.broadcast(counts) if small else counts, f"__{kind}", "left")
    mine, one = (F.lit(0.0), F.lit(0.0)) if own is None else (own, F.lit(1.0))
    shares = [
        F.round(
            (F.coalesce(F.col(f"__{k}_n.blocked"), mine) - mine + share * PRIOR_URLS)
            / (F.coalesce(F.col(f"__{k}_n.n"), one) - one + PRIOR_URLS),
            PLACES,
        )
        for k in keys
    ]
    gone = [c for k in keys for c in (f"__{k}", f"__{k}_n")]
    return rows.withColumn("__shares", F.array(*shares)).drop(*gone)


def train(urls: DataFrame, url: Column, blocked: Column, sample: int = SAMPLE) -> UrlModel:
    """Suffix tables of all distinct URLs whose ``blocked`` is not null, and trees of at most ``sample`` of them.

    A URL with conflicting labels counts as blocked. Copies of a URL are one.
    """
    labelled = (
        urls.select(url.alias("u"), blocked.cast("double").alias("y"))
        .where("u is not null and y is not null")
        .groupBy("u")
        .agg(F.max("y").alias("y"))
    )
    labelled = cut(labelled)
    n, n_blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    share = n_blocked / n if n else 0.0
    host, path = host_of(F.col("u")), path_of(F.col("u"))
    keys, tables = suffix_keys(host, path), {}
    for kind, key in keys.items():
        counts = cut(labelled.groupBy(key.alias("key")).agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("blocked")))
        tables[kind] = (counts, counts.count() <= BROADCAST_KEYS)
    # Rows below a hash threshold that holds about 1.2 times the sample: the sort sees a bounded number of rows.
    limit = (1 << 63) if n <= sample else int((1 << 64) * min(1.0, 1.2 * sample / n + 40 * (sample**0.5) / n)) - (1 << 63)
    hashed = labelled.withColumn("k", F.xxhash64("u"))
    near = hashed if limit >= (1 << 63) else hashed.where(F.col("k") < limit)
    chosen = near.orderBy("k", "u").limit(sample)
    rows = _with_shares(chosen, keys, tables, share, F.col("y"))
    got = rows.select("k", "u", "y", F.concat(lexical_features(F.col("u"), host, path), "__shares").alias("x")).orderBy("k", "u").collect()
    x = np.array([r["x"] for r in got], np.float64).reshape(len(got), len(LEXICAL) + len(SUFFIXES))
    return UrlModel(fit(x, np.array([r["y"] for r in got], np.float64)), share, tables)


def block_probability(rows: DataFrame, url: Column, model: UrlModel) -> DataFrame:
    """``rows`` plus __block, the trees' probability that a row's URL is to be blocked (null URLs count as empty)."""
    trees = model.trees

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, len(LEXICAL) + len(SUFFIXES)))
            yield pd.Series(trees.probability(x))

    base = rows.select(packed(rows).alias("__row"), url.alias("__url"))
    host, path = host_of(F.col("__url")), path_of(F.col("__url"))
    base = _with_shares(base, suffix_keys(host, path), model.tables, model.share, None)
    features = F.concat(lexical_features(F.col("__url"), host, path), F.col("__shares"))
    return base.select(*unpacked(rows, "__row", {}, {"__block": judged(features)}))


def filter_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, block_probability) of every row of ``pages``.

    ``rules`` maps ``host/path`` to allow or block (an expression each: meant
    for up to some hundred rules). Rows without a fitting rule are judged by
    trees trained from those that have one; without any blocked or any allowed
    URL to learn from they are allowed. Null URLs and URLs without ``://`` have
    an empty host and path. Repeated rows and null ids stay as they are; other
    columns are not read; an empty table gives no rows.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host_of(url), "path": path_of(url)})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    decided = reduce(lambda acc, r: F.when(F.col("rule") == r, rules[r]).otherwise(acc), sorted(rules), F.lit(None).cast("string"))
    rows = rows.withColumn("verdict", decided)
    model = train(rows, url, F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0))
    judged = block_probability(rows, url, model)
    verdict = F.coalesce("verdict", F.when(F.col("__block") >= BLOCK_FROM, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("__block").alias("block_probability"))
