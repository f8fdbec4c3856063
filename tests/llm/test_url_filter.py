import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from abtest_spark.llm import url_filter as U
from abtest_spark.llm.queries import QUERIES, URL_RULES

PAGES = "page_id long, url string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[:stop]


def rule_for(host, path, rules):
    fits = []
    for r in rules:
        name, below = r.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + below):
            fits.append(r)
    return min(fits, key=lambda r: (-len(r), r), default=None)


def plain_features(url):
    url = url or ""
    host, path = parts(url)
    query = url.split("?", 1)[1].split("#")[0] if "?" in url else ""

    def bits(s):
        return round(-sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()), U.PLACES) if s else 0.0

    return [
        len(url), len(host), len(path), len(query), sum(1 for x in path.split("/") if x), len(host.split(".")) if host else 0,
        round(sum(c in "0123456789" for c in url) / max(len(url), 1), U.PLACES), sum(c in "0123456789" for c in host), host.count("-"),
        bits(url), bits(host), sum(1 for x in query.split("&") if x), max(len(x) for x in host.split(".")),
        float(url.startswith("https:")),
    ]


def plain_keys(url):
    host, path = parts(url)
    return host.split(".")[-1], ".".join(host.split(".")[-2:]), path[1:].split("/")[0] if path.startswith("/") else ""


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://a.net", "http://a.net/", "HTTP://A.Net/X?y=1&z=&&w#f", "x://y://z/",
    "http://example.net/en/", "http://m.example.net/en/1", "http://example.net/en", "http://notexample.net/en/",
    "http://example.com/de/1", "http://example.com/en/1", "http://x.org/fr/", "http://xorg/fr/", "http://org/fr/9",
    "http://org?/fr/", "http://é.ORG/fr/\nx", "ftp://h.net#/a", "http://a\n.net/b", "http://net.:80/", "://net/",
    "http://ÀB.net/", "http://" + "a" * 5000 + ".com/" + "b/" * 5000, "http://example.com/?a=b?c#d?e", "http://-.com/%20",
]


def test_hosts_paths_rules_and_features(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), PAGES)
    rules = {**URL_RULES, "a.net/X": "allow", "net/": "block"}
    url, host, path = F.col("url"), U.host_of(F.col("url")), U.path_of(F.col("url"))
    keys = U.suffix_keys(host, path)
    got = df.select(
        "url", host.alias("h"), path.alias("p"), U.rule_of(host, path, rules).alias("r"),
        U.lexical_features(url, host, path).alias("x"), *[keys[k].alias(k) for k in U.SUFFIXES],
    ).collect()
    for r in got:
        assert (r.h, r.p) == parts(r.url)
        assert r.r == rule_for(r.h, r.p, rules), r.url
        assert r.x == pytest.approx(plain_features(r.url), abs=2e-6), r.url
        assert (r.last_label, r.last_two, r.segment) == plain_keys(r.url), r.url


def test_trees_learn_what_is_not_linear():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = U.fit(x[:4000], y[:4000])
    right = (trees.probability(x[4000:]) >= 0.5) == (y[4000:] == 1)
    assert right.mean() > 0.97
    assert (U.fit(x[:9], np.ones(9)).probability(x) == 0).all()
    assert (U.fit(x[:0], y[:0]).probability(x) == 0).all()


def spam(rng):
    """A labelled URL: blocked ones have long digit-rich paths or many parameters, on any host."""
    word = lambda: "".join(rng.choice("aeioumnrstl") for _ in range(rng.randrange(3, 8)))
    host = f"{word()}.{rng.choice(['com', 'org', 'io'])}"
    if rng.random() < 0.5:
        return f"http://{host}/{word()}/{word()}.html", 0
    if rng.random() < 0.5:
        return f"http://{host}/{rng.randrange(10**12)}/{rng.randrange(10**12)}", 1
    return f"http://{host}/{word()}?" + "&".join(f"{word()}={word()}" for _ in range(6)), 1


def test_held_out_urls(spark):
    rng = random.Random(2)
    rows = [(i, *spam(rng)) for i in range(4000)]
    df = spark.createDataFrame(rows, "page_id long, url string, blocked int")
    model = U.train(df.where("page_id < 2500"), F.col("url"), F.col("blocked"), sample=1500)
    got = U.block_probability(df.where("page_id >= 2500"), F.col("url"), model).collect()
    assert len(got) == 1500 and set(got[0].asDict()) == {"page_id", "url", "blocked", "__block"}
    assert sum((r["__block"] >= 0.5) == (r.blocked == 1) for r in got) >= 0.97 * 1500


def test_rules_as_labels_on_held_out_rows(spark):
    """Trees trained from one part of the rows that rules decide, tried on the other part."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    host, path = U.host_of(F.col("url")), U.path_of(F.col("url"))
    pages = pages.withColumn("rule", U.rule_of(host, path, URL_RULES)).where("rule is not null")
    verdicts = {r: int(v == "block") for r, v in URL_RULES.items()}
    df = pages.withColumn("blocked", F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv])[F.col("rule")])
    held = F.crc32(F.col("url").cast("binary")) % 3 == 0
    model = U.train(df.where(~held), F.col("url"), F.col("blocked"))
    got = U.block_probability(df.where(held), F.col("url"), model).collect()
    assert len(got) > 300
    assert sum((r["__block"] >= 0.5) == (r.blocked == 1) for r in got) >= 0.98 * len(got)


def test_edge_rows_repeats_and_other_columns(spark):
    rows = [(i if i % 5 else None, u, "x", 1.0) for i, u in enumerate(URLS * 3)]
    df = spark.createDataFrame(rows, PAGES + ", host string, verdict double").repartition(3)
    got = U.filter_urls(df, URL_RULES).collect()
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter(
        (i, *parts(u), rule_for(*parts(u), URL_RULES)) for i, u, _, _ in rows
    )
    assert all(r.verdict == URL_RULES[r.rule] for r in got if r.rule)
    assert {r.verdict for r in got} <= {"allow", "block"}
    by_url = defaultdict(set)
    for r in got:
        by_url[r.host, r.path].add(r.rule)
    assert all(len(v) == 1 for v in by_url.values())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.net/")], PAGES)
    assert [r.verdict for r in U.filter_urls(df, URL_RULES).orderBy("page_id").collect()] == ["allow", "block"]
    assert U.filter_urls(df.where("false"), URL_RULES).collect() == []
    assert [r.verdict for r in U.filter_urls(df, {}).collect()] == ["allow", "allow"]


@pytest.mark.parametrize("limit", [0, 200_000])
def test_query_against_plain_python(spark, monkeypatch, limit):
    """Host, path and rule of every row, and the verdict that the fitted trees give plainly computed features."""
    monkeypatch.setattr(U, "BROADCAST_KEYS", limit)
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    models = []
    train = U.train
    monkeypatch.setattr(U, "train", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    got = {r.page_id: r for r in QUERIES["op12_url_filter"](spark, sf).collect()}
    assert len(got) == len(pages)
    labels = {p.url: URL_RULES[r] == "block" for p in pages if (r := rule_for(*parts(p.url), URL_RULES))}
    share = sum(labels.values()) / len(labels)
    n, blocked = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for u, y in labels.items():
        for k, key in enumerate(plain_keys(u)):
            n[k][key] += 1
            blocked[k][key] += y
    for p in pages:
        r = got[p.page_id]
        assert (r.host, r.path) == parts(p.url) and r.rule == rule_for(*parts(p.url), URL_RULES)
        shares = [(blocked[k][s] + share * U.PRIOR_URLS) / (n[k][s] + U.PRIOR_URLS) for k, s in enumerate(plain_keys(p.url))]
        shares = [round(s, U.PLACES) for s in shares]
        want = models[0].trees.probability(np.array([plain_features(p.url) + shares]))[0]
        assert r.block_probability == pytest.approx(want, abs=1e-6)
        assert r.verdict == (URL_RULES[r.rule] if r.rule else "block" if want >= 0.5 else "allow")
