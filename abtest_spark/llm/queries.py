"""Registered queries of the operators: thin, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from abtest_spark.llm import conversation, fim, lang_id, toxicity
from abtest_spark.llm.common import table
from abtest_spark.llm.html_blocks import extract_pages
from abtest_spark.llm.mixing import mix
from abtest_spark.llm.pfor import token_files, tokenizer_file
from abtest_spark.llm.pii import pseudonymize_documents
from abtest_spark.llm.pivots import exact_topk
from abtest_spark.llm.rp_forest import near_duplicate_vectors
from abtest_spark.llm.simhash import simhash_groups
from abtest_spark.llm.transducer import digests, encode_documents
from abtest_spark.llm.url_filter import filter_urls

#: Key of the pseudonyms; production passes its own secret.
PII_KEY = "example key, not a secret"

#: Domain of a source, as SQL that Spark and DuckDB read alike.
DOMAIN = "CASE WHEN source = 'src0' THEN 'web' WHEN length(source) = 4 THEN 'reference' ELSE 'forum' END"

#: Weights among siblings of the domain - language - source tree (1 where not given).
MIX_WEIGHTS = {
    ("web",): 3,
    ("reference",): 3,
    ("forum",): 2,
    ("web", "en"): 2,
    ("web", "es"): 4,
    ("reference", "en"): 3,
    ("forum", "de"): 3,
    ("forum", "en", "src10"): 5,
    ("reference", "fr", "src3"): 6,
}
MIX_FRACTION, MIX_EPOCHS, MIX_SEED = 0.6, 2, 11

#: Verdict of each address rule (host and path).
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` mixed to the weights above (columns of mixing.mix)."""
    path = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, path, MIX_WEIGHTS, MIX_FRACTION, MIX_EPOCHS, MIX_SEED)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymize_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    total = F.aggregate("__pii", F.lit(0), lambda a, x: a + x).cast("long")
    return found.select("doc_id", "text", total.alias("n_values"), F.col("__pii").alias("by_kind"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return chosen.select(
        "doc_id",
        F.col("__path")[0].alias("domain"),
        F.col("__path")[1].alias("lang"),
        F.col("__path")[2].alias("source"),
        F.col("__epoch").alias("epoch"),
        F.col("__tokens").alias("n_tokens"),
    )


def _mixture_sql() -> str:
    """The same division and prefixes in DuckDB's SQL."""
    weights = ", ".join(f"('{'/'.join(p)}', {w})" for p, w in MIX_WEIGHTS.items())
    levels = ["domain", "lang", "source"]
    steps = []
    for d in range(1, 4):
        on, parent = ", ".join(levels[:d]), ", ".join(levels[: d - 1])
        budget = "least(floor((SELECT sum(tokens) FROM leaves) * {f}), (SELECT sum(cap) FROM cap1))".format(f=MIX_FRACTION)
        up = f"FROM cap{d} c JOIN share{d - 1} s USING ({parent})" if parent else f"FROM cap{d} c, (SELECT {budget}::DOUBLE AS budget) s"
        part = f"PARTITION BY {parent}" if parent else ""
        cols = ", ".join(f"c.{x}" for x in levels[:d])
        steps.append(
            f"""
ranked{d} AS (
  SELECT {cols}, c.weight, c.cap, s.budget, row_number() OVER w AS place,
    (s.budget - coalesce(sum(c.cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(c.weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  {up}
  WINDOW w AS ({part} ORDER BY c.cap::DOUBLE / c.weight, {cols})
),
marked{d} AS (SELECT *, cap <= weight * level AS whole FROM ranked{d}),
share{d} AS (
  SELECT {on}, CASE WHEN whole THEN cap::DOUBLE
    ELSE weight * min_by(level, place) FILTER (WHERE NOT whole) OVER ({part}) END AS budget
  FROM marked{d}
)"""
        )
    caps = []
    for d in (3, 2, 1):
        on = ", ".join(levels[:d])
        below = "(SELECT *, tokens * {e} AS cap FROM leaves)".format(e=MIX_EPOCHS) if d == 3 else f"cap{d + 1}"
        path = " || '/' || ".join(levels[:d])
        caps.append(
            f"cap{d} AS (SELECT g.*, coalesce(w.weight, 1) AS weight FROM "
            f"(SELECT {on}, sum(cap)::BIGINT AS cap FROM {below} GROUP BY {on}) g "
            f"LEFT JOIN weights w ON w.path = {path})"
        )
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce({DOMAIN}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x20]+'))::BIGINT AS n_tokens
  FROM documents
),
weights(path, weight) AS (VALUES {weights}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
{", ".join(caps)},{",".join(steps)},
plan AS (
  SELECT domain, lang, source,
    CASE WHEN tokens > 0 THEN floor(budget)::BIGINT // tokens ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN floor(budget)::BIGINT % tokens ELSE 0 END AS rest
  FROM leaves JOIN share3 USING (domain, lang, source)
),
placed AS (
  SELECT d.*, whole, rest, sum(n_tokens) OVER (
    PARTITION BY domain, lang, source
    ORDER BY md5('{MIX_SEED}:' || (whole + 1) || ':' || coalesce(doc_id::VARCHAR, 'null')), n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, unnest(range(1, whole + 1)) AS epoch, n_tokens FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, whole + 1 AS epoch, n_tokens FROM placed WHERE rest > 0 AND upto <= rest
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    tagged = docs.select("doc_id", held_out.alias("held_out"), toxicity.tag(F.col("text"), model).alias("t"))
    return tagged.select(
        "doc_id",
        "held_out",
        F.col("t.score").alias("score"),
        (F.col("t.score") >= 0.7).cast("int").alias("predicted"),
        F.col("t.spans").alias("spans"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (declared: lang, host: source) and pages (declared: markup, host and suffix: url) at once."""
    none = F.lit(None).cast("string")
    documents = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    model = lang_id.train(documents, F.col("text"), F.col("lang"))
    host = lang_id.host_of(F.col("url"))
    rows = documents.select(
        "doc_id",
        F.lit(None).cast("long").alias("page_id"),
        "text",
        F.col("lang").alias("declared"),
        F.col("source").alias("host"),
        none.alias("suffix"),
    ).unionByName(
        pages.select(
            F.lit(None).cast("long").alias("doc_id"),
            "page_id",
            lang_id.visible_text(F.col("html")).alias("text"),
            lang_id.declared_language(F.col("html")).alias("declared"),
            host.alias("host"),
            lang_id.suffix_of(host).alias("suffix"),
        )
    )
    found = lang_id.identify(rows, model, F.col("text"), F.col("declared"), F.col("host"), F.col("suffix"))
    return found.select(
        "doc_id",
        "page_id",
        "declared",
        F.col("__lang").alias("lang"),
        F.round("__posterior", 6).alias("posterior"),
        F.col("__text_lang").alias("text_lang"),
        F.col("__kept").alias("kept"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation.damaged(table(spark, sf_dir, "conversations"))
    found = conversation.repair_conversations(rows, *[F.col(c) for c in ("conv_id", "turn", "role", "text", "there")])
    return conversation.digests(found)


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_token_files": op4_token_files,
    "op5_mixture": op5_mixture,
    "op6_bpe": op6_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_main_text": op8_main_text,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_language_id": op10_language_id,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_url_filter": op12_url_filter,
    "op13_conversation_repair": op13_conversation_repair,
}

_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

_FIM_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS hx FROM documents),
h AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    CAST('0x' || hx[1:8] AS BIGINT) AS h1, CAST('0x' || hx[9:16] AS BIGINT) AS h2,
    CAST('0x' || hx[17:24] AS BIGINT) AS h3, CAST('0x' || hx[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
s AS (
  SELECT doc_id, text, len(u) AS n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
    coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:len(u)], ''), '') AS s
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s
"""

def _repair_sql() -> str:
    """Damage, faults and the cheapest edits as a recursion over rows that keeps the least (cost, audit) of each state."""
    roles, steps = {conversation.USER: "user", conversation.ASSISTANT: "assistant"}, []
    for kind, table in conversation.KINDS.items():
        for state, row in enumerate(table):
            for to, (cost, edits) in enumerate(row):
                if cost < conversation.FAR:
                    at, inserted = state, []
                    for _ in edits[:-1]:
                        at = conversation.NEXT[at]
                        inserted.append(f"'{roles[at]}:'")
                    new = roles.get(conversation.NEXT[at], "")
                    steps.append(f"('{kind}', {state}, {to}, {cost}, '{edits}', [{', '.join(inserted)}]::VARCHAR[], '{new}')")
    tails = ", ".join(
        f"({k}, '{t}', {['[]', "['user:', 'assistant:']", "['assistant:']", '[]'][k]}::VARCHAR[])" for k, t in enumerate(conversation.TAIL)
    )
    byte = "list_reduce(list_prepend(xor(a, c), range(1, 9)), lambda r, k: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END))"
    return f"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, c: {byte})) % 20 AS deal
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN deal = 1 THEN '' WHEN deal = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN deal = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM dealt WHERE deal <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS shown
  FROM damaged),
faulted AS (
  SELECT *, CASE WHEN shown = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN shown NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    CASE WHEN role[1:1] IN ('s', 'u', 'a') THEN role[1:1] ELSE 'o' END AS initial,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
  FROM placed),
kinds AS (
  SELECT *, CASE WHEN fault IN ('b', 'd') THEN 'x' WHEN fault = 't' THEN upper(initial) ELSE initial END AS kind FROM faulted),
steps(kind, state, nxt, cost, edits, inserted, new_role) AS (VALUES {", ".join(steps)}),
tails(state, tail, rest) AS (VALUES {tails}),
walk(conv_id, i, state, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0::BIGINT, '', []::VARCHAR[] FROM conversations
  UNION ALL
  SELECT * FROM (
    SELECT w.conv_id, r.i, t.nxt AS state, w.cost + t.cost AS cost, w.audit || t.edits AS audit,
      list_concat(list_concat(w.lines, t.inserted), CASE right(t.edits, 1) WHEN 'D' THEN []::VARCHAR[]
        WHEN 'K' THEN [r.role || ':' || r.text] ELSE [t.new_role || ':' || r.text] END) AS lines
    FROM walk w JOIN kinds r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN steps t ON t.kind = r.kind AND t.state = w.state)
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
ends AS (
  SELECT conv_id, cost + 2 * length(tail) AS cost, audit || tail AS audit, list_concat(lines, rest) AS lines
  FROM walk w JOIN tails USING (state)
  WHERE i = (SELECT count(*) FROM placed p WHERE p.conv_id IS NOT DISTINCT FROM w.conv_id)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost + 2 * length(tail), audit || tail) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank,
    count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE_SQL: dict[str, str] = {
    "op13_conversation_repair": _repair_sql(),
    "op2_exact_topk": _TOPK_SQL,
    "op11_fill_in_middle": _FIM_SQL,
    "op5_mixture": _mixture_sql(),
}
