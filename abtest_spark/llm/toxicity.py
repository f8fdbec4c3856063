"""Toxic spans and document scores by a linear-chain conditional random field.

Labels exist per document, the model works per token. A word counts as labelled
toxic in toxic documents if it, or a beginning of it, is far more frequent in
toxic than in clean ones (log-likelihood ratio over a bounded sample of labelled
documents, near-copies counted once); every other token is labelled clean. A CRF with two states
learns from these tokens: word, prefix and suffix features and the transitions.
Scoring runs forward-backward over whole texts; the marginals give the
offending offsets and, as the highest marginal, the document's score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.simhash import fingerprints
from abtest_spark.llm.words import Memo

SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 2500  # labelled rows (smallest id hashes) that training reads at most
SAMPLE_CHARS = 10_000  # longer documents are no training rows
SEED_RATIO = 25.0  # log-likelihood ratio from which a word, or a beginning of words, is labelled toxic
COPY_BITS = 6  # training documents whose fingerprints differ in fewer bits count once
FEATURE_BITS = 18
PASSES = 150
L2 = 1e-5
MEMO = 300_000  # words remembered per task and generation
TOKENS_AT_ONCE = 500_000
SPAN_LEVEL = 0.5  # marginal from which a token belongs to a span

WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word: itself, prefixes of 3 to 8, suffix of 3, and a bias."""
    names = ["", f"w{word}", *(f"p{word[:k]}" for k in range(3, 9) if len(word) >= k), f"s{word[-3:]}"]
    return [zlib.crc32(n.encode(errors="replace")) >> (32 - FEATURE_BITS) for n in names]


class Chain:
    """Transitions of the two-state chain relative to clean-to-clean, and its start."""

    def __init__(self, start: float, to_toxic: float, to_clean: float, stay: float):
        self.start, self.to_toxic, self.to_clean, self.stay = start, to_toxic, to_clean, stay


def forward_backward(e: np.ndarray, lengths: np.ndarray, c: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds (forward including the token, backward excluding it) of each token being toxic.

    ``e`` holds the emissions of texts one after another, longest text first;
    step t handles the t-th token of all texts that have one.
    """
    first = np.cumsum(lengths) - lengths
    ahead, back = np.empty(len(e)), np.zeros(len(e))
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")  # texts longer than t
    r = np.zeros(0)
    for t in range(longest):
        at = first[: active[t]] + t
        if t == 0:
            r = c.start + e[at]
        else:
            r = r[: active[t]]
            r = e[at] + np.logaddexp(c.to_toxic, c.stay + r) - np.logaddexp(0, c.to_clean + r)
        ahead[at] = r
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        after = e[at + 1] + back[at + 1]
        back[at] = np.logaddexp(c.to_clean, c.stay + after) - np.logaddexp(0, c.to_toxic + after)
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Crf:
    """Feature weights and chain of a trained model."""

    def __init__(self, theta: np.ndarray, chain: Chain):
        self.theta, self.chain = theta.astype(np.float32), chain

    def emission(self, word: str) -> float:
        return float(self.theta[features(word)].sum())

    def marginals(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each token being toxic, for texts in any order."""
        lengths = np.array([len(x) for x in emissions])
        out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
        order, group, held = np.argsort(-lengths, kind="stable").tolist(), [], 0
        for k, i in enumerate(order):
            group.append(i)
            held += len(emissions[i])
            if held >= TOKENS_AT_ONCE or k == len(order) - 1:
                n = lengths[group]
                ahead, back = forward_backward(np.concatenate([emissions[j] for j in group]), n, self.chain)
                for j, p in zip(group, np.split(_sigmoid(ahead + back), np.cumsum(n)[:-1]), strict=True):
                    out[j] = p
                group, held = [], 0
        return out


def stems(word: str) -> list[str]:
    """The word and its beginnings of 4 to 8 letters (marked), which stand for its inflections."""
    return [word, *(f"{word[:k]}*" for k in range(4, 9) if len(word) > k)]


def toxic_stems(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Stems far more frequent in toxic than in clean documents (document counts)."""
    counts = (Counter(), Counter())
    for words, y in zip(texts, toxic.tolist(), strict=True):
        counts[y].update({s for w in set(words) for s in stems(w)})
    n = np.array([len(toxic) - toxic.sum(), toxic.sum()], float)
    if n.min() == 0:
        return set()

    def part(k: float, m: float, p: float) -> float:
        return k * np.log(max(k / m, 1e-12) / p) + (m - k) * np.log(max(1 - k / m, 1e-12) / (1 - p))

    out = set()
    for w, a in counts[1].items():
        b = counts[0][w]
        p = (a + b) / n.sum()
        if p < 1 and a >= 4 and a / n[1] > 5 * b / n[0] and 2 * (part(a, n[1], p) + part(b, n[0], p)) >= SEED_RATIO:
            out.add(w)
    return out


def drop_copies(texts: list[str]) -> list[int]:
    """Positions of texts that are no near-copies of an earlier one."""
    prints = fingerprints([t.encode(errors="replace") for t in texts], 1)
    kept: list[int] = []
    seen = np.zeros(len(texts), np.uint64)
    for i, p in enumerate(prints):
        if not (np.bitwise_count(seen[: len(kept)] ^ p) < COPY_BITS).any():
            seen[len(kept)] = p
            kept.append(i)
    return kept


def fit(texts: list[str], toxic: list[int]) -> Crf:
    """Trains on a bounded list of texts; without both labels every text scores near zero."""
    kept = drop_copies(texts)
    y_doc = np.array([int(toxic[i]) for i in kept], np.int64)
    words = [WORD.findall(texts[i].lower()) for i in kept]
    seeds = toxic_stems(words, y_doc)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    words, y_doc = [words[i] for i in order if words[i]], y_doc[[i for i in order if words[i]]]
    theta = np.zeros(1 << FEATURE_BITS)
    weights = np.array([-2.0, -4.0, 0.0, 0.0])  # start, to toxic, to clean, stay
    if not seeds or not words:
        theta[features("")[0]] = -8.0
        return Crf(theta, Chain(*weights))
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in words for w in ws])
    lengths = np.array([len(ws) for ws in words])
    is_seed = np.array([any(s in seeds for s in stems(w)) for w in number])
    y = is_seed[ids] & (np.repeat(y_doc, lengths) == 1)
    lists = [features(w) for w in number]
    f_word = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    f_id = np.concatenate(lists)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(ids), bool)
    inner[first] = False
    at = np.flatnonzero(inner)  # tokens with a former one
    was, now = y[at - 1], y[at]
    seen = np.array([y[first].sum(), (~was & now).sum(), (was & ~now).sum(), (was & now).sum()], float)
    # AdaGrad on the mean log-likelihood of a token
    square, square_w, n = np.full(len(theta), 1e-8), np.full(4, 1e-8), len(ids)
    for _ in range(PASSES):
        e = np.bincount(f_word, theta[f_id], len(lists))[ids]
        c = Chain(*weights)
        ahead, back = forward_backward(e, lengths, c)
        p = _sigmoid(ahead + back)
        g_word = np.bincount(ids, y - p, len(lists))
        g = np.bincount(f_id, g_word[f_word], len(theta)) / n - L2 * theta
        r, after = ahead[at - 1], e[at] + back[at]
        logs = np.stack([np.zeros(len(at)), c.to_toxic + after, r + c.to_clean, r + c.stay + after])
        pair = np.exp(logs - logs.max(0))
        pair /= pair.sum(0)
        g_w = (seen - np.array([p[first].sum(), *pair[1:].sum(1)])) / n - L2 * weights
        square, square_w = square + g * g, square_w + g_w * g_w
        theta += 0.5 * g / np.sqrt(square)
        weights = weights + 0.3 * g_w / np.sqrt(square_w)
    return Crf(theta, Chain(*weights))


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Crf:
    """Fits on at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of ``docs`` joined with ``labels`` (doc_id, toxic).

    ``usable`` (of doc_id) says which rows may be learned from. Null texts and
    labels are left out; a document with conflicting labels is toxic.
    """
    known = (
        labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    short = docs.select("doc_id", "text").where(F.char_length("text") <= SAMPLE_CHARS)
    order = F.xxhash64("doc_id")

    def some(y: int, n: int) -> DataFrame:
        # a tenth more ids than rows: some belong to long or missing documents
        chosen = known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(n + n // 10)
        return short.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(n)

    rows = some(1, SAMPLE_TOXIC).unionByName(some(0, SAMPLE_CLEAN)).collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def tag(text: Column, model: Crf) -> Column:
    """struct(score, spans array<struct(start, end, p)>): offsets in code points, p the highest marginal of the span.

    Null and empty texts, and texts without words, score 0.
    """

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,p:double>>")
    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = Memo(model.emission, MEMO)
        for batch in batches:
            texts = [t or "" for t in batch]
            emissions = [
                np.fromiter(map(memo.__getitem__, WORD.findall(t.lower())), np.float64) for t in texts
            ]
            scores, spans = [], []
            for t, p in zip(texts, model.marginals(emissions), strict=True):
                scores.append(float(p.max(initial=0.0)))
                spans.append(_spans(t, p) if scores[-1] >= SPAN_LEVEL else [])
            yield pd.DataFrame({"score": scores, "spans": spans})

    return tagged(text)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic tokens. Where lower-casing changes a text's words, tokens are matched as far as they go."""
    out: list[dict] = []
    last = -2
    for i, m in enumerate(WORD.finditer(text)):
        if i >= len(p) or p[i] < SPAN_LEVEL:
            continue
        if last == i - 1:
            out[-1] = {"start": out[-1]["start"], "end": m.end(), "p": max(out[-1]["p"], float(p[i]))}
        else:
            out.append({"start": m.start(), "end": m.end(), "p": float(p[i])})
        last = i
    return out
