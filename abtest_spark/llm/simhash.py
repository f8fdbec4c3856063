"""SimHash near-duplicates: byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in
at most three bits differ in at most three bytes, so they share at least five
positional bytes; that minimum is the count filter. The index posts each
fingerprint under byte-position sets instead of single positions, so that lists
stay short: the fourteen sets {a, b, c, d} of positions 0..7 with
a ^ b ^ c ^ d = 0. Any five positions contain one of them (they are the blocks
of a Steiner system), so every pair that passes the count filter meets in some
list, found by an ordinary equi-join on (set, 32-bit key). The pair is tallied
(shared positional bytes), kept at five or more, verified on its bits, and
emitted only in the first set that both share, so no pair appears twice.

Exact copies of a fingerprint are grouped before the index, so a group of
copies of any size is one posting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtest_spark.llm.common import connected_components, cut, packed, unpacked
from abtest_spark.llm.xxh64 import hash_windows

POSITION_SETS = [
    (a, b, c, a ^ b ^ c) for a in range(8) for b in range(a + 1, 8) for c in range(b + 1, 8) if a ^ b ^ c > c
]
CHUNK_BYTES = 2_000_000  # bytes hashed at once inside a task


def fingerprints(texts: list[bytes], shingle: int, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit fingerprints of UTF-8 texts.

    A-Z are lower-cased; words are runs outside U+0020 and U+0009..000D;
    shingles are ``shingle`` words joined by one space, repeats included; fewer
    words make one shingle of all of them; no words give zero. A bit is 1 if
    set in over half of the shingles' XXH64 hashes.
    """
    joined = [b" ".join(t.lower().split()) for t in texts]
    filled = [i for i, j in enumerate(joined) if j]
    out = np.zeros(len(texts), np.uint64)
    if not filled:
        return out
    data = b"\n".join(joined[i] for i in filled) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))  # one past each word
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = np.flatnonzero(raw[ends] == 10)  # index of each text's last word
    first = np.concatenate(([0], last[:-1] + 1))
    n = np.maximum(last - first + 1 - (shingle - 1), 1)  # shingles per text
    offset = np.concatenate(([0], np.cumsum(n)))
    word = np.arange(offset[-1]) + np.repeat(first - offset[:-1], n)
    upto = np.minimum(word + shingle - 1, np.repeat(last, n))
    h = hash_windows(data, starts[word], ends[upto], seed)
    bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = np.stack([bits[a:b].sum(0, dtype=np.int64) for a, b in zip(offset[:-1], offset[1:], strict=True)])
    out[filled] = np.packbits(counts * 2 > n[:, None], axis=1).view(">u8").ravel()
    return out


def simhash(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """Fingerprint of ``text`` (null as empty) as a signed long."""

    @F.pandas_udf(T.LongType())
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            done, part, size = [], [], 0
            for t in batch:
                part.append((t or "").encode())
                size += len(part[-1])
                if size >= CHUNK_BYTES:
                    done.append(fingerprints(part, shingle, seed))
                    part, size = [], 0
            done.append(fingerprints(part, shingle, seed))
            yield pd.Series(np.concatenate(done).view(np.int64))

    return hashed(text)


def near_pairs(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b, bits) of ``prints(rep long, fp long)``, one row per different fp, within ``max_bits``.

    Up to three bits: the count filter needs five equal bytes of eight.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the position sets guarantee pairs of at most three differing bits")

    def byte(c: Column, p: int) -> Column:
        return F.shiftrightunsigned(c, 8 * p).bitwiseAND(255)

    posts = prints.select(
        "rep",
        "fp",
        F.posexplode(
            F.array(
                *[
                    sum((F.shiftleft(byte(F.col("fp"), p), 8 * k) for k, p in enumerate(s)), F.lit(0))
                    for s in POSITION_SETS
                ]
            )
        ).alias("set", "key"),
    )
    a, b = posts.alias("a"), posts.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    same = [byte(x, p) == 0 for p in range(8)]
    tally = sum((s.cast("int") for s in same), F.lit(0))
    first = F.coalesce(
        *[F.when(same[p] & same[q] & same[r] & same[s], F.lit(i)) for i, (p, q, r, s) in enumerate(POSITION_SETS)]
    )
    return a.join(
        b,
        (F.col("a.set") == F.col("b.set"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (tally >= 8 - max_bits)
        & (F.bit_count(x) <= max_bits)
        & (first == F.col("a.set")),
    ).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), F.bit_count(x).alias("bits"))


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prints (doc_id, h, fp) of every row, groups (fp, component) of fingerprints, and of each component the row of the
    smallest doc_id and then text hash: (component, low struct<doc_id, h>).

    Fingerprints are linked, not ids: an id that repeats with different texts joins no groups.
    """
    prints = cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("h"), simhash(F.col(text_col), shingle).alias("fp")
        )
    )
    copies = cut(prints.where("doc_id is not null").groupBy("fp").agg(F.min(F.struct("doc_id", "h")).alias("low")))
    found = connected_components(near_pairs(copies.select(F.col("fp").alias("rep"), "fp"), max_bits).select("a", "b"))
    named = copies.join(found, copies["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component")
    )
    return prints, named.select("fp", "component"), named.groupBy("component").agg(F.min("low").alias("low"))


def text_hash(text: Column) -> Column:
    """SHA-256 of ``text``, null as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row (doc_id, fingerprint hex, component_id) per row of ``docs``.

    Other columns of ``docs`` are not read. Rows with a null id get their
    fingerprint and a null component and link with nothing; repeated ids stay
    repeated; null and empty texts have fingerprint zero and link like any
    other; an empty table gives no rows.
    """
    prints, groups, lowest = _grouped(docs, id_col, text_col, shingle, max_bits)
    named = groups.join(lowest, "component").select("fp", F.col("low.doc_id").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: the smallest doc_id's.

    Of rows that repeat that doc_id within the group, the one of the smallest
    text hash stays, then of the smallest hash of all columns; a doc_id that
    repeats in several groups can stay once in each. Rows without a doc_id are
    kept.
    """
    lowest = _grouped(docs, "doc_id", "text", shingle, max_bits)[2]
    kept = lowest.select(F.col("low.doc_id").alias("id"), F.col("low.h").alias("h"))
    named = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("h"), packed(docs).alias("row")
    )
    one = (
        named.join(kept, ["id", "h"], "left_semi")
        .groupBy("id", "h")
        .agg(F.min_by("row", F.struct(F.col("row.text").isNotNull(), F.xxhash64("row"))).alias("row"))
    )
    return one.select(*unpacked(docs, "row", {}, {})).unionByName(docs.where("doc_id is null"))
