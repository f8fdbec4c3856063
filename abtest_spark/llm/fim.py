"""Fill-in-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix at two places drawn from a hash of
its id. Its bytes go into one bytearray with a sentinel before each segment, in
the text's own order; then neighbouring segments are exchanged by three
reversals (each segment, then both together), which needs no second buffer.
The inverse exchanges the segments back by the same rotation and removes the
sentinels, which gives the text exactly.

The draws are Spark expressions; the cuts are found by a vectorised scan of the
UTF-8 bytes, a piece at a time, so a text of any length needs a few bytes of
memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

PLAIN_PERCENT = 10  # documents left as they are
SPM_PERCENT = 20  # of the others, those with the suffix first
PIECE = 1 << 20  # bytes scanned at once

_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123]] = True
_INNER = np.zeros(256, bool)  # UTF-8 continuation bytes
_INNER[0x80:0xC0] = True

FORMED = "n long, form string, prefix_chars long, middle_chars long, output binary"


def _starts(raw: np.ndarray, at: int) -> np.ndarray:
    """Which bytes of the piece from ``at`` begin a unit: a run of A-Z and a-z, or one other code point."""
    piece = raw[at : at + PIECE]
    letter = _LETTER[piece]
    after = np.empty(len(piece), bool)
    after[1:] = letter[:-1]
    after[0] = at > 0 and _LETTER[raw[at - 1]]
    return ~_INNER[piece] & ~(letter & after)


def unit_places(raw: np.ndarray, h1: int, h2: int) -> tuple[int, int, int]:
    """(n units, byte place of the first cut, of the second) of UTF-8 bytes.

    The cuts are after min and max of h1 and h2 modulo n + 1 units.
    """
    counts = [int(np.count_nonzero(_starts(raw, at))) for at in range(0, len(raw), PIECE)]
    n = sum(counts)
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    places = []
    for cut in cuts:
        place, before = len(raw), 0
        for k, count in enumerate(counts):
            if cut < before + count:
                place = k * PIECE + int(np.flatnonzero(_starts(raw, k * PIECE))[cut - before])
                break
            before += count
        places.append(place)
    return n, places[0], places[1]


def code_points(raw: np.ndarray) -> int:
    return sum(int(np.count_nonzero(~_INNER[raw[at : at + PIECE]])) for at in range(0, len(raw), PIECE))


def rotate(buffer: bytearray, first: int, middle: int, last: int) -> None:
    """Exchanges the neighbouring blocks [first, middle) and [middle, last) of the buffer by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for a, b in ((first, middle), (middle, last), (first, last)):
        half = (b - a) // 2
        for at in range(0, half, PIECE):  # swaps pieces of both ends, so a reversal holds two pieces at most
            k = min(PIECE, half - at)
            left = view[a + at : a + at + k]
            right = view[b - at - k : b - at]
            kept = left[::-1].copy()
            left[:] = right[::-1]
            right[:] = kept


def transform(text: bytes, h1: int, h2: int, form: str) -> tuple[int, str, int | None, int | None, bytes]:
    """(n units, form, code points of prefix, of middle, output) of one text; ``form`` is the drawn one."""
    raw = np.frombuffer(text, np.uint8)
    n, p, q = unit_places(raw, h1, h2)
    if not text or form == "plain" or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    buffer = bytearray(text)
    buffer[q:q] = SUFFIX
    buffer[p:p] = MIDDLE
    buffer[0:0] = PREFIX
    middle = p + len(PREFIX)
    suffix = q + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return n, form, code_points(raw[:p]), code_points(raw[p:q]), bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text of an output: finds the sentinels, rotates the segments back and removes the sentinels.

    No sentinel overlaps itself or another, and only texts without any are
    transformed, so the first of each kind is the inserted one.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    size = len(buffer)
    if form == "psm":
        suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
        rotate(buffer, suffix, middle, size)
        p, q = suffix, suffix + size - middle
    else:
        prefix, middle = buffer.index(PREFIX), buffer.index(MIDDLE)
        rotate(buffer, 0, prefix, size)
        p, q = middle - prefix, size - prefix
    del buffer[q : q + len(SUFFIX)]
    del buffer[p : p + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return bytes(buffer)


def draws(doc_id: Column, seed: int = 1) -> Column:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id`` as longs (a null id counts as ``null``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``form`` is plain, psm (prefix, suffix, middle) or spm; plain texts, empty
    ones, null ones (read as empty) and texts that hold a sentinel stay as they
    are and have null prefix_chars and middle_chars. Rows that repeat an id get
    the same draws; null ids are drawn as the id ``null``. Other columns are
    not read; an empty table gives no rows.
    """

    @F.pandas_udf(FORMED)
    def formed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for text, h1, h2, form in batches:
            rows = [transform(*r) for r in zip(text, h1.tolist(), h2.tolist(), form, strict=True)]
            made = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    drawn = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        draws(F.col(id_col), seed).alias("h"),
    )
    form = (
        F.when(F.col("h")[2] % 100 >= 100 - plain, "plain").when(F.col("h")[3] % 100 < spm, "spm").otherwise("psm")
    )
    found = drawn.select("doc_id", formed("text", F.col("h")[0], F.col("h")[1], form).alias("f"))
    return found.select(
        "doc_id", "f.n", "f.form", "f.prefix_chars", "f.middle_chars", F.col("f.output").cast("string").alias("output")
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from; null without an output."""

    @F.pandas_udf("binary")
    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([None if o is None else restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output.cast("binary"), form).cast("string")


def digests(formed: DataFrame) -> DataFrame:
    """The rows of fill_in_middle with digests of the output and of the text restored from it."""
    return formed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
