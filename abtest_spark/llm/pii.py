"""Format-preserving pseudonyms for personal data.

Detected values are validated (Luhn, mod-97, real calendar days, octet ranges,
...), read as a number of their format's range, and moved by a keyed Feistel
permutation of that range. The pseudonym has the same format and passes the
same validation; equal values get equal pseudonyms in every document and in
every way of writing them; no value keeps itself.
"""

from __future__ import annotations

import datetime
import ipaddress
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtest_spark.llm.common import packed, unpacked

ROUNDS = 8
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LONG = 160  # longer values are permuted digit by digit, not as one number
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()
KINDS = ("email", "secret", "iban", "ip", "date", "phone", "ssn", "card")


class Feistel:
    """Keyed permutations of 0..n-1 for any n, by cycle-walking in the next square."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, kind: str, n: int, r: int, half: int, side: int) -> int:
        text = f"{kind}|{n}|{r}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=side.bit_length() // 8 + 9).digest(), "big")

    def _walk(self, kind: str, n: int, x: int, forward: bool) -> int:
        side = math.isqrt(n - 1) + 1
        while True:
            a, b = divmod(x, side)
            for r in range(ROUNDS) if forward else reversed(range(ROUNDS)):
                if forward:
                    a, b = b, (a + self._f(kind, n, r, b, side)) % side
                else:
                    a, b = (b - self._f(kind, n, r, a, side)) % side, a
            x = a * side + b
            if x < n:
                return x

    def move(self, kind: str, n: int, x: int) -> int:
        """x's pseudonym: the permutation, one step on, and back. A permutation without fixed points (n > 1)."""
        if n < 2:
            return x
        return self._walk(kind, n, (self._walk(kind, n, x, True) + 1) % n, False)

    def _rounds(self, kind: bytes, digits: np.ndarray, sizes: np.ndarray, forward: bool) -> np.ndarray:
        halves, mid = [slice(0, len(digits) // 2), slice(len(digits) // 2, None)], digits.astype(np.uint64)
        for r in range(ROUNDS) if forward else reversed(range(ROUNDS)):
            to, by = halves[r % 2], halves[1 - r % 2]
            text = b"%b%d|%b|" % (self.key, r, kind) + mid[by].astype(np.uint8).tobytes()
            n = len(mid[to])
            add = np.frombuffer(hashlib.shake_256(text).digest(8 * n), "<u8") % sizes[to]
            mid[to] = (mid[to] + (add if forward else sizes[to] - add)) % sizes[to]
        return mid

    def move_digits(self, kind: str, digits: list[int], sizes: list[int]) -> list[int]:
        """The same for a value of any length, given as digits below ``sizes``: each half is moved by the other in turn,
        so every digit depends on all of them and the time grows with the length."""
        s, k = np.array(sizes, np.uint64), f"{kind}|{len(sizes)}".encode()
        mid = self._rounds(k, np.array(digits, np.uint64), s, True)
        return self._rounds(k, (mid + np.uint64(1)) % s, s, False).tolist()


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def fill_digits(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


#: Letters and digits that are permuted among themselves; capitals go with their small letters.
CLASSES = (
    "".join(map(chr, range(0x61, 0x7B))),  # a-z
    "0123456789",
    "".join(chr(i) for i in range(0xE0, 0xFF) if i != 0xF7),  # accented Latin-1
    "".join(map(chr, range(0x430, 0x450))),  # Cyrillic
    "".join(chr(i) for i in range(0x3B1, 0x3CA) if i != 0x3C2),  # Greek but the final sigma
)
PLACE = {c: (k, i) for k, letters in enumerate(CLASSES) for i, c in enumerate(letters)}


def move_characters(f: Feistel, kind: str, text: str) -> str:
    """Letters and digits of ``text`` permuted within their class of ``CLASSES``; case and other characters stay."""
    low = [c.lower() if len(c.lower()) == 1 else c for c in text]
    at = [PLACE.get(c) for c in low]
    shape = kind + "".join(c if p is None else CLASSES[p[0]][0] for c, p in zip(low, at, strict=True))
    sizes = [1 if p is None else len(CLASSES[p[0]]) for p in at]
    if len(text) > LONG:
        new = f.move_digits(shape, [0 if p is None else p[1] for p in at], sizes)
    else:
        x, n = 0, 1
        for p, s in zip(at, sizes, strict=True):
            if p is not None:
                x, n = x * s + p[1], n * s
        y, new = f.move(shape, n, x), [0] * len(at)
        for i in range(len(at) - 1, -1, -1):
            if at[i] is not None:
                y, new[i] = divmod(y, sizes[i])
    moved = (c if p is None else CLASSES[p[0]][d] for c, p, d in zip(text, at, new, strict=True))
    return "".join(d.upper() if p is not None and c.isupper() else d for c, p, d in zip(text, at, moved, strict=True))


def _hex(f: Feistel, text: str) -> str:
    """A run of hex digits stays one."""
    if len(text) > LONG:
        new = "".join(f"{d:x}" for d in f.move_digits("hex", [int(c, 16) for c in text], [16] * len(text)))
    else:
        new = f"{f.move('hex', 16 ** len(text), int(text, 16)):0{len(text)}x}"
    return new.upper() if text.upper() == text and text.lower() != text else new


def email(f: Feistel, m: re.Match) -> str | None:
    local, _, host = m[0].rpartition("@")
    labels = host.split(".")
    moved = [move_characters(f, "host", x) for x in labels[:-1]]
    return f"{move_characters(f, 'local', local)}@{'.'.join([*moved, labels[-1]])}"


def secret(f: Feistel, m: re.Match) -> str | None:
    value = m["named"] or m["hex"]
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
        new = _hex(f, value)
    elif re.search("[0-9]", value) and re.search("[A-Za-z]", value):
        new = move_characters(f, "secret", value)
    else:
        return None
    return m[0][: len(m[0]) - len(value)] + new


def iban(f: Feistel, m: re.Match) -> str | None:
    plain = m[0].replace(" ", "")
    if not m[0].isupper() and sum(c.isdigit() for c in plain) < 10:
        return None  # words in small letters
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = move_characters(f, f"iban{plain[:2].upper()}", plain[4:])
    check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{plain[:2]}00")) % 97
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in m[0])


def ip(f: Feistel, m: re.Match) -> str | None:
    if m["six"]:
        return ip6(f, m["six"])
    parts = m[0].split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    y = f.move("ip", 2**32, int.from_bytes(bytes(map(int, parts)), "big"))
    return ".".join(map(str, y.to_bytes(4, "big")))


def ip6(f: Feistel, text: str) -> str | None:
    """Stays compressed or written out, and in its case."""
    try:
        x = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    if not re.search("[0-9]", text) or x < 1 << 16:
        return None
    new = ipaddress.IPv6Address(f.move("ip6", 2**128, x))
    new = str(new) if "::" in text or min(map(len, text.split(":"))) < 4 else new.exploded
    return new.upper() if text.upper() == text else new


def date(f: Feistel, m: re.Match) -> str | None:
    if m["month"]:
        return worded_date(f, m)
    a, sep, b, c = m["a"], m["sep"], m["b"], m["c"]
    year_first = len(a) == 4
    if len(c) != 4 and (not year_first or len(c) > 2):
        return None
    orders = [(a, b, c)] if year_first else [(c, b, a)] if sep == "." else [(c, b, a), (c, a, b)]
    for k, (y, mo, d) in enumerate(orders):  # with slashes and dashes: day first, else month first
        try:
            day = datetime.date(int(y), int(mo), int(d)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            continue
        new = datetime.date.fromordinal(FIRST_DAY + f.move("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
        wide = lambda v, old: f"{v:02d}" if len(old) == 2 else str(v)
        day_text, month_text = wide(new.day, d), wide(new.month, mo)
        if year_first:
            return f"{new.year}{sep}{month_text}{sep}{day_text}"
        return sep.join([month_text, day_text, str(new.year)] if k else [day_text, month_text, str(new.year)])
    return None


def worded_date(f: Feistel, m: re.Match) -> str | None:
    """A day, the English name of a month (or its first three letters) and a year."""
    name = m["month"]
    try:
        day = datetime.date(int(m["year"]), MONTHS.index(name[:3].lower()) + 1, int(m["day"])).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    new = datetime.date.fromordinal(FIRST_DAY + f.move("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
    month = new.strftime("%b" if len(name) == 3 else "%B")
    return f"{new.day} {month} {new.year}"


def phone(f: Feistel, m: re.Match) -> str | None:
    """The country code stays; the other digits move."""
    shape = m["rest"] or m["plain"]
    rest = re.sub(r"\D", "", shape)
    if not 7 <= len(rest) <= 14:
        return None
    new = f"{f.move('phone', 10 ** len(rest), int(rest)):0{len(rest)}d}"
    return m[0][: len(m[0]) - len(shape)] + fill_digits(shape, new)


def ssn(f: Feistel, m: re.Match) -> str | None:
    """Area 001..899 but 666, group 01..99, serial 0001..9999: 898 * 99 * 9999 numbers."""
    area, group, serial = (int(x) for x in m[0].split("-"))
    if area in (0, 666) or area > 899 or group == 0 or serial == 0:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(f.move("ssn", 898 * 99 * 9999, x), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def card(f: Feistel, m: re.Match) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = f"{f.move('card', 10**n, int(digits[:-1])):0{n}d}"
    return fill_digits(m[0], body + luhn_digit(body))


#: (kind, character that a text must hold, pattern, function), in order of precedence.
DETECTORS: list[tuple[str, str, re.Pattern, Callable]] = [
    (
        "email",
        "@",
        re.compile(
            r"(?<![\w.%+-])[\w.%+-]+@[^\W_](?:[^\W_]|-){0,62}(?:\.(?:[^\W_]|-){1,63})*\.[^\W\d_]{2,24}(?![^\W_])"
        ),
        email,
    ),
    (
        "secret",
        "",
        re.compile(
            r"(?i:\b(?:token|api[_-]?key|secret|password|passwd)\b\s{0,4}[=:]\s{0,4}[\"']?)(?P<named>[A-Za-z0-9+/_-]{16,})"
            # random hex digits of such a length hold a letter: without any, a longer run is a number
            r"|(?<![A-Za-z0-9])(?P<hex>[0-9]{32,512}|(?=[0-9]*[a-f])[0-9a-f]{32,}|(?=[0-9]*[A-F])[0-9A-F]{32,})(?![A-Za-z0-9])",
            re.A,
        ),
        secret,
    ),
    (
        "iban",
        "",
        re.compile(
            r"(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
            r"|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])",
            re.A,
        ),
        iban,
    ),
    (
        "ip",
        "",
        re.compile(
            r"(?<!\d)(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
            r"|(?<![\w:])(?P<six>(?=[0-9A-Fa-f]{0,4}:)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:])",
            re.A,
        ),
        ip,
    ),
    (
        "date",
        "",
        re.compile(
            r"(?<!\d)(?<!\d[./-])(?P<a>\d{4}|\d{1,2})(?P<sep>[-./])(?P<b>\d{1,2})(?P=sep)(?P<c>\d{1,4})(?![./-]?\d)"
            r"|(?<![\d.,])(?P<day>\d{1,2}) (?P<month>(?i:january|february|march|april|may|june|july|august|september|october"
            r"|november|december|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)) (?P<year>\d{4})(?!\d)",
            re.A,
        ),
        date,
    ),
    (
        "phone",
        "",
        re.compile(
            r"(?<![\d+])\+\d{1,3}(?P<rest>(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{2,5})(?:[ .-]?\d{2,5}){1,4})(?!\d)"
            r"|(?<!\d)(?<!\d[.-])(?P<plain>\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4})(?!-?\d)",
            re.A,
        ),
        phone,
    ),
    ("ssn", "-", re.compile(r"(?<!\d)(?<!\d-)\d{3}-\d{2}-\d{4}(?!-?\d)", re.A), ssn),
    (
        "card",
        "",
        re.compile(
            r"(?<!\d)(?<!\d[.,-])(?:\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,7}|\d{4}(?P<t>[ -])\d{6}(?P=t)\d{5})(?![.,]?\d)",
            re.A,
        ),
        card,
    ),
]
ANY = re.compile("[0-9@]")


def pseudonymize_text(f: Feistel, text: str) -> tuple[str, list[int]]:
    """The text with its personal data replaced, and how many values of each of ``KINDS``."""
    counts = [0] * len(KINDS)
    if not ANY.search(text):
        return text, counts
    taken: list[tuple[int, int, str]] = []
    for k, (_, needs, pattern, make) in enumerate(DETECTORS):
        if needs and needs not in text:
            continue
        found = []
        for m in pattern.finditer(text):
            new = make(f, m)
            if new is not None:
                found.append((m.start(), m.end(), new))
        if found and taken:
            found = _apart(taken, found)
        counts[k] = len(found)
        taken = sorted(taken + found)
    out, at = [], 0
    for a, b, new in taken:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), counts


def _apart(taken: list[tuple[int, int, str]], found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of ``found`` that touch none of ``taken``; both are sorted."""
    out, i = [], 0
    for span in found:
        while i < len(taken) and taken[i][1] <= span[0]:
            i += 1
        if i == len(taken) or taken[i][0] >= span[1]:
            out.append(span)
    return out


def pseudonymize(text: Column, key: str) -> Column:
    """struct(text, counts array of KINDS); a null text stays null with counts of zero."""

    @F.pandas_udf("text string, counts array<int>")
    def moved(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = Feistel(key.encode())
        f.move = lru_cache(100_000)(f.move)
        for batch in batches:
            rows = [(None, [0] * len(KINDS)) if t is None else pseudonymize_text(f, t) for t in batch]
            yield pd.DataFrame(rows, columns=["text", "counts"])

    return moved(text)


def pseudonymize_documents(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, plus ``__pii`` (values found of each of KINDS).

    All other columns, repeated rows and nulls stay as they are (an input column
    named __pii is replaced); empty texts stay empty; an empty table gives no
    rows.
    """
    found = docs.select(packed(docs).alias("row"), pseudonymize(F.col(f"`{text_col}`"), key).alias("moved"))
    return found.select(
        *unpacked(docs, "row", {text_col: F.col("moved.text")}, {"__pii": F.col("moved.counts")})
    )
