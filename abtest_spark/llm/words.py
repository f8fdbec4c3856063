"""Splitting text into the words that a word-end BPE tokenizer merges one by one."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import regex

# The pre-tokenization pattern and the special tokens' form of the vocabulary file.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WIDE = "\u0250"  # from here on libraries follow different Unicode versions
AT_WIDE = re.compile(f"[{WIDE}-\U0010ffff]")


def _below_wide(category: str) -> str:
    """Characters below WIDE of a category, as the inside of a pattern's class."""
    return "".join(re.escape(chr(i)) for i in range(ord(WIDE)) if unicodedata.category(chr(i))[0] == category)


#: ``PIECE`` for texts below WIDE, with their letters, digits and White_Space written out.
NARROW_PIECE = re.compile(
    "[{0}]+|'(?:s|t|re|ve|m|ll|d)|[{1}]|[^{2}{0}{1}]+".format(_below_wide("L"), _below_wide("N"), "\t-\r \x85\xa0")
)
GROUP_CHARS = 500_000  # of texts that are encoded together

#: Unicode White_Space. str.split() takes four control characters more (U+001C..001F).
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
CONTROL = re.compile("[\x1c-\x1f]")


def chunks(text: str) -> list[str]:
    """Runs without white space. No token spans two of them."""
    if CONTROL.search(text):
        return [c for c in SPACE.split(text) if c]
    return text.split()


class Splitter:
    """Pieces of a text or chunk as the tokenizer's own normalizer and pre-tokenizer make them.

    Special tokens stay whole; the rest is put in NFC, lower-cased by code point
    and split by ``PIECE``. Texts and chunks below WIDE are split here; for the
    others the tokenizer's components are called.
    """

    def __init__(self, tokenizer):
        self.added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special = special_pattern(list(self.added))
        self.normalize = tokenizer.normalizer.normalize_str
        self.pre_tokenize = tokenizer.pre_tokenizer.pre_tokenize_str
        self.byte = {ord(c): b for b, c in enumerate(byte_alphabet())}
        self.wide = Memo(self.pieces, 20_000)

    def pieces(self, chunk: str) -> list[bytes | int]:
        """UTF-8 bytes of each word piece; the id of each special token."""
        if chunk.isascii():
            low = chunk.lower()
            if low.isalpha():
                return [low.encode()]
            if low[:-1].isalpha():  # a word and one sign or digit behind it
                raw = low.encode()
                return [raw[:-1], raw[-1:]]
        if "<|" not in chunk:
            return self._plain(chunk)
        out = []
        for k, part in enumerate(self.special.split(chunk)):
            out += [self.added[part]] if k % 2 else self._plain(part)
        return out

    def _plain(self, part: str) -> list[bytes | int]:
        if not part:
            return []
        if max(part) < "\u0250":
            part = unicodedata.normalize("NFC", part).lower()
            return [p.encode() for p in PIECE.findall(part)]
        return [p.translate(self.byte).encode("latin-1") for p, _ in self.pre_tokenize(self.normalize(part))]


    def words(self, text: str) -> list[str | bytes | int]:
        """Pieces of a whole text: words as they are written in the normalized text, or their UTF-8 bytes; special tokens' ids."""
        if text.isascii() and "<|" not in text:
            return NARROW_PIECE.findall(text.lower())
        if not AT_WIDE.search(text):
            low = unicodedata.normalize("NFC", text).lower()
            if "<|" not in text and not AT_WIDE.search(low):
                return NARROW_PIECE.findall(low)
            return [p for c in chunks(text) for p in self.pieces(c)]
        out, plain = [], []
        for c in chunks(text):
            if c.isascii() and "<|" not in c:
                plain.append(c)
                continue
            out += NARROW_PIECE.findall(" ".join(plain).lower())
            out += self.wide[c]
            plain.clear()
        return out + NARROW_PIECE.findall(" ".join(plain).lower())


class TextIds:
    """Ids of texts as little-endian uint32, a group of texts at once.

    ``word_ids`` gets the distinct words (UTF-8) that are not remembered; words
    of former groups are remembered in two generations of about ``size``.
    """

    def __init__(self, splitter: Splitter, word_ids: Callable[[list[bytes]], list[bytes]], size: int):
        self.split, self.word_ids, self.size = splitter.words, word_ids, size
        self.new: dict[str | bytes | int, bytes] = {}
        self.old: dict[str | bytes | int, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        known, lists = self.new, list(map(self.split, texts))
        todo = set().union(*lists).difference(known)
        found = {p: ids for p in todo if (ids := self.old.get(p)) is not None}
        known |= found
        todo.difference_update(found)
        known |= {p: p.to_bytes(4, "little") for p in todo if isinstance(p, int)}
        names = [p for p in todo if not isinstance(p, int)]
        known |= zip(names, self.word_ids([p.encode() if isinstance(p, str) else p for p in names]), strict=True)
        if len(known) > self.size:  # a group of very many words is not remembered
            self.old, self.new = known if len(known) <= 2 * self.size else {}, {}
        return [b"".join(map(known.__getitem__, pieces)) for pieces in lists]


def text_groups(texts: Iterator[str | None]) -> Iterator[list[str]]:
    """The texts, null as empty, in groups, so that what is made of a whole batch is never all held."""
    group, size = [], 0
    for t in texts:
        group.append(t or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def special_pattern(tokens: list[str]) -> re.Pattern:
    """Pattern whose split() puts special tokens at odd positions; leftmost, longest first."""
    longest_first = sorted(tokens, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")" if tokens else "((?!))")


class Memo(dict):
    """Results by key, computed on first use; two generations bound it to about 2 * ``size`` entries."""

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def worker_cache(kind: str, key: tuple, make: Callable):
    """``make()`` once per Python worker: workers outlive tasks, module globals sent by value do not.

    Of each kind only the last key's value stays.
    """
    store = sys.__dict__.setdefault("_abtest_worker_cache", {})
    if kind not in store or store[kind][0] != key:
        store.pop(kind, None)
        store[kind] = (key, make())
    return store[kind][1]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take U+0100 onward in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b if b in plain else 0x100 + extra))
        extra += b not in plain
    return out
