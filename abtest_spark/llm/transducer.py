"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The words of the whole corpus are counted by a grouped aggregation; the most
frequent ones are merged once and compiled into a minimal acyclic automaton
whose equal suffixes are shared. Each transition stores how many words precede
it in its state, so the sum along a path is the word's number, and the number
points to the word's ids. The automaton is one file, shipped to every executor
and memory-mapped there. Words it does not hold are merged exactly by the
vocabulary's merge ranks. The lexicon only saves time: results do not depend on
which words it holds.
"""

from __future__ import annotations

import heapq
import json
import mmap
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import SparkFiles, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtest_spark.llm.common import scratch, shared_fs
from abtest_spark.llm.words import Splitter, TextIds, byte_alphabet, chunks, text_groups

LEXICON_WORDS = 50_000  # most frequent words that are compiled
COUNT_FLUSH = 40_000  # distinct chunks a counting task holds before it splits them
COUNT_WORDS = 120_000  # distinct words it holds before it emits them
COUNT_BINS = 4096  # word counts below this have a bin each in the histogram, those above 16 to a doubling
MEMO = 90_000  # words remembered per Python worker and generation
LONG_WORD = 64  # bytes from which a word is merged by itself
NO_RANK = 1 << 30
MAGIC = b"ACYCLIC1"
#: The file's arrays: arcs (state, label), their targets, words before them, output starts, outputs, final states.
KINDS = ("<i8", "<u4", "<u4", "<u4", "u1", "u1")


class Merger:
    """Byte-level BPE with word ends: ids of one word by its merge ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, merges, end = (model["model"][k] for k in ("vocab", "merges", "end_of_word_suffix"))
        sign = byte_alphabet()
        self.inner = [vocab[c] for c in sign]
        self.final = [vocab[c + (end or "")] for c in sign]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        triples = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
        keys = triples[:, 0] << 32 | triples[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of, self.joined = np.append(keys[order], -1), np.append(order, NO_RANK), triples[:, 2]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NO_RANK where there is none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)

    def start(self, word: bytes) -> list[int]:
        """The symbols of a word before any merge."""
        return [self.inner[b] for b in word[:-1]] + [self.final[b] for b in word[-1:]]

    def ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian uint32: repeatedly joins the leftmost pair of lowest rank.

        Words of one length are merged together, a step of all of them at once.
        """
        out: list[bytes] = [b""] * len(words)
        inner, final = np.array(self.inner), np.array(self.final)
        for size, places in same_length(words).items():
            if size > LONG_WORD:
                for i in places:
                    out[i] = np.array(self.merge_long(self.start(words[i])), "<u4").tobytes()
                continue
            raw = np.frombuffer(b"".join([words[i] for i in places]), np.uint8).reshape(-1, size)
            symbols = inner[raw]
            symbols[:, -1] = final[raw[:, -1]]
            self._merge(symbols, np.array(places), out)
        return out

    def _merge(self, s: np.ndarray, place: np.ndarray, out: list[bytes]) -> None:
        ranks = self._ranks(s[:, :-1], s[:, 1:])
        while len(s):
            width = s.shape[1]
            if width == 1:
                done = np.ones(len(s), bool)
            else:
                best = ranks.argmin(1)
                lowest = ranks[np.arange(len(s)), best]
                done = lowest == NO_RANK
            raw, step = s[done].astype("<u4").tobytes(), 4 * width
            for k, i in enumerate(place[done].tolist()):
                out[i] = raw[k * step : (k + 1) * step]
            if done.all():
                return
            go = ~done
            s, ranks, place, best, lowest = s[go], ranks[go], place[go], best[go], lowest[go]
            row = np.arange(len(s))
            s[row, best] = self.joined[lowest]
            stay = np.ones(s.shape, bool)
            stay[row, best + 1] = False
            s = s[stay].reshape(len(row), width - 1)
            stay = np.ones(ranks.shape, bool)
            stay[row, best] = False
            ranks = ranks[stay].reshape(len(row), width - 2)
            i = np.flatnonzero(best > 0)
            ranks[i, best[i] - 1] = self._ranks(s[i, best[i] - 1], s[i, best[i]])
            i = np.flatnonzero(best < width - 2)
            ranks[i, best[i]] = self._ranks(s[i, best[i]], s[i, best[i] + 1])

    def merge_long(self, s: list[int]) -> list[int]:
        """The same for one word with a heap and linked neighbours, n log n in its length."""
        after, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        first = self._ranks(np.array(s[:-1], np.int64), np.array(s[1:], np.int64)).tolist()
        heap = [(r, i, s[i], s[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < len(s):
                r = int(self._ranks(np.array([s[i]], np.int64), np.array([s[j]], np.int64))[0])
                if r != NO_RANK:
                    heapq.heappush(heap, (r, i, s[i], s[j]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i] if s[i] == left else len(s)
            if j >= len(s) or s[j] != right:
                continue  # one of the two has been joined meanwhile
            s[i], s[j] = int(self.joined[r]), -1
            after[i] = after[j]
            if after[j] < len(s):
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [x for x in s if x >= 0]


def _tokens(path: str) -> dict[int, str]:
    """Token of each id, special tokens included."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    return {i: t for t, i in model["model"]["vocab"].items()} | {t["id"]: t["content"] for t in model["added_tokens"]}


def compile_lexicon(entries: dict[bytes, bytes]) -> bytes:
    """The automaton file of ``entries`` (word -> ids as little-endian uint32), built from the sorted words.

    States that end alike are merged as soon as no later word can change them.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # (final, ((label, target), ...))
    path: list[list] = [[False, []]]  # unfinished states along the last word: final, transitions

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    last = b""
    words = sorted(entries)
    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        freeze(common)
        for b in w[common:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = w
    freeze(0)
    states.append((path[0][0], tuple(path[0][1])))
    holds = []  # words that each state leads to
    arc, target, before = [], [], []  # arcs in ascending order of (state, label)
    for k, (final, arcs) in enumerate(states):
        n = int(final)
        for b, t in arcs:
            arc.append(k << 8 | b)
            target.append(t)
            before.append(n)
            n += holds[t]
        holds.append(n)
    out_first = np.concatenate(([0], np.cumsum([len(entries[w]) for w in words]))).astype(np.uint32)  # in bytes
    parts = [
        np.array(arc, np.int64),
        np.array(target, np.uint32),
        np.array(before, np.uint32),
        out_first,
        np.frombuffer(b"".join([entries[w] for w in words]), np.uint8),
        np.array([f for f, _ in states], np.uint8),
    ]
    sizes = np.array([p.nbytes for p in parts], np.uint64).tobytes()
    return MAGIC + sizes + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A memory-mapped automaton file; ``ids(words)`` has None for words it does not hold."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[:8] != MAGIC:
            raise ValueError("not a lexicon file")
        at, parts = 56, []
        for n, kind in zip(np.frombuffer(self.map[8:56], np.uint64).tolist(), KINDS, strict=True):
            parts.append((at, np.frombuffer(self.map, kind, n // np.dtype(kind).itemsize, at)))
            at += n
        self.arc, self.target, self.before, self.out_first, _, self.final = (v for _, v in parts)
        self.out_at = parts[4][0]

    def ids(self, words: list[bytes]) -> list[bytes | None]:
        """Walks all words of one length at a time, a byte of each per step."""
        out: list[bytes | None] = [None] * len(words)
        if len(self.arc) == 0:
            return out
        for size, places in same_length(words).items():
            raw = np.frombuffer(b"".join([words[i] for i in places]), np.uint8).reshape(-1, size)
            alive, number = np.arange(len(places)), np.zeros(len(places), np.int64)
            state = np.full(len(places), len(self.final) - 1, np.int64)  # the root is the last state
            for k in range(size):
                want = state << 8 | raw[alive, k]
                at = np.minimum(np.searchsorted(self.arc, want), len(self.arc) - 1)
                hit = self.arc[at] == want
                alive, at = alive[hit], at[hit]
                number, state = number[hit] + self.before[at], self.target[at].astype(np.int64)
                if len(alive) == 0:
                    break
            there = self.final[state] == 1
            number = number[there]
            first, last = self.out_first[number] + self.out_at, self.out_first[number + 1] + self.out_at
            for j, a, b in zip(alive[there].tolist(), first.tolist(), last.tolist(), strict=True):
                out[places[j]] = self.map[a:b]
        return out


def same_length(words: list[bytes]) -> dict[int, list[int]]:
    """Positions of the non-empty words by length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    found, first = np.unique(sizes[order], return_index=True)
    places = np.split(order, first[1:]) if len(words) else []
    return {n: p.tolist() for n, p in zip(found.tolist(), places, strict=True) if n}


def word_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(word binary, n) over every document: exact counts, partly summed in the tasks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = _splitter(tokenizer_path).pieces
        seen: Counter = Counter()  # chunks
        words: Counter = Counter()

        def fold() -> None:
            for chunk, n in seen.items():
                for p in split(chunk):
                    if isinstance(p, bytes):
                        words[p] += n
            seen.clear()

        def emit() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(words.keys()), "n": list(words.values())})
            words.clear()
            return out

        for pdf in batches:
            for text in pdf["text"]:
                seen.update(chunks(text))
                if len(seen) >= COUNT_FLUSH:
                    fold()
                    if len(words) >= COUNT_WORDS:
                        yield emit()
        fold()
        if words:
            yield emit()

    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    return texts.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _splitter(path: str) -> Splitter:
    from tokenizers import Tokenizer

    return Splitter(Tokenizer.from_file(path))


def letter_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n): runs of letters of every document in small letters, counted without Python.

    These are the words that recur; signs and digits are pieces of their own, and a
    text that the tokenizer would normalize otherwise only means a word less in the lexicon.
    """
    runs = F.explode(F.split(F.lower(text_col), r"[^\p{L}]+"))
    words = docs.select(runs.alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return words.select(F.col("word").cast("binary").alias("word"), "n")


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """Words of ``counts`` (word, n) above the least count that leaves at most ``most`` of them.

    A histogram of the counts (at most some 5,000 bins) gives that count, so what
    reaches the driver depends neither on the number of partitions nor on the
    number of words. Counted words are kept on disk between the two jobs.
    """
    bin_of = F.when(F.col("n") < COUNT_BINS, F.col("n")).otherwise(COUNT_BINS + F.floor(F.log2(F.col("n") / COUNT_BINS) * 16))
    counts = counts.withColumn("bin", bin_of.cast("long")).persist(StorageLevel.DISK_ONLY)
    try:
        bins = sorted(((r["bin"], r["words"]) for r in counts.groupBy("bin").agg(F.count("*").alias("words")).collect()), reverse=True)
        held, least = 0, 1 << 62
        for b, n in bins:
            if held + n > most:
                break
            held, least = held + n, b
        return [bytes(r["word"]) for r in counts.where(F.col("bin") >= least).select("word").collect()]
    finally:
        counts.unpersist()


def build_lexicon(docs: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Compiles the most frequent words of ``docs``, at most ``words``; returns the shipped file's name."""
    known = frequent_words(letter_runs(docs, text_col), words)
    ids = Merger(tokenizer_path).ids(known)
    return ship(docs.sparkSession, compile_lexicon(dict(zip(known, ids, strict=True))))


def ship(spark: SparkSession, content: bytes) -> str:
    """Writes the file to the shared folder and has every executor fetch it."""
    folder, name = scratch(spark, "lexicon"), f"lexicon-{uuid.uuid4().hex}.bin"
    fs, base = shared_fs(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{name}") as out:
        out.write(content)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


class Encoder:
    """Encodes texts in groups: distinct words once, by the lexicon, the others by merges.

    Words of former groups are remembered in two generations of bounded size.
    """

    def __init__(self, tokenizer_path: str, lexicon_path: str):
        self.merger, self.lexicon = Merger(tokenizer_path), Lexicon(lexicon_path)
        self.ids = TextIds(_splitter(tokenizer_path), self._words, MEMO)

    def encode(self, lists: list[list[str]]) -> list[np.ndarray]:
        """Ids of each text, given as its chunks."""
        return self.encode_texts([" ".join(x) for x in lists])

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<i4") for ids in self.ids.encode(texts)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        ids = self.lexicon.ids(words)
        places = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(places, self.merger.ids([words[i] for i in places]), strict=True):
            ids[i] = x
        return ids


class Decoder:
    """Texts of ids: the tokens joined by a space, special tokens included; unknown ids are left out."""

    def __init__(self, tokenizer_path: str):
        self.known = _tokens(tokenizer_path)
        self.table = [self.known.get(i) for i in range(max(self.known) + 1)]
        self.whole = all(self.table)

    def text(self, ids: np.ndarray | None) -> str:
        if ids is None or len(ids) == 0:
            return ""
        if self.whole and len(ids) > 1 and 0 <= ids.min() and ids.max() < len(self.table):
            return " ".join(itemgetter(*ids.tolist())(self.table))
        return " ".join(filter(None, map(self.known.get, ids.tolist())))


def encode(text: Column, tokenizer_path: str, lexicon: str) -> Column:
    """Ids of ``text`` (null as empty) as array<int>; ``lexicon`` is the name build_lexicon returned."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(tokenizer_path, SparkFiles.get(lexicon))
        for batch in batches:
            for texts in text_groups(batch):
                yield pd.Series(encoder.encode_texts(texts), dtype=object)

    return encoded(text)


def decode(ids: Column, tokenizer_path: str) -> Column:
    """Text of ``ids`` (null as none) as a Decoder gives it."""

    @F.pandas_udf(T.StringType())
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(tokenizer_path)
        for batch in batches:
            yield pd.Series(list(map(decoder.text, batch)), dtype=object)

    return decoded(ids)


def transcode(text: Column, tokenizer_path: str, lexicon: str) -> Column:
    """struct(ids, decoded): ``encode`` and then ``decode`` of its ids in one Python worker instead of two."""

    @F.pandas_udf("ids array<int>, decoded string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = Encoder(tokenizer_path, SparkFiles.get(lexicon)), Decoder(tokenizer_path)
        for batch in batches:
            for texts in text_groups(batch):
                ids = encoder.encode_texts(texts)
                yield pd.DataFrame({"ids": ids, "decoded": list(map(decoder.text, ids))})

    return coded(text)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs``.

    Null and empty texts have no ids and decode to the empty string. Repeated
    rows and null ids stay as they are; other columns are not read; an empty
    table gives no rows.
    """
    lexicon = build_lexicon(docs, tokenizer_path, words, text_col)
    coded = docs.select(
        F.col(id_col).alias("doc_id"), transcode(F.col(text_col), tokenizer_path, lexicon).alias("c")
    )
    return coded.select("doc_id", "c.ids", "c.decoded")


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode_documents' rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
