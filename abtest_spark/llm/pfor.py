"""Token-id files of patched frame-of-reference blocks.

Ids are cut into blocks of 128. A block stores its minimum, the differences to
it packed at the bit width that holds ``PERCENTILE`` of them, and an exception
list (position, high bits) for the outliers that are wider. A file holds the
packed blocks, the start of each block, its documents' ids and token counts,
and a footer that locates these parts, so any document can be read alone.

Documents are written in ascending doc_id order: a range shuffle puts each
partition's documents after the former partition's, a partition's files are
numbered, and a file's first token position is the sum of the ids of all files
before it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtest_spark.llm.common import cut, scratch, shared_fs
from abtest_spark.llm.words import Splitter, TextIds, byte_alphabet, text_groups, worker_cache

MAGIC = b"PFORIDS1"
BLOCK = 128
PERCENTILE = 0.9
FILE_IDS = 8_000_000  # ids after which a partition begins its next file
SEGMENT = 1 << 19  # ids packed or unpacked at once
MEMO = 180_000  # words remembered per Python worker and generation


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, 128) uint32 below 2^width as (n, 4 * width) uint32: four interleaved lanes of 32 values."""
    v = values.reshape(len(values), 32, 4)
    out = np.zeros((len(values), width, 4), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, word] |= v[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= v[:, i] >> np.uint32(32 - shift)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(len(words), width, 4)
    out = np.zeros((len(words), 32, 4), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        out[:, i] = w[:, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, i] |= w[:, word + 1] << np.uint32(32 - shift)
    return out.reshape(len(words), BLOCK) & np.uint32((1 << width) - 1)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_ids(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, start of each block) of uint32 ids.

    A block: minimum uint32, width uint8, exceptions uint8, two zero bytes;
    packed differences; exception positions uint8, padded to four bytes;
    exception high parts uint32.
    """
    n_blocks = -(-len(ids) // BLOCK)
    if n_blocks == 0:
        return b"", np.zeros(0, np.uint64)
    full = np.full(n_blocks * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    blocks = full.reshape(n_blocks, BLOCK)
    low = blocks.min(1)
    rest = blocks - low[:, None]
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bits(np.partition(rest, rank, axis=1)[:, rank])
    limit = (np.uint64(1) << width.astype(np.uint64))[:, None]
    over = rest >= limit
    n_over = over.sum(1)
    n_pad = -(-n_over // 4)
    sizes = 2 + 4 * width + n_pad + n_over  # in uint32
    start = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(start[-1], np.uint32)
    at = start[:-1]
    out[at] = low
    out[at + 1] = (width | n_over << 8).astype(np.uint32)
    for w in np.unique(width).tolist():
        if w:
            i = np.flatnonzero(width == w)
            out[at[i][:, None] + 2 + np.arange(4 * w)] = _pack(rest[i] & np.uint32((1 << w) - 1), w)
    b, pos = np.nonzero(over)
    if len(b):
        nth = np.arange(len(b)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        begin = at + 2 + 4 * width
        out.view(np.uint8)[(begin[b] * 4 + nth)] = pos
        out[begin[b] + n_pad[b] + nth] = (rest[b, pos].astype(np.uint64) >> width[b].astype(np.uint64)).astype(np.uint32)
    return out.tobytes(), start[:-1].astype(np.uint64) * 4


def decode_blocks(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """(n, 128) ids of the blocks that begin at ``starts`` of the payload."""
    words = np.frombuffer(payload, np.uint32)
    at = (starts // 4).astype(np.int64)
    head = words[at + 1]
    width, n_over = (head & 255).astype(np.int64), (head >> 8).astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            i = np.flatnonzero(width == w)
            out[i] = _unpack(words[at[i][:, None] + 2 + np.arange(4 * w)], w)
    b = np.repeat(np.arange(len(at)), n_over)
    if len(b):
        nth = np.arange(len(b)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        begin = at + 2 + 4 * width
        pos = np.frombuffer(payload, np.uint8)[begin[b] * 4 + nth]
        high = words[begin[b] + (-(-n_over // 4))[b] + nth]
        out[b, pos] |= (high.astype(np.uint64) << width[b].astype(np.uint64)).astype(np.uint32)
    return out + words[at][:, None]


class FileBuilder:
    """Collects documents into a file's bytes; ids are packed as they come, so few are held unpacked."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.n_ids = 0
        self._held, self._n_held = [], 0
        self._payload, self._starts, self._size = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document: its id and its token ids as little-endian uint32."""
        n = len(ids) // 4
        self.doc_ids.append(doc_id)
        self.counts.append(n)
        self.n_ids += n
        self._held.append(ids)
        self._n_held += n
        if self._n_held >= SEGMENT:
            self._pack(self._n_held // BLOCK * BLOCK)

    def _pack(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self._held), "<u4")
        for at in range(0, n, SEGMENT):
            payload, starts = encode_ids(ids[at : min(at + SEGMENT, n)])
            self._payload.append(payload)
            self._starts.append(starts + np.uint64(self._size))
            self._size += len(payload)
        self._held, self._n_held = [ids[n:].tobytes()], len(ids) - n

    def content(self) -> bytes:
        """The whole file. Footer: payload bytes, blocks, documents, ids (uint64 each), magic."""
        self._pack(self._n_held)
        starts = np.concatenate(self._starts) if self._starts else np.zeros(0, np.uint64)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        numbers = np.array([0 if d is None else d for d in self.doc_ids], np.int64)
        footer = np.array([self._size, len(starts), len(self.doc_ids), self.n_ids], np.uint64)
        index = [starts, numbers, np.array(self.counts, np.uint64), known, footer]
        return b"".join([MAGIC, *self._payload, *(x.tobytes() for x in index), MAGIC])


class IdFile:
    """A file read back: ``doc(k)`` decodes only the blocks of its k-th document."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC or content[-8:] != MAGIC:
            raise ValueError("not a token-id file, or cut short")
        size, n_blocks, n_docs, self.n_ids = np.frombuffer(content[-40:-8], np.uint64).astype(np.int64).tolist()
        at = 8 + size
        self.payload = content[8:at]
        self.starts = np.frombuffer(content[at : at + 8 * n_blocks], np.uint64)
        at += 8 * n_blocks
        numbers = np.frombuffer(content[at : at + 8 * n_docs], np.int64).tolist()
        self.counts = np.frombuffer(content[at + 8 * n_docs : at + 16 * n_docs], np.uint64).astype(np.int64)
        known = content[at + 16 * n_docs : at + 17 * n_docs]
        self.doc_ids = [d if k else None for d, k in zip(numbers, known, strict=True)]
        self.firsts = np.cumsum(self.counts) - self.counts

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids from position ``first`` of the file."""
        b0, b1 = first // BLOCK, -(-(first + n) // BLOCK)
        return decode_blocks(self.payload, self.starts[b0:b1]).ravel()[first - b0 * BLOCK :][:n]

    def doc(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.counts[k]))

    def crc32(self) -> list[int]:
        """Checksum of each document's ids as little-endian uint32; about SEGMENT ids are unpacked at once."""
        out, k = [], 0
        while k < len(self.counts):
            first = int(self.firsts[k])
            last = max(k + 1, int(np.searchsorted(self.firsts, first + SEGMENT)))
            n = int(self.counts[k:last].sum())
            raw = memoryview(self.ids(first, n).astype("<u4").tobytes())
            for a, m in zip((self.firsts[k:last] - first).tolist(), self.counts[k:last].tolist(), strict=True):
                out.append(zlib.crc32(raw[4 * a : 4 * (a + m)]))
            k = last
        return out


def library_ids(path: str) -> TextIds:
    """Ids of texts by the tokenizers library's model."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    # words are normalized and split before: the model alone, on many words with spaces between them
    model = Tokenizer(tokenizer.model)
    model.pre_tokenizer = WhitespaceSplit()
    sign = {b: c for b, c in enumerate(byte_alphabet()) if b != 0x20}
    # a line break as a word of its own marks the end of each word: no word holds one, so no other word has its id
    (mark,) = model.encode(sign[0x0A], add_special_tokens=False).ids

    def word_ids(words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        names = b" \n ".join([*words, b""]).decode("latin-1").translate(sign)
        ids = np.array(model.encode_batch_fast([names], add_special_tokens=False)[0].ids, "<u4")  # fast: without offsets
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == mark)).tolist()
        return [raw[a:b] for a, b in zip([0, *[e + 4 for e in ends[:-1]]], ends, strict=True)]

    return TextIds(Splitter(tokenizer), word_ids, MEMO)


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenizes every text, appends ``end_id`` and writes the files; returns the manifest (file, docs, ids).

    Null texts are empty. Documents are in ascending id order, null ids first;
    rows that repeat an id are ordered by their text. A file is written under
    a temporary name and then renamed, so a task that is run again replaces its
    files by the same ones.
    """
    number = F.col(id_col).cast("long")
    ordered = (
        docs.select(
            number.isNotNull().alias("known"),
            F.coalesce(number, F.lit(0)).alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        )
        .repartitionByRange("known", "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("known", "doc_id", F.xxhash64("text"), "text")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_cache("pfor", (tokenizer_path,), lambda: library_ids(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        fs, base = shared_fs(folder)
        fs.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        made, file = [], FileBuilder()

        def flush() -> None:
            name = f"part-{part:06d}-{len(made):06d}.pfor"
            temporary = f"{base}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary) as out:
                out.write(file.content())
            fs.move(temporary, f"{base}/{name}")
            made.append((name, len(file.doc_ids), file.n_ids))

        for pdf in batches:
            coded = (ids for texts in text_groups(pdf["text"]) for ids in encoder.encode(texts))
            for known, doc_id, ids in zip(pdf["known"], pdf["doc_id"], coded, strict=True):
                file.add(int(doc_id) if known else None, ids + end)
                if file.n_ids >= FILE_IDS:
                    flush()
                    file = FileBuilder()
        if file.doc_ids:
            flush()
        yield pd.DataFrame(made, columns=["file", "docs", "ids"])

    return cut(ordered.mapInPandas(write, "file string, docs long, ids long"))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files the manifest names."""
    spark = manifest.sparkSession
    before = F.coalesce(
        F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    firsts = manifest.select("file", before.alias("first"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["file"], pdf["content"], strict=True):
                f = IdFile(content)
                yield pd.DataFrame(
                    {
                        "file": name,
                        "doc_id": pd.array(f.doc_ids, dtype="Int64"),
                        "at": f.firsts,
                        "n_tokens": f.counts,
                        "ids_crc32": f.crc32(),
                    }
                )

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    stored = files.option("pathGlobFilter", "*.pfor").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content"
    )
    rows = stored.mapInPandas(read, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(firsts, "file").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the token files of ``docs`` (doc_id, text) to ``folder`` in the shared store and reads them back.

    Extra columns are not read; an empty table writes no file and gives no rows.
    """
    folder = folder or scratch(docs.sparkSession, "token-ids")
    manifest = write_token_files(docs, tokenizer_path, folder, end_id)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(manifest, folder)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file, which every machine has installed."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
