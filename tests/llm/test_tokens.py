import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from abtest_spark.llm import pfor, transducer, words
from abtest_spark.llm.pfor import FileBuilder, IdFile, decode_blocks, encode_ids, library_ids, token_files, tokenizer_file
from abtest_spark.llm.transducer import Decoder, Encoder, Lexicon, Merger, build_lexicon, compile_lexicon, decode, digests, encode, encode_documents, frequent_words, letter_runs, word_counts
from abtest_spark.llm.words import Splitter, TextIds, chunks

DOCS = "doc_id long, text string, known boolean, word string, ids string, file string"
TEXTS = [
    "", None, "Hello world", "  the THE\tthe\n", "don't I'LL 'Sx 12 3", "été Élan naïve straße ΑΣ İstanbul",
    "a<|endoftext|>b <|startoftext|> <|end", "\x00 \x1c\x1d a\x1fb \x7f", "日本語 текст 😀👩‍👩‍👧 é ﬁ",
    "x" * 3000, "#$%&*** !!! ___ --- a_b", "  　tail\u0085 ", "½ ² ① Ⅷ", "qwrtz " * 50,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [0, 1, 49407, 2**32 - 1])
def test_blocks_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, np.uint32, endpoint=True)
    ids[::41] = top
    ids[::97] = 0
    payload, starts = encode_ids(ids)
    assert len(starts) == -(-n // 128)
    assert (decode_blocks(payload, starts).ravel()[:n] == ids).all() if n else payload == b""


def test_outliers_are_exceptions_not_wider_blocks():
    ids = np.full(128, 5, np.uint32)
    ids[7] = 2**31
    payload, _ = encode_ids(ids)
    assert len(payload) == 8 + 4 + 4  # head, one position, one high part; width 0


@pytest.mark.parametrize("segment", [128, 256, 1 << 19])
def test_file_reads_single_documents(monkeypatch, segment):
    monkeypatch.setattr(pfor, "SEGMENT", segment)
    rng = np.random.default_rng(0)
    counts = [0, 1, 300, 0, 128, 77]
    ids = rng.integers(0, 50000, sum(counts)).astype(np.uint32)
    names, at, builder = [4, None, -3, 9, 2**60, 5], 0, FileBuilder()
    for name, n in zip(names, counts, strict=True):
        builder.add(name, ids[at : at + n].tobytes())
        at += n
    f = IdFile(builder.content())
    assert f.doc_ids == [4, None, -3, 9, 2**60, 5] and f.n_ids == len(ids)
    at = 0
    for k, n in enumerate(counts):
        assert (f.doc(k) == ids[at : at + n]).all()
        assert f.crc32()[k] == zlib.crc32(ids[at : at + n].astype("<u4").tobytes())
        at += n
    with pytest.raises(ValueError):
        IdFile(b"nothing of the kind, but longer than forty-eight bytes in all")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, True, "w", "i", "f") for i, t in rows], DOCS)


def expected_starts(library, rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*ids_of(library, t), 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_of_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_IDS", 60)
    rows = [(k * 3 - 5, t) for k, t in enumerate(TEXTS)] + [(None, "no id at all")]
    got = token_files(frame(spark, rows).repartition(5), tokenizer_file())
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected_starts(library, rows)


def test_token_files_repeated_ids_and_no_rows(spark, library):
    rows = [(1, "same"), (1, "same"), (1, "other words"), (0, "first")]
    got = token_files(frame(spark, rows), tokenizer_file()).orderBy("start").collect()
    assert [r.doc_id for r in got] == [0, 1, 1, 1]
    assert sum(r.n_tokens for r in got) == sum(len(ids_of(library, t)) + 1 for _, t in rows)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert token_files(frame(spark, []), tokenizer_file()).count() == 0


def test_token_files_query(spark, library):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op4_token_files"](spark, d).collect()
    assert sorted(map(tuple, got)) == expected_starts(library, [tuple(r) for r in rows])


def test_lexicon_holds_exactly_its_words(tmp_path):
    r = random.Random(1)
    words = {bytes(r.choices(b"abc", k=r.randint(1, 7))) + r.choice([b"", b"ing", b"s"]) for _ in range(400)}
    entries = {w: r.randbytes(4 * r.randint(0, 4)) for w in words}
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(path))
    assert lexicon.ids(list(entries)) == list(entries.values())
    others = {bytes(r.choices(b"abcgins", k=r.randint(0, 9))) for _ in range(2000)} - words
    assert lexicon.ids([*others, b"", b"abc" * 50]) == [None] * (len(others) + 2)
    letters = sum(len(w) for w in words)
    assert len(lexicon.final) < letters / 3  # equal suffixes are shared


def test_empty_lexicon(tmp_path, library):
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon({}))
    encoder = Encoder(tokenizer_file(), str(path))
    for group in (TEXTS, TEXTS[::-1], TEXTS[:1]):
        for t, got in zip(group, encoder.encode([chunks(t or "") for t in group]), strict=True):
            assert got.tolist() == ids_of(library, t), t


def test_merges_of_long_and_short_words_agree(library):
    merger = Merger(tokenizer_file())
    r = random.Random(2)
    words = [bytes(r.choices(b"aeioustrnhel", k=r.randint(1, 90))) for _ in range(300)] + [b"", b"a", b"the"]
    for w, ids in zip(words, merger.ids(words), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == ids_of(library, w.decode()) == (merger.merge_long(merger.start(w)) if w else [])


def test_encoding_of_odd_texts(spark, library):
    rows = [(k if k % 5 else None, t) for k, t in enumerate(TEXTS + TEXTS)]
    coded = encode_documents(frame(spark, rows), tokenizer_file(), words=20)
    got = sorted(map(tuple, digests(coded).collect()), key=str)
    want = []
    for i, t in rows:
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        want.append(
            (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        )
    assert got == sorted(want, key=str)


def test_encoding_no_rows(spark):
    assert digests(encode_documents(frame(spark, []), tokenizer_file())).count() == 0


def test_word_counts_are_exact(spark):
    got = {bytes(r.word): r.n for r in word_counts(frame(spark, [(1, "a b a"), (2, "A, b"), (3, None)]), tokenizer_file()).collect()}
    assert got == {b"a": 3, b"b": 2, b",": 1}


def test_bpe_query(spark, library):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op6_bpe"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("most", [0, 1, 5, 30, 1000])
def test_frequent_words_are_those_above_a_count(spark, most):
    counts = {b"a%d" % i: n for i, n in enumerate([9000, 9000, 8000, 70, 70, 9, 9, 9, *[2] * 10, *[1] * 50])}
    df = spark.createDataFrame([(bytearray(w), n) for w, n in counts.items()], "word binary, n long").repartition(5)
    got = frequent_words(df, most)
    assert len(got) <= most and len(got) == len(set(got))
    left = [n for w, n in counts.items() if w not in set(got)]
    assert not left or not got or min(counts[w] for w in got) > max(left)
    want = max(k for k in (0, 2, 3, 5, 8, 18, 68) if k <= most)
    assert len(got) == want or (want == 3 and len(got) == 3)


def test_letter_runs_are_counted_over_all_rows(spark):
    rows = [(1, "The the, THE."), (2, "été Élan-the 12 a1b"), (3, None), (4, "  "), (4, "été")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {bytes(r["word"]).decode(): r["n"] for r in letter_runs(df).collect()}
    assert got == {"the": 12, "été": 6, "élan": 3, "a": 3, "b": 3}
    assert letter_runs(df.where("false")).collect() == []


def test_encode_and_decode_alone(spark, library):
    """The two columns of their own give what encode_documents gives; unknown ids are left out, null ids have no text."""
    df = frame(spark, list(enumerate(TEXTS)))
    lexicon = build_lexicon(df, tokenizer_file(), 20)
    ids = df.select("doc_id", encode(df["text"], tokenizer_file(), lexicon).alias("ids"))
    got = ids.select("doc_id", "ids", decode(ids["ids"], tokenizer_file()).alias("decoded")).collect()
    want = {r.doc_id: (r.ids, r.decoded) for r in encode_documents(df, tokenizer_file(), words=20).collect()}
    assert {r.doc_id: (r.ids, r.decoded) for r in got} == want
    d = Decoder(tokenizer_file())
    some = np.array(ids_of(library, "hello world"))
    assert d.text(np.append(some, 10**7)) == d.text(some) == library.decode(some.tolist(), skip_special_tokens=False)
    assert d.text(None) == d.text(np.zeros(0, np.int64)) == ""


def mixed_texts(n=1500):
    r = random.Random(5)
    signs = [chr(i) for i in range(0x260)] + list(" \t\n　'''sStTlLvVrReEmMdD<|>’“́ЖжΣσςİﬁ½²日本😀") + ["<|endoftext|>", "'LL", "é"]
    return ["".join(r.choices(signs[:k], k=r.randint(0, 40))) for k in (128, 0x250, len(signs)) for _ in range(n)] + TEXTS


def test_whole_texts_split_and_encode_as_the_library_does(library, tmp_path, monkeypatch):
    """Also where what is remembered is dropped between groups, and with words of former groups."""
    texts = mixed_texts()
    want = [ids_of(library, t) for t in texts]
    (tmp_path / "lexicon").write_bytes(compile_lexicon({}))
    for size in (3, 400, 10**6):
        monkeypatch.setattr(pfor, "MEMO", size)
        monkeypatch.setattr(transducer, "MEMO", size)
        for encode in (library_ids(tokenizer_file()).encode, Encoder(tokenizer_file(), str(tmp_path / "lexicon")).encode_texts):
            got = [np.frombuffer(ids, "<u4").tolist() for at in range(0, len(texts), 97) for ids in encode([t or "" for t in texts[at : at + 97]])]
            assert got == want


def test_words_are_asked_for_once_in_a_group_and_forms_share_them(library):
    asked = []

    def word_ids(words):
        asked.extend(words)
        return [b"\0\0\0\0"] * len(words)

    ids = TextIds(Splitter(library), word_ids, 100)
    ids.encode(["The dog, the DOG.", "dog; (the) été ÉTÉ", "the dog"])
    ids.encode(["The dog... été, cat", ""])
    assert sorted(asked) == sorted([b"the", b"dog", b",", b".", b";", b"(", b")", "été".encode(), b"...", b"cat"])


def test_groups_are_bounded_and_keep_every_text(monkeypatch):
    monkeypatch.setattr(words, "GROUP_CHARS", 10)
    texts = ["a" * 4, None, "b" * 7, "c" * 30, "", "d"]
    assert list(words.text_groups(texts)) == [["a" * 4, "", "b" * 7], ["c" * 30], ["", "d"]]
