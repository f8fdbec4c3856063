import datetime
import re

import pytest

from abtest_spark.llm.pii import KINDS, Feistel, luhn_digit, pseudonymize_documents, pseudonymize_text

DOCS = "doc_id long, text string, lang string, row string, moved int, __pii string"
F1 = Feistel(b"one")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_without_fixed_points(n):
    moved = [F1.move("x", n, i) for i in range(n)]
    assert sorted(moved) == list(range(n))
    assert n == 1 or all(a != b for a, b in enumerate(moved))


def test_key_and_kind_matter():
    rows = [[Feistel(k).move(kind, 10**6, i) for i in range(50)] for k in (b"one", b"two") for kind in "xy"]
    assert len({tuple(r) for r in rows}) == 4


def only(text, kind):
    new, counts = pseudonymize_text(F1, text)
    assert dict(zip(KINDS, counts, strict=True)) == {k: int(k == kind) for k in KINDS}, (text, new, counts)
    assert new != text
    return new


def test_formats_stay_valid():
    assert re.fullmatch(r"mail [a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com\.", only("mail abc.34@mail7.example.com.", "email"))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}%%%", only("+1 (017) 555-7713%%%", "phone"))
    new = only("ip 97.51.17.173***", "ip")
    assert all(int(x) < 256 for x in re.search(r"[\d.]+", new)[0].split("."))
    for shape in ("4952935900253052", "4952-9359-0025-3052", "4952 9359 0025 3052"):
        digits = re.sub(r"\D", "", only(shape, "card"))
        assert len(digits) == 16 and luhn_digit(digits[:-1]) == digits[-1]
    assert re.fullmatch(r"token = \"[0-9a-f]{40}\"", only('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "secret"))
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", only("123-45-6789", "ssn"))
    iban = only("GB29 NWBK 6016 1331 9268 19", "iban")
    assert re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", iban)
    plain = iban.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    for text, form in (("2021-02-28", "%Y-%m-%d"), ("28/02/2021", "%d/%m/%Y"), ("28.02.2021", "%d.%m.%Y")):
        datetime.datetime.strptime(only(text, "date"), form)


def test_equal_values_stay_linked_in_any_form():
    a = pseudonymize_text(F1, "x 4952935900253052 y 2021-02-28 z ab.1@m.example.org")[0]
    b = pseudonymize_text(F1, "4952-9359-0025-3052, 28/02/2021; AB.1@M.EXAMPLE.ORG!")[0]
    card, day, mail = re.search(r"x (\d+) y (\S+) z (\S+)", a).groups()
    card2, day2, mail2 = re.match(r"(\S+), (\S+); (\S+)!", b).groups()
    assert card2.replace("-", "") == card and mail2.lower() == mail
    assert datetime.datetime.strptime(day, "%Y-%m-%d") == datetime.datetime.strptime(day2, "%d/%m/%Y")


@pytest.mark.parametrize(
    "text",
    ["", "no data here", "1219538112535716", "300.1.1.1", "1.2.3.4.5", "02/30/2021", "3.14 and 1,000,000", "a@b", "000-12-3456",
     "GB30 NWBK 6016 1331 9268 19", "token of thanks", "12345678901234567890123", "9" * 5000, "@" * 3000, "a." * 3000],
)
def test_clean_text_stays(text):
    assert pseudonymize_text(F1, text) == (text, [0] * len(KINDS))


def test_documents(spark):
    rows = [(1, "ip 97.51.17.173"), (1, "ip 97.51.17.173"), (None, "ip 97.51.17.173 again"), (2, None), (3, ""), (4, "x " * 50_000 + "8.8.8.8")]
    df = spark.createDataFrame([(i, t, "en", "r", 1, "p") for i, t in rows], DOCS)
    out = pseudonymize_documents(df, "one")
    assert out.columns == ["doc_id", "text", "lang", "row", "moved", "__pii"]
    got = sorted(((r.doc_id, r.text, list(r["__pii"])) for r in out.collect()), key=str)
    f = Feistel(b"one")
    want = [(i, *((None, [0] * len(KINDS)) if t is None else pseudonymize_text(f, t))) for i, t in rows]
    assert got == sorted(want, key=str)
    assert pseudonymize_documents(df.limit(0), "one").count() == 0


def test_query_leaves_no_planted_value(spark):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op3_pii_pseudonyms"](spark, d).collect()
    assert len(got) == len(texts)
    shapes = [r"[\w.+-]+@[\w.-]+\.\w+", r"\b\d{1,3}(?:\.\d{1,3}){3}\b", r"\+\d[\d ()-]{9,}", r"\b[0-9a-f]{40}\b"]
    changed = 0
    for r in got:
        old = texts[r.doc_id]
        values = {v for s in shapes for v in re.findall(s, old)}
        values |= {v for v in re.findall(r"(?<!\d)\d{16}(?!\d)", old) if luhn_digit(v[:-1]) == v[-1]}
        assert not [v for v in values if v in r.text]
        assert (r.text != old) == bool(r.n_values)
        changed += bool(values)
    assert changed


@pytest.mark.parametrize("size", [160, 161, 300, 512, 513, 600, 5000, 200_001])
def test_secrets_of_any_length(size):
    named, digits = ("aB3+xY7/q_Z-" * size)[:size], ("04dbebab91ab85687d33" * size)[:size]
    new = only(f"secret={named} end", "secret")
    got = re.fullmatch(r"secret=(\S+) end", new)[1]
    assert [(c.isupper(), c.isalpha(), c.isdigit()) for c in got] == [(c.isupper(), c.isalpha(), c.isdigit()) for c in named]
    # every part moves, also when only the last character differs
    other = only(f"secret={named[:-1]}{'c' if named[-1] == 'b' else 'b'} end" if named[-1].isalpha() else f"secret={named}b end", "secret")[7:]
    for k in range(0, size - 60, 60):
        assert got[k : k + 60] != named[k : k + 60] and got[k : k + 60] != other[k : k + 60]
    for run in (digits, digits.upper()):
        new = only(f"x {run} y", "secret")
        assert re.fullmatch(f"x [{'0-9a-f' if run == digits else '0-9A-F'}]{{{size}}} y", new)
        assert all(new[k + 2 : k + 62] != run[k : k + 60] for k in range(0, size - 60, 60))


def test_digits_of_long_values_are_permuted_without_fixed_points():
    values = [[a, b, 0, c] for a in range(3) for b in range(4) for c in range(5)]
    moved = [F1.move_digits("x", v, [3, 4, 1, 5]) for v in values]
    assert sorted(moved) == values and all(a != b for a, b in zip(moved, values, strict=True))


def test_names_beyond_ascii_are_replaced_whole():
    for mail in ("jürgen.müller@example.de", "ЯнаП@почта.рф", "Ελένη.x@mail.gr", "a" * 90 + "é@example.com"):
        new = only(f"to {mail}.", "email")[3:-1]
        local, old = new.split("@")[0], mail.split("@")[0]
        assert len(local) == len(old) and new.rsplit(".", 1)[1] == mail.rsplit(".", 1)[1]
        assert [c.isupper() for c in local] == [c.isupper() for c in old]
        assert "ürgen" not in new and "müller" not in new
    names = [f"{a}{b}é" for a in "äöüßçñ" for b in "xyz"]
    assert len({pseudonymize_text(F1, f"{n}@mail.de")[0] for n in names}) == len(names)


def test_small_letter_iban_and_ipv6():
    new = only("iban de89370400440532013000 ok", "iban").split()[1]
    assert new[:2] == "de" and new == new.lower()
    assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1
    assert only("IBAN DE89370400440532013000 ok", "iban").lower() == f"iban {new} ok"
    for shape in ("2001:db8::8a2e:370:7334", "2001:0DB8:0000:0000:0000:8A2E:0370:7334", "fe80::1ff:fe23:4567:890a"):
        out = only(f"at {shape}, now", "ip")[3:-5]
        import ipaddress

        assert ipaddress.IPv6Address(out) != ipaddress.IPv6Address(shape)
        assert (out.upper() == out) == (shape.upper() == shape)
    for text in ("at 12:30:45 or 1:2", "std::vector a::b", "face::add", ":: and ::1", "12:34:56:78:90:12:34:56:78"):
        assert pseudonymize_text(F1, text)[0] == text


def test_worded_dates():
    new = only("on 14 September 2001", "date")
    assert re.fullmatch(r"on \d{1,2} [A-Z][a-z]{2,8} (19|20)\d\d", new)
    short = only("on 14 Sep 2001", "date")
    assert re.fullmatch(r"on \d{1,2} [A-Z][a-z]{2} (19|20)\d\d", short)
    datetime.datetime.strptime(short, "on %d %b %Y")
    same = pseudonymize_text(F1, "2001-09-14")[0]
    assert datetime.datetime.strptime(new, "on %d %B %Y").strftime("%Y-%m-%d") == same
    for text in ("31 February 2001", "1.5 May 2001", "in May 2001", "14 Septembers 2001"):
        assert pseudonymize_text(F1, text)[0] == text
