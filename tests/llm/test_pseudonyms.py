from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from zonepulse.llm import pseudonyms as P


def run(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.pii_counts) for r in P.pseudonymise(df, key, counts=True).orderBy("doc_id").collect()]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()]
    return sum(sum(divmod(x * 2, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


CASES = [
    ("email", "the.72@mail3.example.com", r"[a-z]{3}\.\d\d@mail3\.example\.com"),
    ("email", "réeux.09@mail2.example.com", r"[a-z][ß-ö][a-z]{3}\.\d\d@mail2\.example\.com"),
    ("email", "иван@пример.рф", r"[а-џ]{4}@пример\.рф"),
    ("email", "山田.太郎@mail.example", r"[一-鿿]{2}\.[一-鿿]{2}@mail\.example"),
    ("date", "31/12/1999", r"(1[3-9]|[23]\d)/\d\d/\d{4}"),
    ("date", "12/31/1999", r"\d\d/\d\d/\d{4}"),
    ("phone", "+49 30 1234567", r"\+49 \d\d \d{7}"),
    ("phone", "(017) 555-7713", r"\(\d{3}\) \d{3}-\d{4}"),
    ("phone", "+1 (499) 555-6503", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("phone", "499-555-6503", r"\d{3}-\d{3}-\d{4}"),
    ("ip", "97.51.17.173", r"\d{1,3}(\.\d{1,3}){3}"),
    ("card", "4952935900253052", r"4\d{15}"),
    ("card", "4111 1111 1111 1111", r"4\d{3} \d{4} \d{4} \d{4}"),
    ("card", "378282246310005", r"3\d{14}"),
    ("ssn", "123-45-6789", r"\d{3}-\d{2}-\d{4}"),
    ("date", "1987-06-05", r"\d{4}-\d{2}-\d{2}"),
    ("date", "05.06.1987", r"\d{2}\.\d{2}\.\d{4}"),
    ("iban", "GB82 WEST 1234 5698 7654 32", r"GB\d{2} [A-Z]{4} \d{4} \d{4} \d{4} \d{2}"),
    ("iban", "DE89370400440532013000", r"DE\d{20}"),
]


def test_every_kind_keeps_its_format(spark):
    out = run(spark, [f"see {value}, then" for _, value, _ in CASES])
    for (kind, value, form), (text, counts) in zip(CASES, out, strict=True):
        new = text.removeprefix("see ").removesuffix(", then")
        assert new != value and counts == {kind: 1}, value
        assert re.fullmatch(form, new), (value, new)
        if kind == "card":
            assert luhn(new)
        if kind == "iban":
            assert mod97(new) == 1
        if kind == "ip":
            assert all(int(x) <= 255 for x in new.split("."))
        if kind == "date":
            parts = list(map(int, re.split(r"\D", new)))
            order = ((0, 1, 2) if "-" in new else (2, 1, 0) if "." in new or parts[0] > 12 else (2, 0, 1))
            date(*[parts[i] for i in order])


@pytest.mark.parametrize("text", [
    "4111111111111112 fails its check digit", "300.1.1.1 is no address, 1.2.3.4.5 a version",
    "1987-13-05 is no date", "000-12-3456 was never given out", "GB82 WEST 1234 5698 7654 33",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "12345 and 3.14", "a@b", "", "0000000000000000",
    "items 100 200 3000 left", "199-555-0100 is no area code", "+1 22", "31/13/1999", "32/12/1999",
])
def test_what_fails_its_check_stays(spark, text):
    assert run(spark, [text]) == [(text, {})]


def test_equal_values_stay_linked_and_keys_differ(spark):
    texts = ["a 4952935900253052 b", "xx 4952935900253052!! 4952935900253052", "y 1987-06-05 05.06.1987"]
    out = [t for t, _ in run(spark, texts)]
    card = out[0].split()[1]
    assert out[1] == f"xx {card}!! {card}"
    _, iso, german = out[2].split()
    assert "-".join(reversed(german.split("."))) == iso
    assert [t for t, _ in run(spark, texts, key="other")][0] != out[0]


def test_permutations(spark):
    """One to one on whole small domains."""
    df = spark.range(2000).select(
        P.permute_number(F.col("id"), 2000, "k", "t").alias("n"),
        P.permute_text(F.lpad(F.col("id").cast("string"), 4, "0"), "k", "t").alias("s"))
    rows = df.collect()
    assert sorted(r.n for r in rows) == list(range(2000))
    assert len({r.s for r in rows}) == 2000 and all(re.fullmatch(r"\d{4}", r.s) for r in rows)


def _plain_stream(key, tweak, i, source):
    return hashlib.sha256(f"{key}|{tweak}|{i}|{source}".encode()).hexdigest()


def _plain_char(char, by):
    for first, last in [(48, 57), (97, 122), (65, 90), *P.LETTERS]:
        if first <= ord(char) <= last:
            return chr(first + (ord(char) - first + by) % (last - first + 1))
    return char


def plain_text(value, key, tweak, undo=False):
    """The Feistel network over characters once more, in either direction."""
    cut = len(value) // 2
    halves = [value[:cut], value[cut:]]
    for i in (range(P.ROUNDS - 1, -1, -1) if undo else range(P.ROUNDS)):
        target, source = halves[i % 2], halves[1 - i % 2]
        stream = _plain_stream(key, tweak, i, source)
        halves[i % 2] = "".join(
            _plain_char(c, (-1 if undo else 1) * int(stream[j % 31 * 2:j % 31 * 2 + 4], 16))
            for j, c in enumerate(target))
    return "".join(halves)


def plain_number(value, size, key, tweak):
    half = max(1, -(-(size - 1).bit_length() // 2))
    while True:
        a, b = value >> half, value & ((1 << half) - 1)
        for i in range(P.ROUNDS):
            a, b = b, a ^ (int(_plain_stream(key, tweak, i, b)[:8], 16) & ((1 << half) - 1))
        value = a << half | b
        if value < size:
            return value


def test_networks_against_a_plain_version(spark):
    values = ["a", "ab", "0", "12345678901", "Ab.9-z_", "иван", "réeux", "山田太郎", "x" * 70, "Ж9é", "-._", "ಕ"]
    df = spark.createDataFrame([(v, 7 * i) for i, v in enumerate(values)], "v string, n long")
    rows = df.select("v", "n", P.permute_text(F.col("v"), "k", "t", True).alias("text"),
                     P.permute_number(F.col("n"), 90, "k", "u").alias("number"),
                     P.permute_number(F.col("n"), 1 << 20, "k", "u").alias("wide")).collect()
    for r in rows:
        assert r.text == plain_text(r.v, "k", "t")
        assert plain_text(r.text, "k", "t", undo=True) == r.v
        assert r.number == plain_number(r.n, 90, "k", "u") and r.wide == plain_number(r.n, 1 << 20, "k", "u")


def test_whole_values_against_a_plain_version(spark):
    days = [date(1987, 6, 5), date(1999, 12, 31), date(2024, 2, 29)]
    first = date(1900, 1, 1)

    def moved(d):
        return first + timedelta(days=plain_number((d - first).days, 73049, "k", "date"))

    def walked(d):
        d = moved(d)
        while d.day <= 12:
            d = moved(d)
        return d

    def phone(v):
        v = plain_text(v, "k", "bare phone")
        return v if v[0] in "23456789" and v[3] in "23456789" else phone(v)

    texts = [d.isoformat() for d in days] + [f"{d:%d/%m/%Y}" for d in days if d.day > 12]
    texts += ["499-555-6503", "jo.hn@x.example"]
    want = [moved(d).isoformat() for d in days] + [f"{walked(d):%d/%m/%Y}" for d in days if d.day > 12]
    d = phone("4995556503")
    want += [f"{d[:3]}-{d[3:6]}-{d[6:]}", plain_text("jo.hn", "k", "email") + "@x.example"]
    assert [t for t, _ in run(spark, texts)] == want


def test_thousands_of_matches_in_one_text(spark):
    text = " ".join(f"user{i}@mail.example, 499-555-{i % 10000:04d}, 1987-06-{1 + i % 28:02d};" for i in range(3000))
    ((out, counts),) = run(spark, [text])
    assert counts == {"email": 3000, "phone": 3000, "date": 3000}
    assert len(out) == len(text) and out.count(";") == 3000
    assert len(set(re.findall(r"\S+@mail", out))) == 3000


def test_a_column_of_that_name_is_replaced_and_others_stay(spark):
    df = spark.createDataFrame([(1, "a@b.example", "x", "y")], "doc_id long, text string, pii_counts string, _made string")
    row = P.pseudonymise(df, "k", counts=True).first()
    assert row.pii_counts == {"email": 1} and row._made == "y"
    assert P.pseudonymise(df, "k").first().pii_counts == "x"


def test_matches_are_found_once(spark):
    df = spark.createDataFrame([(1, "a@b.example")], "doc_id long, text string")
    plan = P.pseudonymise(df, "k", counts=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_awkward_rows(spark, awkward, empty, documents, capsys):
    out = P.pseudonymise(awkward, "k")
    assert out.columns == awkward.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, awkward.collect()))
    assert P.pseudonymise(empty, "k").count() == 0
    again = P.pseudonymise(documents, "k", counts=True)
    before = {r.doc_id: r for r in documents.collect()}
    for r in again.collect():
        if not r.pii_counts:
            assert r.text == before[r.doc_id].text
    again.explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))
