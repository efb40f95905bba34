"""Pseudonyms against a plain Python network, and the properties a permutation must have."""

import hashlib
import re
from datetime import date, timedelta

import pytest
import regex
from pyspark.sql import functions as F

from shelfwise.llm import pii

KEY = "test-key"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10


def feistel(kind, u, v, a, b):
    for number in range(1, pii.ROUNDS + 1):
        seed = "|".join([KEY, kind, str(a), str(b), str(number), str(v)])
        u, v, a, b = v, (u + int(hashlib.sha256(seed.encode()).hexdigest()[:15], 16)) % a, b, a
    return u, v


def refill(value, digits):
    digits = iter(digits[len(digits) - sum(c.isdigit() for c in value):])
    return "".join(next(digits) if c.isdigit() else c for c in value)


def plain(value):
    """(kind, pseudonym) of a matched value, (None, value) if it isn't valid."""
    digits = re.sub("[^0-9]", "", value)
    if "@" in value:
        name, host = value.split("@")
        return "email", "u" + hashlib.sha256("|".join([KEY, "email", name.lower(), host.lower()]).encode()).hexdigest()[:16] + "@" + host
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", value):
        o = [int(x) for x in value.split(".")]
        if max(o) > 255:
            return None, value
        u, v = feistel("ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return "ipv4", f"{u // 256}.{u % 256}.{v // 256}.{v % 256}"
    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)|(\d\d)([./])(\d\d)\5(\d{4})", value):
        y, mo, d = (m[1], m[2], m[3]) if m[1] else (m[7], m[6], m[4])
        try:
            day = date(int(y), int(mo), int(d))
        except ValueError:
            return None, value
        if not 1800 <= day.year <= 2199:
            return None, value
        at = (day - date(1800, 1, 1)).days
        u, v = feistel("date", at // 189, at % 189, 773, 189)
        new = date(1800, 1, 1) + timedelta(days=u * 189 + v)
        return "date", new.strftime("%Y-%m-%d" if m[1] else f"%d{m[5]}%m{m[5]}%Y")
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", value):
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None, value
        u, v = feistel("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
        return "ssn", f"{u + 1 + (u >= 665):03d}-{v // 9999 + 1:02d}-{v % 9999 + 1:04d}"
    if value[0] in "+(":
        u, v = feistel("phone", int(digits[-10:-5]), int(digits[-5:]), 100000, 100000)
        return "phone", refill(value, digits[:-10] + f"{u:05d}{v:05d}")
    if 13 <= len(digits) <= 19 and luhn(digits) == 0:
        n = len(digits) - 1
        left, right = n // 2, n - n // 2
        u, v = feistel("card", int(digits[:left]), int(digits[left:-1]), 10 ** left, 10 ** right)
        body = f"{u:0{left}d}{v:0{right}d}"
        return "card", refill(value, body + str(-luhn(body + "0") % 10))
    return None, value


def plain_text(text):
    found = []

    def swap(match):
        kind, new = plain(match[0])
        if kind:
            found.append((kind, new))
        return new

    return (regex.sub(pii._ALL, swap, text) if text is not None else None), found


TEXTS = [
    None, "", "no data, version 2.0. and 4.0 and 10.11 and 3", "mail a.b-c@mail7.example.com, A.B-C@mail7.example.com!", "x@y",
    "233.254.104.120 and 256.1.1.1 and 1.2.3.4.5 and 1.2.3 and 10.0.0.255.", "+1 (017) 555-7713, (974) 555-3436 and +44 123 456 7890",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 0000000000000000 378282246310005 6304000000000000000",
    "078-05-1120 000-12-3456 666-12-3456 900-12-3456 123-00-4567 899-99-9999 001-01-0001 667-01-0001 665-01-0001",
    "2024-02-29 2023-02-29 29.02.2024 31/12/1999 32.01.2000 1799-12-31 1800-01-01 2199-12-31 01/13/2000 1.2.2003",
    "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"### 4785380592391139$$$ 152.143.123.131###",
    "é4111111111111111 4111111111111111é 123 4111111111111111 5", "4111111111111111 " * 3_000,
    "a@b.co" * 50, "1-2-3 555-1234 12-34-5678",
]


@pytest.fixture(scope="module")
def result(spark):
    rows = [(i, t, "own", 3) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], None, None)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _matches string, _placed int")
    return frame, pii.pseudonymise(frame, KEY)


def test_equals_plain_network(result):
    frame, out = result
    assert out.columns == [*frame.columns, "pii"]
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        if row.doc_id is not None:
            text, found = plain_text(TEXTS[row.doc_id])
            assert (row.text, [tuple(x) for x in row.pii or []]) == (text, found), TEXTS[row.doc_id][:80] if TEXTS[row.doc_id] else None


def test_same_value_same_pseudonym_whatever_the_punctuation(result):
    cards = [x.pseudonym for x in result[1].where("doc_id = 7").first().pii][:3]
    assert len({re.sub("[^0-9]", "", c) for c in cards}) == 1 and len(set(cards)) == 3


def test_clean_text_is_untouched(result):
    for row in result[1].where("doc_id in (1, 2, 4, 14)").collect():
        assert row.text == TEXTS[row.doc_id] and row.pii == []


def test_small_domain_is_permuted(spark):
    """Every day of the 400 years gets another day, none twice."""
    days = spark.range(pii._DAYS).select(F.date_format(F.date_add(F.lit(pii._FIRST_DAY).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii.pseudonymise(days, KEY).select("text").distinct()
    assert out.count() == pii._DAYS and out.agg(F.min("text"), F.max("text")).first() == ("1800-01-01", "2199-12-31")


def test_key_matters_and_is_needed(spark):
    frame = spark.createDataFrame([("4111111111111111",)], "text string")
    assert pii.pseudonymise(frame, "a").first().text != pii.pseudonymise(frame, "b").first().text
    with pytest.raises(ValueError):
        pii.pseudonymise(frame, "")


def test_native_and_without_shuffle(result, spark):
    plan = result[1]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert pii.pseudonymise(spark.createDataFrame([], "text string"), KEY).count() == 0
