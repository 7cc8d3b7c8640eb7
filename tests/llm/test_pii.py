"""Pseudonyms keep formats, stay linked, and leave all else alone."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tidemark.llm import pii


def luhn(text: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(re.sub(r"\D", "", text))):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(text: str) -> int:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def changed(spark, texts: list[str], key: str = "k") -> list:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return pii.pseudonymise(docs, key).orderBy("doc_id").collect()


CASES = {
    "card": ("4111111111111111", r"\d{16}", luhn),
    "email": ("Bob.smith14@mail.example.com", r"[A-Z][a-z]{2}\.[a-z]{5}\d\d@mail\.example\.com", bool),
    "phone": ("+1 (017) 555-7713", r"\+1 \(\d{3}\) \d{3}-\d{4}", bool),
    "ip": ("97.51.17.173", r"\d+\.\d+\.\d+\.\d+", lambda s: all(int(x) < 256 for x in s.split("."))),
    "date": ("2024-02-29", r"\d{4}-\d\d-\d\d", lambda s: dt.date.fromisoformat(s)),
    "ssn": ("123-45-6789", r"\d{3}-\d\d-\d{4}", lambda s: s[:3] not in ("000", "666") and s[0] != "9"),
    "iban": ("DE89370400440532013000", r"DE\d{20}", lambda s: mod97(s) == 1),
    "secret": ("b44e15e09fd311c3cf3163b66d5a9875b883d8ce", r"[0-9a-f]{40}", bool),
}


@pytest.mark.parametrize("kind", CASES)
def test_formats(spark, kind):
    value, form, valid = CASES[kind]
    rows = changed(spark, [f"x {value}!! y", f"{value}, and {value}."])
    new = re.fullmatch(rf"x ({form})!! y", rows[0].text).group(1)
    assert new != value and valid(new)
    assert rows[1].text == f"{new}, and {new}." and rows[1].private_kinds == [kind, kind]
    assert new not in changed(spark, [f"x {value}!! y"], key="other")[0].text


def test_grouped_formats(spark):
    texts = ["4111 1111 1111 1111", "4111-1111-1111-1111", "GB82 WEST 1234 5698 7654 32", "31.12.1999", "12/31/1999"]
    for old, row in zip(texts, changed(spark, texts)):
        assert row.text != old and re.sub(r"[A-Z0-9]", "0", row.text) == re.sub(r"[A-Z0-9]", "0", old)
        assert len(row.private_kinds) == 1


def test_ibans_before_capitals_and_digits(spark):
    cases = [
        ("ES91 2100 0418 4502 0005 1332", "BIC"), ("BE68 5390 0754 7034", "EUR 20"), ("AT61 1904 3002 3457 3201", "2024"),
        ("PL61 1090 1014 0000 0712 1981 2874", "PLN"), ("GB82 WEST 1234 5698 7654 32", "A1"), ("NO93 8601 1117 947", "OK"),
    ]
    alone = changed(spark, [value for value, _ in cases])
    for (value, tail), row, own in zip(cases, changed(spark, [f"{v} {t}" for v, t in cases]), alone):
        assert row.text == f"{own.text} {tail}" and row.private_kinds == own.private_kinds == ["iban"]
        assert own.text != value and mod97(own.text) == 1


def test_international_phones(spark):
    texts = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 901820", "+49 (0)30 9018-2045", "+3612345678", "+86 138 0013 8000"]
    rows = changed(spark, [f"call {x}, then" for x in texts])
    for old, row in zip(texts, rows):
        new = row.text[5:-6]
        assert row.private_kinds == ["phone"] and new != old and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", old)
    kept = ["+1234567", "1+12345678", "+1234567890123456", "+44 20"]
    assert [r.text for r in changed(spark, kept)] == kept


def test_invalid_values_stay(spark):
    texts = ["4111111111111112", "300.1.1.1", "2023-02-30", "000-12-3456", "DE88370400440532013000", "12345", "a@b", "v1.2.3"]
    for old, row in zip(texts, changed(spark, texts)):
        assert (row.text, row.private_kinds) == (old, [])


def test_feistel_is_a_permutation(spark):
    radices = F.array(*[F.lit(n).cast("long") for n in (7, 3, 5)])
    every = spark.range(105).select(F.array(F.col("id") % 7, F.floor(F.col("id") / 7) % 3, F.floor(F.col("id") / 21)).alias("v"))
    moved = {tuple(r[0]) for r in every.select(pii.feistel(F.col("v"), radices, "k")).collect()}
    assert len(moved) == 105 and all(a < 7 and b < 3 and c < 5 for a, b, c in moved)


def test_dates_are_permuted_one_to_one(spark):
    days = spark.range(3000).select(F.col("id").alias("doc_id"), F.date_format(F.date_add(F.lit("1999-01-01"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    made = [r.text for r in pii.pseudonymise(days, "k").collect()]
    assert len(set(made)) == 3000 and all(dt.date.fromisoformat(x) for x in made)


def test_hard_rows(hard, nothing, spark):
    made = pii.pseudonymise(hard, "k")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange rangepartitioning" not in plan
    assert made.columns == [*hard.columns, "private_kinds"]
    assert sorted(str(r.text) for r in made.collect()) == sorted(str(r.text) for r in hard.collect())
    assert pii.pseudonymise(nothing, "k").count() == 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    again = pii.pseudonymise(docs, "k").withColumnRenamed("text", "new").join(docs, "doc_id")
    assert again.where("(new <> text) <> (size(private_kinds) > 0)").count() == 0
