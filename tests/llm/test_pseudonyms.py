import re

import pytest
from samples import ROWS, no_documents, odd_documents

from corpusloom.llm import pseudonyms


def renamed(spark, texts, key="k"):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = df.select("doc_id", pseudonyms.replace_private(F.col("text"), key).alias("d")).collect()
    return [tuple(r.d) for r in sorted(done, key=lambda r: r.doc_id)]


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def closed(body):
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


def test_formats_stay_and_values_stay_linked(spark):
    text = (
        "a ab.12@mail3.example.com, +1 (663) 555-6869. 70.23.22.57. 4465758382889437 4465-7583-8288-9437 "
        "2024-02-29 31.12.1999 12/25/2020 25/12/2020 123-45-6789 end"
    )
    (got, count), (other, _) = renamed(spark, [text, "663-555-6869 ab.12@mail3.example.com 4465 7583 8288 9437"])
    form = re.compile(
        r"a ([a-z]{2}\.\d\d)@mail3\.example\.com, \+1 \((\d{3})\) (\d{3}-\d{4})\. (\d+\.\d+\.\d+\.\d+)\. (\d{16}) (\d{4}-\d{4}-\d{4}-\d{4}) "
        r"(\d{4}-\d\d-\d\d) (\d\d\.\d\d\.\d{4}) (\d\d/\d\d/\d{4}) (\d\d/\d\d/\d{4}) (\d{3}-\d\d-\d{4}) end"
    ).fullmatch(got)
    assert form and count == 10
    local, area, rest, address, card, grouped = form.groups()[:6]
    assert card == grouped.replace("-", "") and luhn(card) and card != "4465758382889437" and card[0] == "4"
    assert all(int(o) < 256 for o in address.split("."))
    assert other == f"{area}-{rest} {local}@mail3.example.com {grouped.replace('-', ' ')}"


@pytest.mark.parametrize("make", [
    lambda i: closed(f"4{i:014d}"), lambda i: f"10.0.{i // 256}.{i % 256}", lambda i: f"212-555-{i:04d}",
    lambda i: f"{1990 + i // 336}-{1 + i % 336 // 28:02d}-{1 + i % 28:02d}", lambda i: f"x{i:03d}@a.org", lambda i: f"123-45-{i + 1:04d}",
])
def test_no_two_values_meet(spark, make):
    values = [make(i) for i in range(600)]
    got = [t for t, _ in renamed(spark, values)]
    assert len(set(got)) == len(set(values))
    assert sum(a == b for a, b in zip(values, got)) <= 3
    assert got != [t for t, _ in renamed(spark, values, "other key")]


def test_country_codes(spark):
    texts = ["call +44 20 7946 0958 now", "+49-30-1234", "+1 663.555.6869", "1+2 30 40"]
    got = [t for t, _ in renamed(spark, texts)]
    assert re.fullmatch(r"call \+44 \d\d \d{4} \d{4} now", got[0]) and got[0] != texts[0]
    assert re.fullmatch(r"\+\d\d-\d\d-\d{4}", got[1]) and got[1] != texts[1]
    assert re.fullmatch(r"\+1 \d{3}\.\d{3}\.\d{4}", got[2]) and got[3] == texts[3]


def test_other_forms_of_numbers_and_dates(spark):
    forms = {
        "+15551234567": r"\+1\d{10}", "+44 7911 123456": r"\+44 \d{4} \d{6}", "+49 151 12345678": r"\+49\d? \d{3} \d{8}",
        "+49 (0)30/1234567": r"\+\d\d \(\d\)\d\d/\d{7}", "+33 1.23.45.67.89": r"\+3\d \d\.\d\d\.\d\d\.\d\d\.\d\d",
        "+1234567": r"\+\d{7}", "3782 822463 10005": r"3\d{3} \d{6} \d{5}", "3782-822463-10005": r"3\d{3}-\d{6}-\d{5}",
        "3/7/2021": r"\d\d?/\d\d?/\d{4}", "2021/03/07": r"\d{4}/\d\d/\d\d", "2021/3/7": r"\d{4}/\d\d?/\d\d?",
        "3.7.2021": r"\d\d?\.\d\d?\.\d{4}", "25/7/2021": r"\d\d?/\d\d?/\d{4}",
    }
    got = renamed(spark, [f"on {v}, then" for v in forms])
    for (value, form), (text, count) in zip(forms.items(), got):
        assert count == 1 and value not in text and re.fullmatch(f"on {form}, then", text), (value, text)
    assert all(luhn(re.sub(r"\D", "", got[i][0])) for i in (6, 7))
    spelt = [t for t, _ in renamed(spark, ["3/7/2021", "03/07/2021", "2021/03/07", "2021-03-07", "7.3.2021", "+15551234567", "555-123-4567"])]
    days = {tuple(int(spelt[0].split("/")[i]) for i in (2, 0, 1))}
    days |= {tuple(map(int, spelt[i].replace("-", "/").split("/"))) for i in (2, 3)}
    days |= {tuple(int(spelt[1].split("/")[i]) for i in (2, 0, 1)), tuple(int(x) for x in reversed(spelt[4].split(".")))}
    assert len(days) == 1
    assert spelt[5][2:] == spelt[6].replace("-", "")


def test_a_number_ends_where_another_value_starts(spark):
    texts = ["+49 30 1234567 2021-03-07", "+15551234567 2021 +5 - 10 - 20 - 300 3782 822463 10006", "/2021/03/07/ 13/32/2021 2021/13/01"]
    got = [t for t, _ in renamed(spark, texts)]
    assert re.fullmatch(r"\+4\d \d\d \d{7} \d{4}-\d\d-\d\d", got[0]) and renamed(spark, texts)[0][1] == 2
    assert re.fullmatch(r"\+1\d{10} 2021 \+5 - 10 - 20 - 300 3782 822463 10006", got[1]) and got[2] == texts[2]


def test_what_fails_its_check_stays(spark):
    texts = [
        "4465758382889438", "256.1.1.1 and 1.2.3", "2023-02-30 13/13/2020 00.01.2020", "000-12-3456", "v1.2.3.4.5", "9999999999",
        "Version 2.0. no digits, me@home", "4 465758382889437", "ab4465758382889437",
    ]
    assert renamed(spark, texts) == [(t, 0) for t in texts]


def test_odd_rows(spark):
    df = odd_documents(spark)
    done = pseudonyms.pseudonymise(df, "k")
    assert done.columns == df.columns
    assert sorted(map(repr, done.select("doc_id", "text").collect())) == sorted(map(repr, df.select("doc_id", "text").collect()))
    assert pseudonyms.pseudonymise(no_documents(spark), "k").count() == 0
    assert len(ROWS) == done.count()


def test_long_runs(spark):
    texts = ["9" * 60_000, "a" * 60_000, "1." * 30_000, ("x@y " * 9_000).strip(), "a@b.c" * 5000]
    assert [len(t) for t, _ in renamed(spark, texts)] == [len(t) for t in texts]


def test_social_security_numbers_stay_valid(spark):
    areas = [1, 2, 665, 667, 899, *range(3, 660, 7), *range(668, 899, 5)]
    texts = [f"{a:03d}-{1 + a % 99:02d}-{1 + a * 37 % 9999:04d}" for a in areas] + ["001-01-0001", "899-99-9999"]
    got = [t for t, _ in renamed(spark, texts)]
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t) for t in got) and len(set(got)) == len(set(texts))
    assert sum(a != b for a, b in zip(texts, got)) > 0.98 * len(texts)


def test_domains_of_many_labels(spark):
    longest = "x@" + "a." * 126 + "com"
    texts = ["x@" + "a." * 100_000 + "com", "x@" + "a." * 100_000 + "1", "x@" + "abc." * 100_000, "x@" + "a" * 100_000, longest]
    got = renamed(spark, texts)
    assert [len(t) for t, _ in got] == [len(t) for t in texts] and got[4][1] == 1 and got[4][0][1:] == longest[1:]
    assert [n for _, n in got[:2]] == [0, 0] and got[3] == (texts[3], 0)


def test_query_leaves_no_planted_value(spark, sf):
    from corpusloom.llm.queries import all_queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = all_queries()["op3_pii_pseudonyms"](spark, sf).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        old = texts[r.doc_id]
        values = re.findall(r"[^\s@]+@[a-z0-9.]+\.com|\+1 \(\d+\) \d{3}-\d{4}|(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d])", old)
        values += [v for v in re.findall(r"(?<!\w)\d{16}(?!\w)", old) if luhn(v)]
        found += len(values)
        assert not [v for v in values if v in r.text]
        assert r.text == old if not values else len(r.text) > 0
    assert found > 5
