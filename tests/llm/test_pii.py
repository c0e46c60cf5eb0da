import re

import pytest

from paperloom.llm import pii

SCHEMA = "doc_id long, text string, pii int, literal string"
TEXTS = [
    "Mail Ann.Lee@Corp.example.org or ann.lee@corp.example.org now", "Call +1 (017) 555-7713 or +1-017-555-7713, 10.2.3.4!",
    "Frau Müller und Mr. John Smith, Mr. Smith; Госпожа Анна Иванова", "4111 1111 1111 1111 and 4111111111111111 years 2020 2021 2022 2023",
    "DE89 3704 0044 0532 0130 00 or 123-45-6789", None, "", "plain text, 12 of 345 at 3.14 and 1.2.3", "x@y", "4111111111111111"]


@pytest.fixture(scope="module")
def replaced(spark):
    rows = spark.createDataFrame([(i, t, 7, "l") for i, t in enumerate(TEXTS)], SCHEMA)
    return {r.doc_id: r for r in pii.replace_personal_data(rows).collect()}


def test_clean_texts_and_other_columns_stay(replaced):
    assert len(replaced) == len(TEXTS) and all(r.literal == "l" for r in replaced.values())
    for i in (5, 6, 7, 8):
        assert replaced[i].text == TEXTS[i] and replaced[i].pii == {}


def test_kinds(replaced):
    assert [replaced[i].pii for i in range(5)] == [{"email": 2}, {"phone": 2, "ip": 1}, {"name": 4}, {"number": 2}, {"iban": 1, "ssn": 1}]


def test_coreference_format_gender_and_script(replaced):
    a, b = re.findall(r"\S+@\S+", replaced[0].text)
    assert a.lower() == b and a[0].isupper() and a[4].isupper() and b.endswith(".org") and len(b) == len("ann.lee@corp.example.org")
    first, second = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1-\d{3}-\d{3}-\d{4}", replaced[1].text)
    assert re.sub(r"\D", "", first) == re.sub(r"\D", "", second) != "10175557713"
    m = re.fullmatch(r"Frau (\w+) und Mr\. (\w+) (\w+), Mr\. (\w+); Госпожа (\w+) (\w+)", replaced[2].text)
    assert m and m[3] == m[4] != m[1] and m[2].endswith("ron") and m[5].endswith("рия") and not {"Smith", "Müller"} & set(m.groups())
    grouped, plain = re.match(r"([\d ]{19}) and (\d{16}) years 2020 2021 2022 2023", replaced[3].text).groups()
    assert grouped.replace(" ", "") == plain == replaced[9].text and luhn(plain)
    assert replaced[4].text.startswith("DE89 ") and "3704" not in replaced[4].text


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_surrogates_are_distinct_even_in_a_crowded_format(spark):
    keys = spark.createDataFrame([("number", f"{i:03d}") for i in range(0, 1000, 3)], "kind string, plain string")
    keys = keys.unionByName(spark.createDataFrame([("male", f"n{i}") for i in range(400)], "kind string, plain string"))
    rows = pii.surrogates(keys, "secret").collect()
    made = [(r.kind, r.surrogate) for r in rows]
    assert len(set(made)) == len(rows) == keys.count() and not set(made) & {(r.kind, r.plain) for r in rows}
    assert {r.plain: r.surrogate for r in rows} != {r.plain: r.surrogate for r in pii.surrogates(keys, "other").collect()}


def test_impossible_formats_are_refused(spark):
    with pytest.raises(ValueError):
        pii.surrogates(spark.createDataFrame([("ssn", str(i)) for i in range(10)], "kind string, plain string"), "s")


def test_empty_table_and_repeated_rows(spark):
    assert pii.replace_personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = pii.replace_personal_data(spark.createDataFrame([(None, "at 10.1.1.1", 0, "")] * 2, SCHEMA)).collect()
    assert len(twice) == 2 and twice[0].text == twice[1].text != "at 10.1.1.1"


def texts_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.replace_personal_data(rows).orderBy("doc_id").collect()]


def test_phone_numbers_are_one_in_any_spelling_and_distinct_as_written(spark):
    same = [["+1 415 555 0123", "+14155550123", "+1-415-555-0123"], ["+49 30 1234567", "+49301234567"], ["+353 12 345 678", "+35312345678"]]
    many = [f"+{n}" for n in range(4155550, 4155850)]
    out = texts_of(spark, sum(same, []) + many + ["415-555-0123", "+4155550123"])
    digits = [re.sub(r"[^+0-9]", "", x) for x in out]
    assert len(set(digits[:3])) == len(set(digits[3:5])) == len(set(digits[5:7])) == 1
    assert digits[0].startswith("+1") and not digits[0].startswith("+1415") and digits[3].startswith("+49") and digits[5].startswith("+353")
    made = digits[7:-2]
    assert len(set(made)) == len(many) and not set(made) & set(many) and all(x.startswith("+41") for x in made)
    assert digits[-2] not in digits[-1]


def test_full_formats_get_longer_replacements(spark, monkeypatch):
    monkeypatch.setattr(pii, "SHAPED", 2)
    monkeypatch.setattr(pii, "TRIES", 4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.com" for a in letters for b in letters]
    out = texts_of(spark, mails + ["A@B.com"])
    assert len(set(out[:-1])) == len(mails) and not set(out) & set(mails) and all(re.fullmatch(r"[a-z]+@[a-z]\.com", x) for x in out[:-1])
    assert out[-1].lower() == out[1]
    ssn = spark.createDataFrame([("ssn", str(i)) for i in range(10)], "kind string, plain string")
    made = [r.surrogate for r in pii.surrogates(ssn, "s", longer=True).collect()]
    assert len(set(made)) == 10 and all(len(x) > 1 for x in made)


def test_bare_mentions_of_a_name_go_with_it(spark):
    texts = ["Mr. John Smith met Anna. Later Smith and John Smith said; SMITH's car, Smithson, smith. John-Paul",
             "O'Neill came early. Mrs. Jane O'Neill's hat", "Smith and John without a form of address", "Mail John@x.example.org or Mr. John",
             "Smith " * 3000 + "Mr. Smith", "Мария ушла. Госпожа Мария Петрова и Петрова"]
    out = texts_of(spark, texts)
    given, family = re.match(r"Mr\. (\w+) (\w+) met Anna", out[0]).groups()
    assert out[0] == f"Mr. {given} {family} met Anna. Later {family} and {given} {family} said; {family.upper()}'s car, Smithson, smith. John-Paul"
    m = re.fullmatch(r"(\w+) came early\. Mrs\. (\w+) (\w+)'s hat", out[1])
    assert m and m[1] == m[3] and m[2].endswith("ria")
    assert out[2] == texts[2]
    assert "John" not in out[3].split()[-1] and out[4] == f"{family} " * 3000 + f"Mr. {family}"
    m = re.fullmatch(r"(\w+) ушла\. Госпожа (\w+) (\w+) и (\w+)", out[5])
    assert m and m[1] == m[2] != m[3] == m[4]


def test_titles_in_a_row_and_without_gender(spark):
    out = texts_of(spark, ["Dr. Jane Brown", "Mrs. Jane Brown", "Herr Prof. Dr. Hans Meier, Hans", "Prof. Kim Lee and Dr. Kim", "Dr. No. 5 Drive Doctor"])
    assert out[0][4:] == out[1][5:] and out[0].startswith("Dr. ") and out[0].split()[1].endswith("ria")
    m = re.fullmatch(r"Herr Prof\. Dr\. (\w+) (\w+), (\w+)", out[2])
    assert m and m[1] == m[3] and m[1].endswith("ron") and not {"Hans", "Meier"} & set(m.groups())
    m = re.fullmatch(r"Prof\. (\w+) (\w+) and Dr\. (\w+)", out[3])
    assert m and m[1].endswith("lin")
