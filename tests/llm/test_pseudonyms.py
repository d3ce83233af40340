"""Pseudonyms keep formats, link equal values, and can be undone."""

import datetime
import re

from pyspark.sql import functions as F

from hitloom.llm import pseudonyms as P

SCHEMA = "doc_id long, text string, n_replaced string, key int"


def luhn(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


VALID = [
    "4111111111111111", "5500 0055 5555 5559", "3400-0000-0000-009", "83.229.25.121", "0.0.0.0", "2024-02-29", "31/12/1999", "12/31/1999", "1.2.2003",
    "123-45-6789", "899-99-9999", "+1 (017) 555-7713", "+49 30 1234567", "(212) 555-1234", "212-555-1234", "a.55@mail4.example.com", "x_y-z+9@sub.ex-ample.org",
]
INVALID = ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "2023-02-30", "32/01/2000", "666-45-6789", "123-00-6789", "version 2.0.", "12345", "a@b", "@home", "in 1999"]


def run(spark, texts, **options):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in P.replace_values(df, **options).orderBy("doc_id").collect()]


def test_valid_values_move_within_their_format(spark):
    got = run(spark, VALID)
    for before, after in zip(VALID, got):
        assert before != after and len(before.split("@")[0]) == len(after.split("@")[0]) or "." in before
        shape = lambda t: re.sub(r"[0-9]+", "9", t)
        if "@" in before:
            assert before.split("@")[1] == after.split("@")[1]
        else:
            assert shape(before) == shape(after)
    assert all(luhn(t) for t in got[:3])
    assert all(0 <= int(o) < 256 for o in got[3].split("."))
    datetime.date.fromisoformat(got[5])
    datetime.datetime.strptime(got[6], "%d/%m/%Y")
    datetime.datetime.strptime(got[7], "%m/%d/%Y")
    area, group, serial = map(int, got[9].split("-"))
    assert 0 < area < 900 and area != 666 and group and serial
    assert got[11].startswith("+1 (")
    assert run(spark, VALID, key="other") != got
    back = spark.createDataFrame(list(enumerate(got)), "doc_id long, text string")
    assert [r.text for r in P.restore(back).orderBy("doc_id").collect()] == VALID


def test_other_texts_stay(spark):
    texts = INVALID + ["", "no numbers at all"]
    assert run(spark, texts) == texts


def test_equal_values_stay_linked_and_text_around_stays(spark):
    rows = [
        (1, "Card 4111111111111111, again 4111 1111 1111 1111! é\nend", "c", 1), (2, "4111111111111111", "c", 1), (2, "4111111111111111", "c", 1),
        (3, None, "c", 1), (None, "", "c", 1), (4, "x" * 300_000 + " 83.229.25.121 83.229.25.121", "c", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = P.replace_values(df)
    assert got.columns == df.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    card = texts[2]
    spaced = " ".join(card[k : k + 4] for k in range(0, 16, 4))
    assert texts[1] == f"Card {card}, again {spaced}! é\nend"
    assert texts[3] is None and texts[None] == ""
    assert texts[4].startswith("x" * 300_000) and len(set(texts[4].split()[1:])) == 1
    assert P.replace_values(df.limit(0)).collect() == []
    counted = P.replace_values(df.drop("n_replaced")).where("doc_id = 1").first()
    assert counted.n_replaced == 2


def test_networks_are_permutations(spark):
    ids = spark.range(97 * 101).select((F.col("id") % 97).alias("a"), F.floor(F.col("id") / 97).alias("b"))
    moved = ids.select("a", "b", P.feistel("k", "t", F.col("a"), F.col("b"), F.lit(97), F.lit(101), F.lit(1)).alias("m"))
    assert moved.select("m").distinct().count() == 97 * 101
    back = P.feistel("k", "t", F.col("m.a"), F.col("m.b"), F.lit(97), F.lit(101), F.lit(1), undo=True)
    assert moved.select("a", "b", back.alias("r")).where("r.a != a OR r.b != b").count() == 0


def spellings(day):
    d, m, y = day.day, day.month, f"{day.year:04d}"
    found = {f"{y}-{m:02d}-{d:02d}"}
    for mark in "/.":
        found |= {f"{a}{mark}{b}{mark}{y}" for a in (str(d), f"{d:02d}") for b in (str(m), f"{m:02d}")}
    # Month first is read as such only where the day can't be a month.
    return found | ({f"{a}/{d}/{y}" for a in (str(m), f"{m:02d}")} if d > 12 else set())


def test_dates_of_every_spelling_are_permuted_in_their_spelling(spark):
    """Every day of some years, and the days around the leap days of four centuries."""
    start, days = datetime.date(1996, 1, 1), set()
    for k in range(3 * 366):
        days.add(start + datetime.timedelta(k))
    for year in range(1799, 2240):
        days |= {datetime.date(year, 2, 28), datetime.date(year, 3, 1), datetime.date(year, 12, 31), datetime.date(year, 1, 9)}
        if year % 4 == 0 and (year % 100 or year % 400 == 0):
            days.add(datetime.date(year, 2, 29))
    days |= {datetime.date(y, m, d) for y, m, d in ((1, 1, 1), (799, 12, 31), (800, 2, 29), (1599, 12, 31), (2400, 2, 29), (9600, 2, 29), (9999, 12, 31))}
    texts = sorted(set().union(*map(spellings, days)))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = [r.text for r in P.replace_values(df.repartition(4)).orderBy("doc_id").collect()]
    back = [r.text for r in P.restore(spark.createDataFrame(list(enumerate(got)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert back == texts
    assert len(set(got)) == len(texts)
    shape = lambda t: re.sub("[0-9]", "9", t)
    assert [shape(t) for t in got] == [shape(t) for t in texts]
    first = re.compile(r"([0-9]+)[/.]([0-9]+)[/.]([0-9]{4})$")
    for before, after in zip(texts, got):
        if (m := first.match(after)) is None:
            datetime.date.fromisoformat(after)
            continue
        a, b, year = map(int, m.groups())
        assert (b > 12) == (int(first.match(before)[2]) > 12)
        datetime.date(year, a, b) if b > 12 else datetime.date(year, b, a)
    assert sum(a == b for a, b in zip(texts, got)) < 40
    assert all(1600 <= int(t[:4]) < 2400 for t, u in zip(got, texts) if "-" in t and 1600 <= int(u[:4]) < 2400)


def test_no_dates(spark):
    texts = ["0000-01-01", "2023-02-29", "1900-02-29", "31.04.2020", "29/02/2023", "13/13/2000", "00/01/2000", "1/0/2000", "2/30/2000", "12.13.2000"]
    assert run(spark, texts) == texts


def test_key_of_the_session(spark):
    spark.conf.set(P.KEY_SETTING, "secret")
    try:
        with_setting = run(spark, VALID)
    finally:
        spark.conf.unset(P.KEY_SETTING)
    assert with_setting == run(spark, VALID, key="secret") != run(spark, VALID)
