"""Personal data replaced by format-preserving Feistel pseudonyms.

Card numbers, social security numbers, phone numbers, IP addresses, dates and the
local parts of e-mail addresses are found and validated; each is then permuted within
its own format by a keyed Feistel network. The same value gives the same pseudonym in
every document, different values give different ones, and the holder of the key can
undo it (`restore`). Numbers that fail validation, and everything else, stay as they are.

A date is permuted among the dates that can be spelled as it is: day or month first,
with slashes or dots, fields of one or two digits. Equal dates in different spellings
therefore have different pseudonyms, and each is spelled as the date it stands for.

A network splits a value into two numbers a and b of known ranges and adds to each in
turn a keyed hash of the other, modulo its range. The ranges multiply to exactly the
values the format allows, so every pseudonym is valid again: check digits are computed
anew, dates stay dates, octets stay octets.

One pass over the documents in Spark's own expressions, without a shuffle; texts
without a digit or @ are not searched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The session setting that holds the key, and the key for trials where it is unset.
KEY_SETTING = "spark.hitloom.pseudonym.key"
KEY = "change me"
ROUNDS = 8

# The formats.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}+",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[/.\-][0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9]|-[0-9])",
    "card": r"(?<![0-9.\-])(?:[0-9][ \-]?){12,18}[0-9](?![0-9]|-[0-9])",
}
ANY = "|".join(PATTERNS.values())
SSN_AREAS, SSN_REST = 898, 99 * 9999
#: Characters of one half whose number fits 63 bits, and of both.
_HALF = {10: 18, 36: 12}


def _round_value(key: str, kind: str, size: Column, index: Column, other: Column) -> Column:
    """60 bits of a keyed hash."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), size.cast("string"), index.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, a: Column, b: Column, a_range: Column, b_range: Column, size: Column, undo: bool = False) -> Column:
    """The pair of numbers permuted (or restored), as a struct of ``a`` and ``b``."""
    sign = -1 if undo else 1

    def step(pair: Column, index: Column) -> Column:
        left, right = pair["a"], pair["b"]
        moved_a = F.pmod(left + F.pmod(_round_value(key, kind, size, index, right), a_range) * sign, a_range)
        moved_b = F.pmod(right + F.pmod(_round_value(key, kind, size, index, left), b_range) * sign, b_range)
        even = index % 2 == 0
        return F.struct(F.when(even, moved_a).otherwise(left).alias("a"), F.when(even, right).otherwise(moved_b).alias("b"))

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(order, start, step)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _characters(key: str, kind: str, text: Column, radix: int, undo: bool) -> Column:
    """Digits (or base-36 characters), permuted among the strings of their length."""
    most = _HALF[radix] * 2
    powers = F.array(*(F.lit(radix**k) for k in range(_HALF[radix] + 1)))

    def chunk(start: Column) -> Column:
        part = F.substr(text, start, F.lit(most))
        size = F.char_length(part)
        u = F.floor(size / 2).cast("int")
        left, right = F.substr(part, F.lit(1), u), F.substr(part, u + 1, size)
        a = F.when(u == 0, F.lit(0)).otherwise(F.conv(left, radix, 10).cast("long"))
        b = F.conv(right, radix, 10).cast("long")
        pair = feistel(key, kind, a, b, F.element_at(powers, u + 1), F.element_at(powers, size - u + 1), F.concat_ws("-", size, start), undo)
        # Both halves padded to their length again.
        joined = F.transform(
            F.array(pair),
            lambda p: F.concat(_padded(p["a"], radix, u), _padded(p["b"], radix, size - u)),
        )
        return F.element_at(joined, 1)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text), F.lit(most)), chunk), "")


def _padded(value: Column, radix: int, size: Column) -> Column:
    # A half without characters has the value 0, which is no character then.
    return F.when(size == 0, F.lit("")).otherwise(F.call_function("lpad", F.lower(F.conv(value.cast("string"), 10, radix)), size, F.lit("0")))


def _refilled(pattern: Column, characters: Column, kind: str) -> Column:
    """The pattern with its ``kind`` of characters replaced in order."""

    def place(at: Column) -> Column:
        here = F.substr(pattern, at, F.lit(1))
        used = F.char_length(F.regexp_replace(F.substr(pattern, F.lit(1), at), f"[^{kind}]", ""))
        return F.when(here.rlike(f"[{kind}]"), F.substr(characters, used, F.lit(1))).otherwise(here)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(pattern)), place), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of all digits, the last one being the check digit."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, -at, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add)


def _card(key: str, value: Column, undo: bool) -> Column:
    digits = _digits(value)
    body = _characters(key, "card", F.substr(digits, F.lit(1), F.char_length(digits) - 1), 10, undo)
    check = F.element_at(F.transform(F.array(body), lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string"))), 1)
    return F.when(luhn_sum(digits) % 10 == 0, _refilled(value, check, "0-9")).otherwise(value)


def _ssn(key: str, value: Column, undo: bool) -> Column:
    area, group, serial = (F.substr(value, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    a = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = feistel(key, "ssn", a, (group - 1) * 9999 + serial - 1, F.lit(SSN_AREAS), F.lit(SSN_REST), F.lit(9), undo)

    def text(p: Column) -> Column:
        number = p["a"] + 1 + F.when(p["a"] >= 665, 1).otherwise(0)
        return F.format_string("%03d-%02d-%04d", number, F.floor(p["b"] / 9999) + 1, p["b"] % 9999 + 1)

    return F.when(valid, F.element_at(F.transform(F.array(pair), text), 1)).otherwise(value)


def _ip(key: str, value: Column, undo: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    pair = feistel(key, "ip", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), F.lit(4), undo)
    parts = lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)
    return F.element_at(F.transform(F.array(pair), parts), 1)


def _is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def _leaps_before(year: Column) -> Column:
    """Leap years from year 1 up to the one before."""
    y = year - 1
    return F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400)


def _days_of(days: range, months: range) -> list[int]:
    """Month * 100 + day of these days in a year without a 29th of February."""
    length = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
    return [month * 100 + day for month in months for day in days if day <= length[month - 1]]


def _date_class(key: str, kind: str, year: Column, monthday: Column, days: list[int], undo: bool) -> Column:
    """The date permuted among the dates of its class, as a struct ``year``, ``monthday``; null if it is none.

    A class has the same days in every year, so years and days are the two numbers of a
    network. Leap days are permuted among the leap years. Years stay in their 800 years
    (the first have one less, the last are 400): 1600 to 2399 among them.
    """
    start = F.greatest(F.floor(year / 800) * 800, F.lit(1))
    years = F.when(year < 800, 799).when(year >= 9600, 400).otherwise(800)
    held = F.array(*map(F.lit, days))
    place = F.array_position(held, monthday) - 1
    pair = feistel(key, f"date-{kind}", year - start, place, years, F.lit(len(days)), F.lit(len(days)), undo)
    moved = F.element_at(F.transform(F.array(pair), lambda p: F.struct((p["a"] + start).alias("year"), F.element_at(held, (p["b"] + 1).cast("int")).alias("monthday"))), 1)
    leaps = F.filter(F.sequence(start, start + years - 1), _is_leap)
    nth = _leaps_before(year) - _leaps_before(start)
    # The number of leap years as a product of two numbers that are not one, if it is one.
    parts = F.when(F.size(leaps) % 2 == 0, 2).otherwise(1)
    leap_pair = feistel(key, f"date-{kind}-leap", nth % parts, F.floor(nth / parts), parts, F.floor(F.size(leaps) / parts), F.lit(29), undo)
    leap = F.element_at(
        F.transform(F.array(leap_pair), lambda p: F.struct(F.element_at(leaps, (p["b"] * parts + p["a"] + 1).cast("int")).cast("long").alias("year"), F.lit(229).alias("monthday"))), 1
    )
    known = (year > 0) & (place >= 0)
    return F.when(known, moved).when((year > 0) & (monthday == 229) & _is_leap(year) & F.lit(any(d // 100 == 2 for d in days)), leap)


#: Days and months that fields of one and of two digits can hold.
_ONE, _DAYS, _MONTHS = range(1, 10), range(1, 32), range(1, 13)


def _date(key: str, value: Column, undo: bool) -> Column:
    """Each spelling is a class of its own, so a pseudonym reads back as what it was written as.

    Fields keep their widths. A date with slashes is day first if it can be, and month
    first if its second field is above 12. Values that are no dates stay.
    """
    out = value
    year_last = F.regexp_extract(value, "([0-9]{4})$", 1).try_cast("long")
    first = F.regexp_extract(value, "^([0-9]{1,2})[/.]", 1).try_cast("long")
    second = F.regexp_extract(value, "[/.]([0-9]{1,2})[/.]", 1).try_cast("long")

    def written(moved: Column, form: str, month_first: bool) -> Column:
        day, month = moved["monthday"] % 100, F.floor(moved["monthday"] / 100)
        fields = [month, day] if month_first else [day, month]
        return F.format_string(form, *fields, moved["year"])

    classes = []
    iso = F.regexp_extract(value, "^([0-9]{4})-", 1).try_cast("long")
    iso_day = (F.regexp_extract(value, "-([0-9]{2})-", 1).try_cast("int") * 100 + F.regexp_extract(value, "-([0-9]{2})$", 1).try_cast("int")).cast("int")
    moved = _date_class(key, "iso", iso, iso_day, _days_of(_DAYS, _MONTHS), undo)
    text = F.transform(F.array(moved), lambda m: F.format_string("%04d-%02d-%02d", m["year"], F.floor(m["monthday"] / 100), m["monthday"] % 100))
    classes.append((r"^[0-9]{4}-", moved, F.element_at(text, 1)))
    for mark, name in ((r"/", "slash"), (r"\.", "dot")):
        plain = mark[-1]
        for w1 in (1, 2):
            for w2 in (1, 2):
                shape = rf"^[0-9]{{{w1}}}{mark}[0-9]{{{w2}}}{mark}"
                days = _days_of(_ONE if w1 == 1 else _DAYS, _ONE if w2 == 1 else _MONTHS)
                form = f"%0{w1}d{plain}%0{w2}d{plain}%04d"
                moved = _date_class(key, f"{name}-{w1}{w2}", year_last, (second * 100 + first).cast("int"), days, undo)
                texts = F.transform(F.array(moved), _with_form(written, form, False))
                classes.append((shape, moved, F.element_at(texts, 1)))
            if plain == "/":
                shape = rf"^[0-9]{{{w1}}}/(?:1[3-9]|[23][0-9])/"
                days = _days_of(range(13, 32), _ONE if w1 == 1 else _MONTHS)
                moved = _date_class(key, f"month-first-{w1}", year_last, (first * 100 + second).cast("int"), days, undo)
                texts = F.transform(F.array(moved), _with_form(written, f"%0{w1}d/%02d/%04d", True))
                classes.append((shape, moved, F.element_at(texts, 1)))
    for shape, moved, text in classes:
        out = F.when(value.rlike(shape) & moved.isNotNull(), text).otherwise(out)
    return out


def _with_form(written: Callable, form: str, month_first: bool) -> Callable[[Column], Column]:
    return lambda moved: written(moved, form, month_first)


def _phone(key: str, value: Column, undo: bool) -> Column:
    """The country code stays."""
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .\-(])", 0)
    rest = F.substr(value, F.char_length(country) + 1, F.char_length(value))
    return F.concat(country, _refilled(rest, _characters(key, "phone", _digits(rest), 10, undo), "0-9"))


def _email(key: str, value: Column, undo: bool) -> Column:
    """The domain stays; the local part is read in lower case."""
    local = F.lower(F.substring_index(value, "@", 1))
    characters = F.regexp_replace(local, "[^a-z0-9]", "")
    moved = _refilled(local, _characters(key, "email", characters, 36, undo), "a-z0-9")
    return F.when(characters == "", value).otherwise(F.concat(moved, F.lit("@"), F.substring_index(value, "@", -1)))


_KINDS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str = KEY, undo: bool = False) -> Column:
    """The pseudonym of one found value; the value itself if it is not valid."""
    out = value
    for kind in reversed(_KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), _KINDS[kind](key, value, undo)).otherwise(out)
    return out


def session_key(docs: DataFrame) -> str:
    return docs.sparkSession.conf.get(KEY_SETTING, KEY)


def replace_values(docs: DataFrame, text: str = "text", key: str | None = None, undo: bool = False) -> DataFrame:
    """All columns of ``docs`` with pseudonyms in ``text``, and ``n_replaced``.

    The key is that of the session's setting ``spark.hitloom.pseudonym.key`` unless given.

    ``n_replaced`` (left out if ``docs`` has a column of that name) counts the values
    changed. Null and empty texts, texts without personal data and repeated rows
    stay as they are. E-mail addresses come back in lower case before the @.
    """
    key = session_key(docs) if key is None else key
    searched = F.col(text).rlike("[0-9@]")
    found = F.when(searched, F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.withColumn("__found", found)
    rows = rows.withColumn("__moved", F.transform("__found", lambda v: pseudonym(v, key, undo)))
    pieces = F.split(F.col(text), ANY, -1)
    rebuilt = F.array_join(F.zip_with(pieces, F.col("__moved"), lambda piece, value: F.concat(piece, F.coalesce(value, F.lit("")))), "")
    rebuilt = F.when(F.size("__found") > 0, rebuilt).otherwise(F.col(text))
    changed = F.size(F.filter(F.zip_with("__found", "__moved", lambda a, b: a != b), lambda differs: differs))
    columns = [rebuilt.alias(text) if c == text else F.col(c) for c in docs.columns]
    extra = [] if "n_replaced" in docs.columns else [F.coalesce(changed, F.lit(0)).alias("n_replaced")]
    return rows.select(*columns, *extra)


def restore(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """Undo `replace_values` with the same key."""
    return replace_values(docs, text, key, undo=True)
