"""Pseudonyms that keep the format: validated numbers and dates go through a keyed Feistel permutation.

A number is split in two halves; in each round one half gets the keyed digest
of the other added to it, modulo its own range. Every round can be undone, so
the whole is a permutation of all numbers of that length: equal values get
equal pseudonyms in every document, different values stay different, and the
holder of the key can go back. Addresses stay addresses, dates stay dates of
the same notation. Only valid values count: dates from 1900 to 2099, social
security numbers in the ranges that are given out, card numbers whose check digit
is right. Anything else stays as it is and is not listed.

A date with slashes is read month first; where that is no date, day first.

Null texts stay null, empty ones empty. Texts of any length are read whole.
Repeated rows get the same result. Columns of the same names are replaced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import let
from playerflow.llm.registry import query, table

ROUNDS = 10
#: For tests and checks; a run on real data passes its own.
KEY = "example-key"
EMAIL = r"(?<![\p{L}\p{N}_%+-])(?<![\p{L}\p{N}_%+-]\.)[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*@(?:[A-Za-z0-9-]{1,63}\.){1,10}[A-Za-z]{2,24}"
DATE = r"(?<![0-9.-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2})(?![0-9]|[.-][0-9])"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
KINDS = {"email": EMAIL, "date": DATE, "ip": IPV4, "card": CARD, "ssn": SSN, "phone": PHONE}
#: All kinds but cards in one pass over a text; the valid cards of a text are added to it.
NO_CARD = "|".join(f"(?:{p})" for k, p in KINDS.items() if k != "card")
_FIRST_DAY, _DAYS = "1900-01-01", 73_049  # up to 2099-12-31
_DAY_RANGES = (17, 4_297)  # their product is _DAYS
_YEARS, _LEAPS = 200, 49  # from 1900; the leap years from 1904 to 2096


def _days_of(first_month: int, last_month: int, first_day: int, last_day: int) -> tuple[str, int, int, int, int]:
    """Days of a year in these ranges as "MMdd,", their number in all years, and two factors of the least number above with fair factors."""
    days = [d for i in range(365) if first_month <= (d := dt.date(1901, 1, 1) + dt.timedelta(i)).month <= last_month and first_day <= d.day <= last_day]
    leaps = _LEAPS if first_month <= 2 <= last_month and first_day <= 29 <= last_day else 0
    total = _YEARS * len(days) + leaps
    for above in range(total, 2 * total):
        a = next((a for a in range(int(above**0.5), 29, -1) if above % a == 0), None)
        if a:
            return "".join(f"{d:%m%d}," for d in days), len(days), total, a, above // a


#: Dates that leave their own set would be read differently on the way back, so each of these is permuted in itself.
_LOW_LOW, _LOW_HIGH, _HIGH_LOW, _LATE, _LOW_LATE = DAY_SETS = (_days_of(1, 9, 1, 9), _days_of(1, 9, 10, 31), _days_of(10, 12, 1, 9), _days_of(1, 12, 13, 31), _days_of(1, 9, 13, 31))


def _digest(key: str, kind: str, turn: Column, other: Column, range_: Column) -> Column:
    """A keyed number below ``range_`` (up to 10^10, far below the 60 bits drawn)."""
    word = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), range_.cast("string"), other.cast("string"), F.lit(key)), 256)
    return F.pmod(F.conv(F.substring(word, 1, 15), 16, 10).cast("long"), range_)


def feistel(left: Column, right: Column, left_range: Column, right_range: Column, key: str, kind: str, back: bool = False) -> Column:
    """struct<l, r> of the permuted halves; ``back`` undoes it."""
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if back else 1

    def step(state: Column, turn: Column) -> Column:
        moved_l = F.pmod(state["l"] + sign * _digest(key, kind, turn, state["r"], left_range), left_range)
        moved_r = F.pmod(state["r"] + sign * _digest(key, kind, turn, state["l"], right_range), right_range)
        even = turn % 2 == 0
        return F.struct(F.when(even, moved_l).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise(moved_r).alias("r"))

    return F.aggregate(turns, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _power(digits: Column) -> Column:
    return F.rpad(F.lit("1"), digits + 1, "0").cast("long")


def permute_digits(digits: Column, key: str, kind: str, back: bool = False) -> Column:
    """A string of 2 to 36 digits permuted among all strings of its length."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    state = feistel(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1), _power(half), _power(rest), key, kind, back)
    return let(state, lambda s: F.concat(F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), rest, "0")))


def luhn(body: Column) -> Column:
    """The check digit that a body of digits needs."""
    doubled = F.transform(F.filter(F.split(F.reverse(body), ""), lambda c: c != ""), lambda c, i: let(c.cast("int") * (2 - i % 2), lambda d: d - F.when(d > 9, 9).otherwise(0)))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def permute_card(digits: Column, key: str, back: bool = False) -> Column:
    """The body is permuted; the check digit is as right, or as far off, as it was."""
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    off = F.pmod(F.substr(digits, F.length(digits)).cast("int") - luhn(body), F.lit(10))
    return let(permute_digits(body, key, "card", back), lambda b: F.concat(b, F.pmod(luhn(b) + off, F.lit(10)).cast("string")))


def permute_ssn(digits: Column, key: str, back: bool = False) -> Column:
    """Nine digits in the ranges that are given out (areas 001 to 899 but 666, groups from 01, serials from 0001), permuted among all such."""
    area, rest = F.substring(digits, 1, 3).cast("long"), (F.substring(digits, 4, 2).cast("long") - 1) * 9_999 + F.substring(digits, 6, 4).cast("long") - 1
    state = feistel(area - F.when(area > 666, 2).otherwise(1), rest, F.lit(898).cast("long"), F.lit(99 * 9_999).cast("long"), key, "ssn", back)
    padded = lambda number, width: F.lpad(number.cast("string"), width, "0")
    return let(state, lambda s: F.concat(padded(s["l"] + F.when(s["l"] >= 665, 2).otherwise(1), 3), padded(F.floor(s["r"] / 9_999) + 1, 2), padded(s["r"] % 9_999 + 1, 4)))


def valid_cards(text: Column) -> Column:
    """The different card numbers of a text whose check digit is right; candidates may overlap."""
    candidates = F.when(text.rlike(CARD), F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({CARD}))"), F.lit(1)))).otherwise(F.array().cast("array<string>"))
    right = lambda d: luhn(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d)).cast("int")
    return F.filter(candidates, lambda v: let(_digits(v), right))


def in_format(pattern: Column, digits: Column) -> Column:
    """The digits of ``pattern`` replaced, from left to right, by ``digits``."""
    signs = F.filter(F.split(pattern, ""), lambda c: c != "")
    nth = lambda a, i: F.size(F.filter(F.slice(a, F.lit(1), i + 1), lambda c: c.rlike("[0-9]")))
    return let(signs, lambda a: F.array_join(F.transform(a, lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, nth(a, i), F.lit(1))).otherwise(c)), ""))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def permute_ip(value: Column, key: str, back: bool = False) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    ranges = F.lit(65_536).cast("long")
    return let(parts, lambda p: let(feistel(F.get(p, F.lit(0)) * 256 + F.get(p, F.lit(1)), F.get(p, F.lit(2)) * 256 + F.get(p, F.lit(3)), ranges, ranges, key, "ip", back), lambda s: F.concat_ws(
        ".", *[x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)])))


def permute_date(value: Column, key: str, back: bool = False) -> Column:
    """A valid date from 1900 to 2099 becomes another one in its notation; any other text gives null."""
    a, b = _DAY_RANGES
    results = F.lit(None).cast("string")
    for sign, form in (("/", "MM/dd/yyyy"), (r"\.", "dd.MM.yyyy"), ("-", "yyyy-MM-dd")):
        day = F.datediff(F.to_date(F.try_to_timestamp(value, F.lit(form))), F.lit(_FIRST_DAY).cast("date")).cast("long")
        results = F.when(value.rlike(sign), F.date_format(_moved_day(day, a, b, key, back), form)).otherwise(results)
    both_padded = value.rlike(r"^(?:[0-9]{4}-|[0-9]{2}([./])[0-9]{2}\1)")
    return F.coalesce(F.when(both_padded, results), F.when(~value.contains("-"), _permute_parted(value, key, back)))


def _permute_parted(value: Column, key: str, back: bool) -> Column:
    """Dates with parts of one digit, and day-first dates with slashes, each permuted among those that look alike."""
    sign = F.when(value.contains("/"), "/").otherwise(".")

    def of(p: Column) -> Column:
        first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        a, b = first.cast("int"), second.cast("int")
        day_first = (sign == ".") | ((a > 12) & (b <= 12))
        month, day = F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b)
        slashed = (sign == "/") & day_first
        low_month = F.length(F.when(day_first, second).otherwise(first)) == 1
        which = (
            F.when(slashed, F.when(low_month, DAY_SETS.index(_LOW_LATE)).otherwise(DAY_SETS.index(_LATE)))
            .when((month < 10) & (day < 10), DAY_SETS.index(_LOW_LOW)).when(month < 10, DAY_SETS.index(_LOW_HIGH)).when(day < 10, DAY_SETS.index(_HIGH_LOW))
        )
        moved = let(which, lambda w: _moved_in_set(w, F.get(p, F.lit(2)).cast("int"), F.concat(F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), key, back))
        wide = lambda old, new: F.lpad(new.cast("int").cast("string"), F.length(old), "0")

        def written(m: Column) -> Column:
            new_month, new_day = F.substring(m["day"], 1, 2), F.substring(m["day"], 3, 2)
            return F.concat(wide(first, F.when(day_first, new_day).otherwise(new_month)), sign, wide(second, F.when(day_first, new_month).otherwise(new_day)), sign, m["year"].cast("string"))

        return let(moved, lambda m: F.when(m.isNotNull(), written(m)))

    return let(F.split(value, "[./]"), of)


def _moved_in_set(which: Column, year: Column, day: Column, key: str, back: bool) -> Column:
    """struct<year, day> of the permuted day ("MMdd") of one of DAY_SETS, or null where it is not in the set."""
    days, n, total, a, b = (F.get(F.array(*[F.lit(s[i]) for s in DAY_SETS]), which) for i in range(5))
    place = F.call_function("instr", days, F.concat(day, F.lit(",")))
    leap = (year % 4 == 0) & (year != 1900)
    rank = F.when(place > 0, (year - 1900) * n + F.floor((place - 1) / 5)).when((day == "0229") & leap & (total > _YEARS * n), _YEARS * n + F.floor((year - 1904) / 4)).cast("long")

    def once(x: Column) -> Column:
        return let(feistel(F.floor(x / b), x % b, a.cast("long"), b.cast("long"), key, "date", back), lambda s: s["l"] * b + s["r"])

    # The factors' product may be a little more than the set; a step that leads out of it is followed by another one.
    spare = max(s[3] * s[4] - s[2] for s in DAY_SETS)
    inside = lambda x: F.aggregate(F.sequence(F.lit(1), F.lit(spare)), once(x), lambda y, _: F.when(y >= total, once(y)).otherwise(y)) if spare else once(x)
    there = lambda y: F.when(y < _YEARS * n, F.struct((1900 + F.floor(y / n)).alias("year"), F.substr(days, (y % n * 5 + 1).cast("int"), F.lit(4)).alias("day"))).otherwise(
        F.struct((1904 + (y - _YEARS * n) * 4).alias("year"), F.lit("0229").alias("day")))
    return let(rank, lambda r: F.when(r.isNotNull() & year.between(1900, 2099), let(inside(r), there)))


def _moved_day(day: Column, a: int, b: int, key: str, back: bool) -> Column:
    def move(d: Column) -> Column:
        state = feistel(F.floor(d / b), d % b, F.lit(a).cast("long"), F.lit(b).cast("long"), key, "date", back)
        return F.when((d >= 0) & (d < _DAYS), let(state, lambda s: F.date_add(F.lit(_FIRST_DAY).cast("date"), (s["l"] * b + s["r"]).cast("int"))))

    return let(day, move)


def email_name(value: Column, key: str) -> Column:
    """A keyed name of twelve letters; a name has no number format to keep and is not turned back."""
    word = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value), F.lit(key)), 256)
    return F.concat(F.translate(F.substring(word, 1, 12), "0123456789", "ghijklmnop"), F.lit("@example.invalid"))


def kind_of(value: Column) -> Column:
    """The kind of a match, tried in the order of KINDS."""
    out = F.lit("phone")
    whole = {
        "email": value.contains("@"), "date": value.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4})$"), "ip": value.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"),
        "card": value.rlike(r"^[0-9]{4}") & (F.length(_digits(value)) >= 13) & ~value.contains("("), "ssn": value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    }
    for name in reversed(list(whole)):
        out = F.when(whole[name], F.lit(name)).otherwise(out)
    return out


def pseudonym(value: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of one match; ``back`` turns a pseudonym into the value again, but for e-mail names."""
    digits = _digits(value)
    phone = let(digits, lambda d: F.concat(F.substr(d, F.lit(1), F.length(d) - 10), permute_digits(F.substr(d, F.length(d) - 9), key, "phone", back)))
    return (
        F.when(kind == "email", value if back else email_name(value, key)).when(kind == "date", permute_date(value, key, back)).when(kind == "ip", permute_ip(value, key, back))
        .when(kind == "card", in_format(value, permute_card(digits, key, back))).when(kind == "ssn", in_format(value, permute_ssn(digits, key, back)))
        .otherwise(in_format(value, phone))
    )


def pseudonymise(df: DataFrame, text: str = "text", key: str = KEY, back: bool = False) -> DataFrame:
    """All rows and columns, the text with pseudonyms, and ``pii``: array<struct<kind, value>> of what stands there now."""
    rows = df.select(*[df[c] for c in df.columns if c.lower() != "pii"], valid_cards(df[text]).alias("__cards"))
    # The numbers themselves are the pattern: a wrong one must not hide a right one, or another kind, that overlaps it.
    own = F.concat(F.lit(f"{NO_CARD}|(?<![0-9])(?:"), F.array_join("__cards", "|"), F.lit(")(?![0-9])"))
    some = F.size("__cards") > 0
    text_ = F.col(text)
    matches = F.when(some, F.regexp_extract_all(text_, own, F.lit(0))).otherwise(F.regexp_extract_all(text_, F.lit(NO_CARD), F.lit(0)))
    hits = F.when(text_.rlike("[0-9@]"), matches).otherwise(F.array().cast("array<string>"))
    gaps = F.when(some, F.split(text_, own, -1)).otherwise(F.split(text_, NO_CARD, -1))
    found = let(hits, lambda h: F.transform(h, lambda v: let(kind_of(v), lambda k: F.struct(k.alias("kind"), pseudonym(v, k, key, back).alias("value"), v.alias("was")))))
    rows = rows.withColumn("__found", found)
    joined = let(gaps, lambda g_: F.array_join(F.transform(g_, lambda g, i: F.concat(g, let(F.get(F.col("__found"), i), lambda f: F.coalesce(f["value"], f["was"], F.lit(""))))), ""))
    pii = F.transform(F.filter("__found", lambda f: f["value"].isNotNull()), lambda f: F.struct(f["kind"].alias("kind"), f["value"].alias("value")))
    return rows.withColumn("pii", pii).withColumn(text, F.when(F.size("pii") > 0, joined).otherwise(text_)).drop("__cards", "__found")


@query("op6_pseudonyms")
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return done.select("doc_id", "text", *map(count, KINDS), F.array_join(F.transform("pii", lambda p: F.concat_ws(":", p["kind"], p["value"])), ",").alias("pseudonyms"))
