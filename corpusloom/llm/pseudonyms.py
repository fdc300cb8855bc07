"""Format-preserving pseudonyms by keyed Feistel permutations, in DataFrame operations only.

A value is cut in two halves, and in each round one half is shifted by a keyed hash of the other. Shifts
can be undone one by one, so every format is permuted: equal values get equal pseudonyms in all
documents and formats, different ones stay different. Only values that pass the checks of their kind are
touched:

* e-mail addresses: letters and digits of the local part stay letters and digits; the domain stays;
* payment cards (13 to 19 digits, Luhn's check): the first digit stays, the check digit is made anew;
* telephone numbers with an area code, or with a plus sign and 7 to 15 digits: the last ten digits;
* IPv4 addresses: the 32 bits;
* social security numbers in three groups: the nine digits;
* dates from 1601 to 2400 as Y-M-D, Y/M/D, D.M.Y, M/D/Y or D/M/Y: the day within its cycle of 400 years.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let

# A repeated group needs a bound: Java's matcher descends once per repetition.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
IPV4 = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
CARD = (
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z])"
)
SOCIAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
DATE = (
    r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
    r"|(?<![0-9./])(?:[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2})"
    r"(?![0-9]|[./][0-9])"
)
# After a plus sign: ten digits and more in one run, or 7 to 15 with separators, up to where another value starts.
PHONE = (
    r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+(?:[0-9]{10,15}(?![0-9])"
    rf"|[0-9](?:(?:[ .()/-]{{1,2}}(?!{IPV4}|{SOCIAL}|{DATE}))?[0-9]){{6,14}}(?![0-9]))"
)
PATTERN = "|".join([EMAIL, IPV4, CARD, SOCIAL, PHONE, DATE])
ROUNDS = 6
CYCLE_DAYS, CYCLE_LOW = 146_097, 5_411  # 400 years, and a factor of it


def _digest(key: str, kind: Column, turn: int, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|"), kind, F.lit(f"|{turn}|"), half.cast("string")), 512)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _shift_text(half: Column, other: Column, key: str, kind: Column, turn: int) -> Column:
    """Each letter or digit of ``half`` moves on within its own class."""
    def moved(digest: Column) -> Callable[[Column, Column], Column]:
        def one(c: Column, i: Column) -> Column:
            step = F.conv(F.substr(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")

            def within(first: str, size: int) -> Column:
                return F.char((F.ascii(c) - ord(first) + step) % size + ord(first))

            return (
                F.when((c >= "0") & (c <= "9"), within("0", 10))
                .when((c >= "a") & (c <= "z"), within("a", 26))
                .when((c >= "A") & (c <= "Z"), within("A", 26))
                .otherwise(c)
            )

        return one

    return let(_digest(key, kind, turn, other), lambda d: F.array_join(F.transform(_chars(half), moved(d)), ""))


def _rounds(left: Column, right: Column, shift: Callable[[Column, Column, int], Column], done: Callable, turn: int = 0) -> Column:
    """``done(left, right)`` after all rounds, every half computed once."""
    if turn == ROUNDS:
        return done(left, right)
    if turn % 2 == 0:
        return let(shift(left, right, turn), lambda new: _rounds(new, right, shift, done, turn + 1))
    return let(shift(right, left, turn), lambda new: _rounds(left, new, shift, done, turn + 1))


def _permuted_text(text: Column, key: str, kind: Column) -> Column:
    half = F.ceil(F.length(text) / 2).cast("int")
    return _rounds(
        F.substr(text, F.lit(1), half), F.substr(text, half + 1, F.length(text)),
        lambda a, b, turn: _shift_text(a, b, key, kind, turn), F.concat,
    )


def _permuted_numbers(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: Column, done: Callable) -> Column:
    def shift(a: Column, b: Column, turn: int) -> Column:
        step = F.conv(F.substring(_digest(key, kind, turn, b), 1, 12), 16, 10).cast("bigint")
        return (a + step) % sizes[turn % 2]

    return _rounds(left.cast("bigint"), right.cast("bigint"), shift, done)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    def one(c: Column, i: Column) -> Column:
        number = F.length(_digits(F.substr(form, F.lit(1), i + 1)))
        return F.when((c >= "0") & (c <= "9"), F.substr(digits, number, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(form), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum; 0 modulo 10 for valid numbers."""
    def one(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * (i % 2 + 1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    values = F.transform(_chars(F.reverse(digits)), one)
    return F.aggregate(values, F.lit(0), lambda total, v: total + v)


def _kind(value: Column, digits: Column) -> Column:
    """What a value is, judged by its form and its check; NULL if it fails its check."""
    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (
        F.when(F.contains(value, F.lit("@")), "email").when(whole(IPV4), "ipv4")
        .when(whole(CARD), F.when(luhn_sum(digits) % 10 == 0, "card"))
        .when(whole(SOCIAL), "social").when(F.startswith(value, F.lit("+")) | whole(PHONE), "phone").otherwise("date")
    )


def _text_kinds(value: Column, digits: Column, kind: Column, key: str) -> Column:
    """E-mail addresses, cards and telephone numbers: one permutation of the part that changes, put back into
    the form."""
    size = F.length(digits)
    inner = (
        F.when(kind == "email", F.substring_index(value, "@", 1)).when(kind == "card", F.substr(digits, F.lit(2), size - 2))
        .when(kind == "phone", F.substr(digits, F.greatest(size - 9, F.lit(1)), F.lit(10))).otherwise(digits)
    )

    def placed(fresh: Column) -> Column:
        def with_check(body: Column) -> Column:
            check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
            return F.concat(body, check.cast("string"))

        numbers = (
            F.when(kind == "card", let(F.concat(F.substring(digits, 1, 1), fresh), with_check))
            .when(kind == "phone", F.concat(F.substr(digits, F.lit(1), F.greatest(size - 10, F.lit(0))), fresh)).otherwise(fresh)
        )
        return F.when(kind == "email", F.concat(fresh, F.lit("@"), F.substring_index(value, "@", -1))).otherwise(
            let(numbers, lambda n: _fill(value, n))
        )

    return let(inner, lambda text: let(_permuted_text(text, key, kind), placed))


def _ipv4(value: Column, key: str) -> Column:
    def changed(parts: Column) -> Column:
        octet = [F.get(parts, F.lit(i)).cast("bigint") for i in range(4)]

        def written(high: Column, low: Column) -> Column:
            numbers = [F.floor(high / 256), high % 256, F.floor(low / 256), low % 256]
            return F.concat_ws(".", *[n.cast("string") for n in numbers])

        return _permuted_numbers(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], (65_536, 65_536), key, F.lit("ipv4"), written)

    return let(F.split(value, r"\."), changed)


def _social(value: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01 and serials from 0001 keep to that."""
    def changed(parts: Column) -> Column:
        area, group, serial = (F.get(parts, F.lit(i)).cast("bigint") for i in range(3))

        def written(high: Column, low: Column) -> Column:
            place = F.floor(high / 99) + 1
            numbers = [(place + F.when(place > 665, 1).otherwise(0), 3), (high % 99 + 1, 2), (low + 1, 4)]
            return F.concat_ws("-", *[F.lpad(n.cast("string"), size, "0") for n, size in numbers])

        place = area - 1 - F.when(area > 666, 1).otherwise(0)
        return _permuted_numbers(place * 99 + group - 1, serial - 1, (898 * 99, 9999), key, F.lit("social"), written)

    return let(F.split(value, "-"), changed)


def _date(value: Column, key: str) -> Column:
    def valid(y: Column, m: Column, d: Column) -> Column:
        last = F.dayofmonth(F.last_day(F.make_date(y, F.greatest(F.lit(1), F.least(F.lit(12), m)), F.lit(1))))
        return y.between(1601, 2400) & m.between(1, 12) & (d >= 1) & (d <= last)

    def by_parts(parts: Column) -> Column:
        written = [F.get(parts, F.lit(i)) for i in range(3)]
        a, b, c = (w.cast("int") for w in written)
        mark = F.substr(value, F.length(written[0]) + 1, F.lit(1))
        order = (
            F.when(F.length(written[0]) == 4, F.when(valid(a, b, c), "ymd"))
            .when((mark == "/") & valid(c, a, b), "mdy").when(valid(c, b, a), "dmy")
        )
        return let(order, lambda o: F.when(o.isNull(), value).otherwise(changed(o, mark, written, a, b, c)))

    def changed(order: Column, mark: Column, written: list[Column], a: Column, b: Column, c: Column) -> Column:
        y = F.when(order == "ymd", a).otherwise(c)
        m = F.when(order == "mdy", a).otherwise(b)
        d = F.when(order == "ymd", c).when(order == "mdy", b).otherwise(a)
        start = F.make_date(F.floor((y - 1) / 400).cast("int") * 400 + 1, F.lit(1), F.lit(1))

        def like(part: Column, number: Column) -> Column:
            """``number`` with a leading zero, unless ``part`` was written in one digit."""
            digits = number.cast("string")
            return F.when(F.length(part) == 1, digits).otherwise(F.lpad(digits, 2, "0"))

        def formed(day: Column) -> Column:
            year, month, number = F.year(day).cast("string"), F.month(day), F.dayofmonth(day)
            return (
                F.when(order == "ymd", F.concat(year, mark, like(written[1], month), mark, like(written[2], number)))
                .when(order == "mdy", F.concat(like(written[0], month), mark, like(written[1], number), mark, year))
                .otherwise(F.concat(like(written[0], number), mark, like(written[1], month), mark, year))
            )

        def placed(day: Column) -> Column:
            sizes = (CYCLE_DAYS // CYCLE_LOW, CYCLE_LOW)
            fresh = lambda high, low: let(F.date_add(start, (high * CYCLE_LOW + low).cast("int")), formed)
            return _permuted_numbers(F.floor(day / CYCLE_LOW), day % CYCLE_LOW, sizes, key, F.lit("date"), fresh)

        return let(F.datediff(F.make_date(y, m, d), start), placed)

    return let(F.split(value, "[-./]"), by_parts)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value found by ``PATTERN``; the value itself if a check fails."""
    def by_kind(digits: Column) -> Column:
        return let(
            _kind(value, digits),
            lambda kind: F.when(kind == "ipv4", _ipv4(value, key)).when(kind == "date", _date(value, key))
            .when(kind == "social", _social(value, key))
            .when(kind.isNotNull(), _text_kinds(value, digits, kind, key)).otherwise(value),
        )

    return let(_digits(value), by_kind)


def replace_private(text: Column, key: str) -> Column:
    """``text`` with pseudonyms, as a struct ``text, n_private``; NULL text gives NULL and 0."""
    gaps = F.split(text, PATTERN, -1)
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def joined(both: Column) -> Column:
        old, new = both["old"], both["new"]
        parts = F.zip_with(gaps, new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))))
        changes = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
        return F.struct(F.array_join(parts, "").alias("text"), changes.cast("bigint").alias("n_private"))

    pairs = let(found, lambda f: F.struct(f.alias("old"), F.transform(f, lambda v: pseudonym(v, key)).alias("new")))
    untouched = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n_private"))
    return F.when(text.rlike("[0-9@]"), let(pairs, joined)).otherwise(untouched)


def pseudonymise(df: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """``df`` with private values in ``text_column`` replaced; rows, order of columns and all else stay.

    Nothing is shuffled. Repeated rows get equal texts; NULL and empty texts stay as they are. Texts of any
    length are searched whole; an empty table gives an empty table.
    """
    return df.withColumn(text_column, replace_private(F.col(text_column), key)["text"])
