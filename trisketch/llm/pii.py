"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Values are found by one pattern, validated, and sent through a keyed Feistel permutation of
their own format: a card number stays a number that passes the Luhn check, a date a date, an
address an address. Equal values have equal pseudonyms in all documents, with no shared table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Formats. Fixed values.
SECRET = r"(?i:password|passwd|pwd|secret|token|api_?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_\-]{8,200}"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){1,8}"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])"
DAY_DATE = r"(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
CARD = r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])"
PERSONAL = "|".join([SECRET, ACCESS_KEY, EMAIL, IPV4, ISO_DATE, DAY_DATE.replace(r"\1", "[./]"), PHONE, SSN, CARD])

# Dates of the 400 years from 1800 on are the pairs of 189 x 773 = 146,097 days.
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1800-01-01", 189, 773


def _digest(key: str, name: Column, number: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), name, number.cast("string"), other), 256)


def _hex(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def _each(text: Column, change) -> Column:
    """`change(position, character)` for each character, joined again."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.array_join(F.transform(places, lambda i: change(i, F.substr(text, i, F.lit(1)))), "")


def _moved(char: Column, by: Column) -> Column:
    """The character `by` places on within its own class: digits, or small or capital letters."""
    small, capital = char.between("a", "z"), char.between("A", "Z")
    first = F.when(small, ord("a")).when(capital, ord("A")).otherwise(ord("0"))
    size = F.when(small | capital, 26).otherwise(10)
    return F.char(first + (F.ascii(char) - first + by) % size)


def permuted_text(value: Column, key: str, name: Column) -> Column:
    """Feistel permutation of the strings of letters and digits with the same class at each place.

    Each round adds a keyed digest of one half to the other half, place by place within the
    class of the character. The classes are all that the format knows, and they stay, so no two
    strings have one image.
    """
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1).alias("b"))

    def turn(acc: Column, number: Column) -> Column:
        both = F.struct(acc["a"].alias("a"), _digest(key, name, number, acc["b"]).alias("digest"))
        moved = F.aggregate(
            F.array(both),
            F.lit(""),
            lambda _, x: _each(
                x["a"],
                lambda i, c: F.when(c != "", _moved(c, _hex(F.substr(x["digest"], (i - 1) % 32 * 2 + 1, F.lit(2))))),
            ),
        )
        return F.struct(acc["b"].alias("a"), moved.alias("b"))

    return F.aggregate(_rounds(), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))


def _rounds() -> Column:
    return F.array(*[F.lit(r) for r in range(ROUNDS)])


def permuted_pair(a: Column, b: Column, high: Column, low: Column, key: str, name: Column) -> Column:
    """Feistel permutation of the pairs in [0, high) x [0, low), as the number a * low + b."""

    def turn(acc: Column, number: Column) -> Column:
        digest = _digest(key, name, number, acc["b"].cast("string"))
        new = (acc["a"] + _hex(F.substr(digest, F.lit(1), F.lit(12)))) % acc["of_a"]
        return F.struct(
            acc["b"].alias("a"), new.alias("b"), acc["of_b"].alias("of_a"), acc["of_a"].alias("of_b")
        )

    start = F.struct(
        a.cast("long").alias("a"), b.cast("long").alias("b"), high.cast("long").alias("of_a"), low.cast("long").alias("of_b")
    )
    return F.aggregate(_rounds(), start, turn, lambda acc: acc["a"] * acc["of_b"] + acc["b"])


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _refilled(value: Column, new: Column) -> Column:
    """`value` with its letters and digits replaced, in order, by the characters of `new`."""
    return _each(
        value,
        lambda i, c: F.when(
            c.rlike("[0-9A-Za-z]"), F.substr(new, F.length(_plain(F.substr(value, F.lit(1), i))), F.lit(1))
        ).otherwise(c),
    )


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _with_check_digit(body: Column) -> Column:
    every = F.array(*[F.lit(str(d)) for d in range(10)])
    return F.filter(F.transform(every, lambda d: F.concat(body, d)), _luhn)[0]


def parts_of(value: Column) -> Column:
    """A found value as struct(name, head, body, tail): head and tail stay, the body is permuted.

    The name is null for a value that fails validation.
    """

    def parts(name: str, body: Column, head: Column | None = None, tail: Column | None = None) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.lit("").alias("head") if head is None else head.alias("head"),
            body.alias("body"),
            F.lit("").alias("tail") if tail is None else tail.alias("tail"),
        )

    def after(name: str, pattern: str) -> Column:
        head = F.regexp_extract(value, pattern, 0)
        return parts(name, F.substr(value, F.length(head) + 1), head)

    local = F.substring_index(value, "@", 1)
    digits = F.regexp_replace(value, "[^0-9]", "")
    octets = F.split(value, "[.]")
    return (
        F.when(value.rlike(f"^(?:{SECRET})$"), after("secret", r"^[A-Za-z_]+[\"']?\s*[=:]\s*[\"']?"))
        .when(value.rlike(f"^(?:{ACCESS_KEY})$"), after("access", "^A[KS]IA"))
        .when(value.contains("@"), parts("email", local, None, F.substr(value, F.length(local) + 1)))
        .when(
            value.rlike(f"^(?:{IPV4})$"),
            F.when(F.forall(octets, lambda o: o.cast("int") < 256), parts("ipv4", value)),
        )
        .when(value.rlike(f"^(?:{ISO_DATE}|{DAY_DATE})$"), F.when(_is_day(value), parts("date", value)))
        .when(value.rlike(f"^(?:{SSN})$"), parts("ssn", value))
        .when(value.rlike(f"^(?:{PHONE})$"), after("phone", r"^(?:\+[0-9]{1,3}(?:[ .\-]|(?=\()))?"))
        .when(_luhn(digits), parts("card", value))
    )


def _fields(value: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of either layout of a date."""
    iso = F.substr(value, F.lit(5), F.lit(1)) == "-"

    def number(at: int, other: int, size: int) -> Column:
        return F.substr(value, F.when(iso, at).otherwise(other), F.lit(size)).cast("int")

    return number(1, 7, 4), number(6, 4, 2), number(9, 1, 2)


def _is_day(value: Column) -> Column:
    """A day of the years 1800 to 2199."""
    year, month, day = _fields(value)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    length = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return year.between(1800, 2199) & month.between(1, 12) & (day >= 1) & (day <= length)


def _moved_number(part: Column, key: str) -> Column:
    """The pseudonym of an address or a date, both pairs of small numbers."""
    body = part["body"]
    ip = part["name"] == "ipv4"
    octets = F.split(body, "[.]")
    days = F.date_diff(F.make_date(*_fields(body)), F.lit(FIRST_DAY).cast("date"))
    number = permuted_pair(
        F.when(ip, octets[0].cast("int") * 256 + octets[1].cast("int")).otherwise(F.floor(days / DAYS_LOW)),
        F.when(ip, octets[2].cast("int") * 256 + octets[3].cast("int")).otherwise(days % DAYS_LOW),
        F.when(ip, 65_536).otherwise(DAYS_HIGH),
        F.when(ip, 65_536).otherwise(DAYS_LOW),
        key,
        part["name"],
    )

    def shaped(n: Column) -> Column:
        address = F.concat_ws(".", *[(F.floor(n / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)])
        moved = F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int")).cast("string")
        mark = F.substr(body, F.lit(3), F.lit(1))
        y, m, d = (F.substr(moved, F.lit(at), F.lit(size)) for at, size in ((1, 4), (6, 2), (9, 2)))
        date = F.when(F.substr(body, F.lit(5), F.lit(1)) == "-", moved).otherwise(F.concat(d, mark, m, mark, y))
        return F.when(ip, address).otherwise(date)

    return F.aggregate(F.array(number), F.lit(""), lambda _, n: shaped(n))


def _moved_text(part: Column, key: str) -> Column:
    plain = _plain(part["body"])
    card = part["name"] == "card"
    size = F.when(card, F.length(plain) - 1).otherwise(F.length(plain))
    moved = permuted_text(F.substr(plain, F.lit(1), size), key, part["name"])
    return F.aggregate(
        F.array(moved),
        F.lit(""),
        lambda _, x: F.concat(
            part["head"], _refilled(part["body"], F.when(card, _with_check_digit(x)).otherwise(x)), part["tail"]
        ),
    )


def pseudonym(value: Column, part: Column, key: str) -> Column:
    """The pseudonym of one found value; a value that fails validation is returned unchanged."""
    return (
        F.when(part["name"].isNull(), value)
        .when(part["name"].isin("ipv4", "date"), _moved_number(part, key))
        .otherwise(_moved_text(part, key))
    )


def pseudonymize(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with every validated personal value in `text` replaced by its pseudonym.

    Adds n_personal, the number of values replaced (values that fail validation, such as a
    number without a valid check digit or a 31 February, stay and do not count). A null text
    stays null with n_personal 0, an empty one empty; rows keep their number and order of
    columns, repeated rows get equal results, and no column but `text` and n_personal changes.
    One map over the rows: no shuffle.
    """
    found = documents.withColumn("__found", F.regexp_extract_all(text, F.lit(PERSONAL), F.lit(0)))
    named = F.transform("__found", lambda v: F.struct(v.alias("value"), parts_of(v).alias("part")))
    moved = F.transform(named, lambda x: pseudonym(x["value"], x["part"], key))
    filled = found.withColumn("__new", F.when(F.size("__found") > 0, moved))
    between = F.split(text, PERSONAL, -1)
    joined = F.array_join(
        F.zip_with(between, "__new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    changed = F.size(F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x))
    return filled.withColumns(
        {
            text: F.when(F.col("__new").isNull(), F.col(text)).otherwise(joined),
            "n_personal": F.when(F.col("__new").isNull(), F.lit(0)).otherwise(changed),
        }
    ).drop("__found", "__new")
