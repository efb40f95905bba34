r"""Format-preserving pseudonyms for personal data by a keyed Feistel network, DataFrame functions only.

A found value is validated (Luhn digit, number ranges, calendar), turned into a number of its
format's domain, permuted there under a key, and written back in the same format. Domains are
products of two sizes, n = a * b, so a value is a pair (u, v); each round adds a keyed digest of one
half to the other, modulo that half's size, and swaps them. That is a permutation of exactly the
domain: two values never get the same pseudonym, a pseudonym is valid again, and equal values
of a kind get equal pseudonyms in all documents, whatever their punctuation.

| kind  | valid if                                              | permuted                                  |
|-------|-------------------------------------------------------|-------------------------------------------|
| card  | 13 to 19 digits, Luhn digit right                     | all digits but the last; Luhn digit anew  |
| ssn   | ddd-dd-dddd, area not 000, 666 or 9xx, no part zero   | the valid numbers                         |
| phone | +c (ddd) ddd-dddd and like punctuation, 10 digits     | the ten digits; country code stays        |
| ipv4  | four numbers up to 255                                | the 2^32 addresses                        |
| date  | a calendar day in 1800 to 2199, y-m-d or d.m.y or d/m/y| the days of these 400 years               |
| email | name@host.tld                                         | the name becomes a keyed digest           |

An e-mail name is no number, so it is replaced by `u` and 16 digits of a keyed digest: linked, but
not a permutation. Anything that fails validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

KINDS = ("card", "ssn", "phone", "ipv4", "date", "email")
ROUNDS = 8

#: One pattern per kind; a value is matched by the first that fits at its place.
_WORD = r"[\p{L}\p{N}_]"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ipv4": rf"(?<!{_WORD})(?<!{_WORD}\.)[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?!\.?{_WORD})",
    "phone": rf"(?<!{_WORD})\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}(?!{_WORD})"
             rf"|(?<!{_WORD})(?<!\+)\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}(?!{_WORD})",
    "ssn": rf"(?<!{_WORD})(?<!{_WORD}-)[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?!-?{_WORD})",
    "date": rf"(?<!{_WORD})(?<!{_WORD}-)[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?!-?{_WORD})"
            rf"|(?<!{_WORD})(?<!{_WORD}[./])(?:[0-9]{{2}}\.[0-9]{{2}}\.|[0-9]{{2}}/[0-9]{{2}}/)[0-9]{{4}}(?![./]?{_WORD})",
    "card": rf"(?<!{_WORD})(?:[0-9]{{4}}([ -])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}|[0-9]{{13,19}})(?!{_WORD})(?!-[0-9])",
}
_ALL = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
_DAYS, _FIRST_DAY = 146_097, "1800-01-01"  # a Gregorian cycle of 400 years, 773 * 189 days
#: Valid areas of ssn below and above 666: 001-665 and 667-899.
_AREAS, _GROUPS, _SERIALS = 898, 99, 9999


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of digits, every second one from the right doubled, the last one single."""
    backwards = F.reverse(F.split(digits, ""))

    def weighed(digit: Column, place: Column) -> Column:
        value = digit.try_cast("int")
        double = value * 2
        return F.coalesce(F.when(place % 2 == 0, value).when(double > 9, double - 9).otherwise(double), F.lit(0))

    return F.aggregate(F.transform(F.filter(backwards, lambda d: d != ""), weighed), F.lit(0), lambda a, b: a + b)


def _kind(value: Column) -> Column:
    """Kind of a matched value that is valid, else null."""
    digits = _digits(value)
    date_iso = F.try_to_date(value, "yyyy-MM-dd")
    date_dots = F.coalesce(F.try_to_date(value, "dd.MM.yyyy"), F.try_to_date(value, "dd/MM/yyyy"))
    day = F.when(value.rlike("^[0-9]{4}-"), date_iso).otherwise(date_dots)
    octets = F.forall(F.split(value, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))
    area = F.substring(value, 1, 3)
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), F.when(octets, F.lit("ipv4")))
        .when(value.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})$"),
              F.when(F.year(day).between(1800, 2199), F.lit("date")))
        .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(
            (area != "000") & (area != "666") & (area < "900") & (F.substring(value, 5, 2) != "00")
            & (F.substring(value, 8, 4) != "0000"), F.lit("ssn")))
        .when(value.rlike(r"^[+(]"), F.lit("phone"))
        .when(F.length(digits).between(13, 19) & (_luhn_sum(digits) % 10 == 0), F.lit("card")))


def _rank(kind: Column, value: Column) -> Column:
    """struct(u, v, a, b): the value's place (u, v) in its domain of a * b."""
    digits = _digits(value)

    def number(text: Column) -> Column:
        return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))

    def pair(u: Column, v: Column, a, b) -> Column:
        whole = [x if isinstance(x, Column) else F.lit(x) for x in (u, v, a, b)]
        return F.struct(*[x.cast("bigint").alias(n) for x, n in zip(whole, "uvab")])

    octet = F.split(value, r"\.")
    day = F.datediff(F.coalesce(F.try_to_date(value, "yyyy-MM-dd"), F.try_to_date(value, "dd.MM.yyyy"),
                                F.try_to_date(value, "dd/MM/yyyy")), F.lit(_FIRST_DAY).cast("date"))
    area = number(F.substring(value, 1, 3))
    payload = F.length(digits) - 1
    left = F.floor(payload / 2).cast("int")
    local = F.substring(digits, -10, 10)
    return (
        F.when(kind == "ipv4", pair(number(F.get(octet, 0)) * 256 + number(F.get(octet, 1)),
                                    number(F.get(octet, 2)) * 256 + number(F.get(octet, 3)), 65_536, 65_536))
        .when(kind == "date", pair(F.floor(day / 189), F.pmod(day, F.lit(189)), 773, 189))
        .when(kind == "ssn", pair(
            F.when(area > 666, area - 2).otherwise(area - 1),
            (number(F.substring(value, 5, 2)) - 1) * _SERIALS + number(F.substring(value, 8, 4)) - 1, _AREAS, _GROUPS * _SERIALS))
        .when(kind == "phone", pair(number(F.substring(local, 1, 5)), number(F.substring(local, 6, 5)), 100_000, 100_000))
        .when(kind == "card", pair(
            number(F.left(digits, left)), number(F.substr(digits, left + 1, payload - left)),
            F.round(F.pow(F.lit(10.0), left)), F.round(F.pow(F.lit(10.0), payload - left)))))


def _permuted(key: str, kind: Column, place: Column) -> Column:
    """The pair after `ROUNDS` keyed rounds; an even number, so that each half is back on its side."""
    def turn(state: Column, number: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), kind, state["a"].cast("string"), state["b"].cast("string"),
                           number.cast("string"), state["v"].cast("string"))
        mixed = F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("bigint")
        return F.struct(state["v"].alias("u"), F.pmod(state["u"] + F.pmod(mixed, state["a"]), state["a"]).alias("v"),
                        state["b"].alias("a"), state["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), place, turn)


def _in_digits_of(value: Column, digits: Column) -> Column:
    """`value` with its digits replaced, in order, by the last of `digits`; every other character stays."""
    characters = F.split(value, "")
    start = F.struct(F.lit("").alias("out"), (F.length(digits) - F.length(_digits(value)) + 1).alias("next"))
    return F.aggregate(characters, start, lambda done, c: F.when(c.rlike("^[0-9]$"), F.struct(
        F.concat(done["out"], F.substr(digits, done["next"], F.lit(1))).alias("out"), (done["next"] + 1).alias("next"),
    )).otherwise(F.struct(F.concat(done["out"], c).alias("out"), done["next"].alias("next"))), lambda done: done["out"])


def _written_back(key: str, kind: Column, value: Column, place: Column) -> Column:
    u, v = place["u"], place["v"]

    def padded(number: Column, width) -> Column:
        return F.lpad(number.cast("string"), width, F.lit("0") if isinstance(width, Column) else "0")

    day = F.date_add(F.lit(_FIRST_DAY).cast("date"), (u * 189 + v).cast("int"))
    date = (F.when(value.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(value.contains("."), F.date_format(day, "dd.MM.yyyy"))
            .otherwise(F.date_format(day, "dd/MM/yyyy")))
    area = F.when(u >= 665, u + 2).otherwise(u + 1)
    ssn = F.concat(padded(area, 3), F.lit("-"), padded(F.floor(v / _SERIALS) + 1, 2), F.lit("-"), padded(v % _SERIALS + 1, 4))
    address = F.concat_ws(".", *[x.cast("string") for x in (F.floor(u / 256), u % 256, F.floor(v / 256), v % 256)])
    digits = _digits(value)
    phone = F.concat(F.left(digits, F.greatest(F.length(digits) - 10, F.lit(0))), padded(u, 5), padded(v, 5))
    payload = F.length(digits) - 1
    left = F.floor(payload / 2).cast("int")
    body = F.concat(padded(u, left), padded(v, payload - left))
    check = F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    mail = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(name), F.lower(domain)), 256), 1, 16),
                    F.lit("@"), domain)
    return (F.when(kind == "email", mail).when(kind == "ipv4", address).when(kind == "date", date).when(kind == "ssn", ssn)
            .when(kind == "phone", _in_digits_of(value, phone))
            .when(kind == "card", _in_digits_of(value, F.concat(body, check.cast("string")))))


def pseudonymise(df: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """`df` with `text_column` pseudonymised and a column pii: array of struct(kind, pseudonym) in order.

    The original values appear nowhere in the result. A null text stays null, with no pii; a text
    without valid values stays as it is. Rows are neither moved nor dropped, so repeated rows
    repeat and an empty table stays empty. A column pii of `df` is replaced, all others stay. A text's values are handled where the row is read:
    nothing is shuffled, and no key's weight matters.
    """
    if not key:
        raise ValueError("a key is needed: without one anybody can turn pseudonyms back")
    text = F.coalesce(F.col(text_column), F.lit(""))
    matches, named, placed, replaced, between = fresh(df, "_matches", "_named", "_placed", "_replaced", "_between")
    kinds = F.transform(matches, lambda value: F.struct(value.alias("value"), _kind(value).alias("kind")))
    nowhere = F.struct(*[F.lit(1).cast("bigint").alias(n) for n in "uvab"])
    places = F.transform(named, lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), F.when(
        x["kind"].isNotNull(), _permuted(key, x["kind"], F.coalesce(_rank(x["kind"], x["value"]), nowhere))).alias("place")))
    pseudonyms = F.transform(placed, lambda x: F.struct(x["kind"].alias("kind"), F.coalesce(
        _written_back(key, x["kind"], x["value"], x["place"]), x["value"]).alias("pseudonym")))
    pieces = F.zip_with(between, replaced, lambda a, b: F.concat(a, F.coalesce(b["pseudonym"], F.lit(""))))
    out = df.withColumn(matches, F.regexp_extract_all(text, F.lit(_ALL), F.lit(0)))
    out = out.withColumn(named, kinds).withColumn(placed, places).withColumn(replaced, pseudonyms)
    out = out.withColumn(between, F.when(F.size(matches) > 0, F.split(text, _ALL, -1)))
    cleaned = F.when(F.size(matches) > 0, F.array_join(pieces, "")).otherwise(F.col(text_column))
    out = out.withColumn(text_column, cleaned).withColumn("pii", F.filter(replaced, lambda x: x["kind"].isNotNull()))
    return out.drop(matches, named, placed, replaced, between)
