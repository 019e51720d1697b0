"""Personal data: format-preserving pseudonyms from keyed Feistel permutations.

E-mail addresses, phone numbers, card numbers, bank accounts, social security
numbers, IP addresses and dates are found, validated and replaced by another
value of the same format.  Each kind is permuted by a keyed bijection, so equal
values get equal pseudonyms in all documents and different values differ.
Everything is a Spark expression; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table

ROUNDS = 8

#: A host has at most 126 labels before the last; the bound also keeps the matcher's stack small on hostile texts.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])"
#: Countries by the length of their accounts; an account ends there whatever follows.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    spaced = f"(?: [A-Z0-9]{{4}}){{{fours}}}" + (f" [A-Z0-9]{{{rest}}}" if rest else "")
    return f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|{spaced})(?![A-Za-z0-9])"


IBAN = (
    rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(_iban(n, c) for n, c in _IBAN_LENGTHS.items())}"
    r"|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9]))"
)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
DATE = (
    r"(?<![A-Za-z0-9-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![A-Za-z0-9-])"
    r"|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}(?![A-Za-z0-9])|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}(?![A-Za-z0-9]))"
)
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
_AMEX = r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![A-Za-z0-9])"
_DASHED = r"[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}(?![A-Za-z0-9])"
ONE_CARD = rf"(?<![A-Za-z0-9])(?:(?:[0-9]{{13,19}}|[0-9]{{4}} [0-9]{{4}} [0-9]{{4}} [0-9]{{4}})(?![A-Za-z0-9])|{_DASHED}|{_AMEX})"
#: One more group of four digits that begins nothing else.
_FOUR = rf"(?! {_AMEX}) [0-9]{{4}}(?![A-Za-z0-9@_%+]|[./-][A-Za-z0-9])"
#: A card, or a run of groups of four that may hold cards anywhere.
CARD = (
    rf"(?<![A-Za-z0-9])(?:(?:[0-9]{{13,19}}|[0-9]{{4}} [0-9]{{4}} [0-9]{{4}} [0-9]{{4}}(?:{_FOUR})*)(?![A-Za-z0-9])"
    rf"|[0-9]{{4}}(?:-[0-9]{{4}}){{3,}}(?![A-Za-z0-9])|{_AMEX})"
)
_LOCAL = r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9])"
#: At most 15 digits, and no group that begins another value.
_ABROAD = (
    rf"\+[0-9]{{1,3}}(?:(?: (?!{DATE}|{SSN}|{IP}|{EMAIL}|{_AMEX}|{_DASHED})|[.-])?[0-9]{{2,4}}){{3,5}}(?![A-Za-z0-9])"
    rf"(?<!{'[ .-]?'.join(['[0-9]'] * 16)})"
)
ONE_PHONE = rf"(?<![A-Za-z0-9+])(?:{_LOCAL}|{_ABROAD})"
#: A phone; one from abroad with the groups of four after it, of which its last groups may be part.
PHONE = rf"(?<![A-Za-z0-9+])(?:{_LOCAL}|{_ABROAD}(?:{_FOUR})*)"
#: In this order where several could start at the same place.
PATTERNS = {"email": EMAIL, "iban": IBAN, "ip": IP, "date": DATE, "ssn": SSN, "card": CARD, "phone": PHONE}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

_FIRST_DAY = "1900-01-01"
_DAYS = (17, 4297)  # 1900-01-01 to 2099-12-31 are 17 * 4297 days


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes."""
    return F.transform(F.array(value), body)[0]


def _number(key: str, kind: str, step: Column, half: Column) -> Column:
    """A keyed 48-bit number of a round and a half."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string")), 256), 1, 12), 16, 10).cast("bigint")


def feistel(key: str, kind: str, a: Column, b: Column, size_a: int, size_b: int) -> Column:
    """A keyed permutation of the pairs (a, b) with a < size_a and b < size_b, as struct<a, b>."""
    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), F.lit(size_a).cast("bigint").alias("sa"), F.lit(size_b).cast("bigint").alias("sb"))

    def one(s, step):
        moved = (s["a"] + _number(key, kind, step, s["b"])) % s["sa"]
        return F.struct(s["b"].alias("a"), moved.alias("b"), s["sb"].alias("sa"), s["sa"].alias("sb"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one)


def _shifted(text: Column, digest: Column) -> Column:
    """Each character moved within its class (digits, capitals, small letters) by a byte of the digest."""

    def move(at):
        c = F.ascii(F.substring(text, at + 1, F.lit(1)))
        by = F.conv(F.substring(digest, (at % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turned = F.when(c < 58, (c - 48 + by) % 10 + 48).when(c < 91, (c - 65 + by) % 26 + 65).otherwise((c - 97 + by) % 26 + 97)
        return F.char(turned)

    places = F.sequence(F.lit(0), F.length(text) - 1)
    return F.when(F.length(text) == 0, F.lit("")).otherwise(F.array_join(F.transform(places, move), ""))


def permute_symbols(key: str, kind: str, symbols: Column) -> Column:
    """A keyed permutation of the letter-and-digit strings with the same class at every place."""

    def whole(s):
        cut = F.floor(F.length(s) / 2).cast("int")
        start = F.struct(F.substring(s, F.lit(1), cut).alias("a"), F.substring(s, cut + 1, F.length(s)).alias("b"))

        def one(acc, step):
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), acc["b"]), 512)
            return F.struct(acc["b"].alias("a"), _let(digest, lambda d: _shifted(acc["a"], d)).alias("b"))

        done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one, lambda x: F.concat(x["a"], x["b"]))
        return done

    return _let(symbols, whole)


def symbols_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def refill(value: Column, symbols: Column) -> Column:
    """``value`` with its letters and digits replaced, in order, by ``symbols``."""

    def whole(s):
        def one(acc, c):
            own = c.rlike("^[A-Za-z0-9]$")
            return F.struct(
                (acc["k"] + own.cast("int")).alias("k"),
                F.concat(acc["out"], F.when(own, F.substring(s, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            )

        return F.aggregate(F.split(value, ""), F.struct(F.lit(0).alias("k"), F.lit("").alias("out")), one, lambda x: x["out"])

    return _let(symbols, whole)


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum from the right; the last digit is doubled for a payload without check digit."""

    def one(acc, at):
        d = F.substring(digits, F.length(digits) - at + 1, F.lit(1)).cast("int")
        twice = (at % 2 == (1 if doubled_first else 0))
        return acc + F.when(twice, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), one)


def mod97(letters: Column) -> Column:
    """Remainder of the number read with A = 10 ... Z = 35."""

    def one(acc, c):
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97).cast("int")

    return F.aggregate(F.filter(F.split(letters, ""), lambda c: c != ""), F.lit(0), one)


def _day(value: Column) -> Column:
    parsed = (
        F.when(value.contains("-"), F.try_to_date(value, "yyyy-MM-dd"))
        .when(value.contains("."), F.try_to_date(value, "dd.MM.yyyy"))
        .otherwise(F.coalesce(F.try_to_date(value, "MM/dd/yyyy"), F.try_to_date(value, "dd/MM/yyyy")))
    )
    return parsed


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def kind_of(value: Column) -> Column:
    """The kind of a found string, null if it is not valid."""
    area, group, serial = F.substring(value, 1, 3), F.substring(value, 5, 2), F.substring(value, 8, 4)
    iban = symbols_of(value)
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike("^[A-Z]"), F.when(F.length(iban).between(15, 34) & (mod97(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))) == 1), F.lit("iban")))
        .when(value.rlike(f"^(?:{IP})$"), F.lit("ip"))
        .when(value.rlike(f"^(?:{DATE})$"), F.when(_day(value).isNotNull(), F.lit("date")))
        .when(value.rlike(f"^(?:{SSN})$"), F.when((area != "000") & (area != "666") & (area < "900") & (group != "00") & (serial != "0000"), F.lit("ssn")))
        .when(value.rlike(f"^(?:{ONE_CARD})$"), F.when(luhn_sum(digits(value), False) % 10 == 0, F.lit("card")))
        .when(F.length(digits(value)).between(8, 15) & value.rlike(f"^(?:{ONE_PHONE})$"), F.lit("phone"))
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found string; what is not valid stays as it is."""
    v = value

    def email(v):
        top = F.regexp_extract(v, r"\.[A-Za-z]+$", 0)
        name = F.substring(v, F.lit(1), F.length(v) - F.length(top))
        return F.concat(refill(name, permute_symbols(key, "email", symbols_of(name))), top)

    def iban(v):
        s = symbols_of(v)
        country = F.substring(s, 1, 2)

        def whole(account):
            check = F.lit(98) - mod97(F.concat(account, country, F.lit("00")))
            return refill(v, F.concat(country, F.lpad(check.cast("string"), 2, "0"), account))

        return _let(permute_symbols(key, "iban", F.substring(s, F.lit(5), F.length(s))), whole)

    def ip(v):
        p = F.transform(F.split(v, r"\."), lambda x: x.cast("bigint"))
        pair = feistel(key, "ip", p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536)
        return _let(pair, lambda s: F.concat_ws(".", *[F.floor(x / 256).cast("string") if high else (x % 256).cast("string") for x in (s["a"], s["b"]) for high in (True, False)]))

    def date(v):
        n = F.datediff(_day(v), F.to_date(F.lit(_FIRST_DAY)))
        pair = feistel(key, "date", F.floor(n / _DAYS[1]), n % _DAYS[1], *_DAYS)
        day = _let(pair, lambda s: F.date_add(F.to_date(F.lit(_FIRST_DAY)), (s["a"] * _DAYS[1] + s["b"]).cast("int")))
        european = F.try_to_date(v, "MM/dd/yyyy").isNull()
        return F.when(v.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(v.contains("."), F.date_format(day, "dd.MM.yyyy")).when(european, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))

    def ssn(v):
        area, group, serial = F.substring(v, 1, 3).cast("int"), F.substring(v, 5, 2).cast("int"), F.substring(v, 8, 4).cast("int")
        place = area - 1 - (area > 666).cast("int")  # 001 to 899 without 666
        pair = feistel(key, "ssn", place * 99 + group - 1, serial - 1, 898 * 99, 9999)

        def text(s):
            first = F.floor(s["a"] / 99) + 1
            return F.concat_ws(
                "-", F.lpad((first + (first > 665).cast("int")).cast("string"), 3, "0"),
                F.lpad((s["a"] % 99 + 1).cast("string"), 2, "0"), F.lpad((s["b"] + 1).cast("string"), 4, "0"),
            )

        return _let(pair, text)

    def card(v):
        s = symbols_of(v)

        def whole(payload):
            check = (F.lit(10) - luhn_sum(payload, True) % 10) % 10
            return refill(v, F.concat(payload, check.cast("string")))

        inner = F.substring(s, F.lit(2), F.length(s) - 2)  # the first digit names the network and stays
        return _let(F.concat(F.substring(s, 1, 1), permute_symbols(key, "card", inner)), whole)

    def phone(v):
        country = F.regexp_extract(v, r"^(?:\+[0-9]{1,3}(?=[ .(-])|\+|[0-9]{1,3}(?=[ .-]?\())", 0)
        rest = F.substring(v, F.length(country) + 1, F.length(v))
        return F.concat(country, refill(rest, permute_symbols(key, "phone", symbols_of(rest))))

    return _let(
        kind_of(v),
        lambda k: F.when(k.isNull(), v).when(k == "email", email(v)).when(k == "iban", iban(v)).when(k == "ip", ip(v)).when(k == "date", date(v))
        .when(k == "ssn", ssn(v)).when(k == "card", card(v)).otherwise(phone(v)),
    )


def found(text: Column) -> Column:
    """All strings of the whole text that look like personal data, in order.

    Only texts with a digit or an at sign are searched for the patterns.
    """
    return F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _cards_in(groups: Column) -> Column:
    """The parts of groups of four digits (each with the character before it): the cards, and what is between."""
    def one(acc, group):
        def step(held):
            text = F.array_join(held, "")
            at = F.length(F.regexp_extract(text, "^[^0-9]?", 0))
            card = (F.size(held) == 4) & (luhn_sum(digits(text), False) % 10 == 0)
            full = F.size(held) == 4
            return F.struct(
                F.when(card, F.concat(acc["parts"], F.array(F.concat(acc["gap"], F.substring(text, F.lit(1), at)), F.substring(text, at + 1, F.length(text)))))
                .otherwise(acc["parts"]).alias("parts"),
                F.when(card, "").when(full, F.concat(acc["gap"], held[0])).otherwise(acc["gap"]).alias("gap"),
                F.when(card, F.slice(held, 1, 0)).when(full, F.slice(held, 2, 3)).otherwise(held).alias("held"),
            )

        return _let(F.concat(acc["held"], F.array(group)), step)

    none = F.array().cast("array<string>")
    start = F.struct(none.alias("parts"), F.lit("").alias("gap"), none.alias("held"))
    return F.aggregate(groups, start, one, lambda x: F.concat(x["parts"], F.array(F.concat(x["gap"], F.array_join(x["held"], "")))))


def _phone_and_cards(value: Column) -> Column:
    """The parts of a phone from abroad with groups of four after it.

    The phone is the longest that a payment card (2 to 6 first) follows, or else the longest.
    """
    def whole(groups):
        def before(n):
            return F.array_join(F.slice(groups, 1, n), "")

        def card_follows(n):
            four = F.slice(groups, n + 1, 4)
            return (
                before(n).rlike(f"^(?:{ONE_PHONE})$") & F.array_join(four, "").rlike("^ [2-6][0-9]{3}(?: [0-9]{4}){3}$")
                & (luhn_sum(digits(F.array_join(four, "")), False) % 10 == 0)
            )

        longest = F.regexp_extract(value, f"^(?:{ONE_PHONE})", 0)
        sizes = F.filter(F.sequence(F.least(F.size(groups), F.lit(7)), F.lit(1)), card_follows)
        phone = F.when(F.size(sizes) > 0, before(F.get(sizes, F.lit(0)))).otherwise(longest)
        return _let(phone, lambda p: F.concat(F.array(p), _cards_in(F.regexp_extract_all(F.substring(value, F.length(p) + 1, F.length(value)), F.lit("[ .-]?[0-9]+"), F.lit(0)))))

    return _let(F.regexp_extract_all(value, F.lit("[+]?[ .-]?[0-9]+"), F.lit(0)), whole)


def parts(value: Column) -> Column:
    """The values a found string is read as, with what is between them, in order."""
    return (
        F.when(value.rlike("^[+].* [0-9]{4}$") & ~value.contains("("), _phone_and_cards(value))
        .when(value.rlike("^[0-9]{4}(?:[ -][0-9]{4}){4,}$"), _cards_in(F.regexp_extract_all(value, F.lit("[ -]?[0-9]{4}"), F.lit(0))))
        .otherwise(F.array(value))
    )


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Replace the personal data in ``column`` of every row; all other columns stay.

    Null stays null, empty stays empty, texts without personal data stay as they
    are, repeated rows stay equal.  The same value gets the same pseudonym in
    every document under one ``key``; keep the key secret.
    """
    text = F.col(f"`{column}`").cast("string")
    replaced = _let(
        found(text),
        lambda hits: F.when(F.size(hits) == 0, text).otherwise(
            F.array_join(
                F.zip_with(F.split(text, ANY, -1), F.transform(hits, lambda v: F.array_join(F.transform(parts(v), lambda p: pseudonym(p, key)), "")), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "",
            )
        ),
    )
    return docs.withColumn(column, F.when(text.isNotNull(), replaced))


def kinds(text: Column) -> Column:
    """How many valid values of each kind the text holds, as struct of longs."""
    def whole(ks):
        return F.struct(*[(F.size(ks) - F.size(F.array_remove(ks, n))).cast("bigint").alias(f"n_{n}") for n in PATTERNS])

    hits = F.coalesce(found(text), F.array().cast("array<string>"))
    return _let(F.transform(F.flatten(F.transform(hits, parts)), kind_of), whole)


#: The query's key; a real run passes its own secret.
QUERY_KEY = "query key"


@query("op3_pii")
def op3_pii(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = docs.withColumn("found", kinds(F.col("text")))
    return pseudonymise(counted, QUERY_KEY).select("doc_id", "text", "found.*")
