"""Pseudonyms for personal data that keep the format (DataFrame only).

One pattern finds the candidates; each is validated (Luhn, mod-97, octets,
calendar, number plan) and what passes is replaced by a keyed permutation of
its own format, a Feistel network over two digit groups, so equal values get
equal pseudonyms in every document and different values different ones. Cards
keep a right check digit, IBANs right check digits, dates stay dates, phone
numbers keep their country code and punctuation. E-mail addresses and secrets
have no such domain; they get a keyed digest. What does not validate (a
16-digit number that fails the Luhn test) stays as it is.

A text is split at the matches and joined again with the pseudonyms between,
inside one row: no shuffle, no Python.

Edge cases: null text stays null, empty text empty; repeated rows get the same
text; extra columns are kept; an input column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Whoever holds the key can undo the pseudonyms: a run on real data names its own in the
# session setting; without it this open one serves tests.
KEY_SETTING, OPEN_KEY = "spark.corpus.pseudonymKey", "corpus-pseudonyms"
ROUNDS = 10

# The shapes of the values looked for.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})"
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
PHONE = r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
PHONE_LOCAL = r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
DATE_ISO = r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])"
DATE_EUROPEAN = r"(?<![0-9A-Za-z./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9A-Za-z/])"
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
# End of the fixed values. A country of the table ends after its own length, whatever word follows.
_BY_COUNTRY = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[0-9A-Z]{{{n % 4}}}" if n % 4 else "")
                       for n, c in IBAN_LENGTHS.items())
IBAN = rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{_BY_COUNTRY})|[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{2,7}}(?: ?[0-9A-Z]{{1,3}})?)(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
SECRET = (r"(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key)[\"']?"
          r" ?[=:] ?[\"']?(?=[A-Za-z0-9+/_.-]*[0-9])[A-Za-z0-9+/_.-]{16,}+[\"']?)")
ALL = "|".join((SECRET, EMAIL, IP, PHONE, DATE_ISO, SSN, PHONE_LOCAL, DATE_EUROPEAN, IBAN, CARD))
QUICK = r"[0-9@]"
KINDS = ("secret", "email", "ip", "phone", "date", "ssn", "iban", "card")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _draw(key: str, kind: Column, r: Column, half: Column, modulus: Column) -> Column:
    """Round function: a keyed digest of the round and the other half."""
    seen = F.sha2(F.concat_ws("|", F.lit(key), kind, r.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(seen, 1, 15), 16, 10).cast("long"), modulus)


def feistel(key: str, kind: Column, left: Column, right: Column, m: Column, n: Column) -> Column:
    """Keyed permutation of pairs (left < m, right < n): the rounds add a digest
    of one half to the other in turn. Returns a struct (left, right)."""
    def step(s, r):
        even = r % 2 == 0
        return F.struct(F.when(even, F.pmod(s["left"] + _draw(key, kind, r, s["right"], m), m)).otherwise(s["left"]).alias("left"),
                        F.when(even, s["right"]).otherwise(F.pmod(s["right"] + _draw(key, kind, r, s["left"], n), n)).alias("right"))
    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def permute_digits(key: str, kind: Column, number: Column) -> Column:
    """Keyed permutation of the digit strings of one length (2 to 36 digits)."""
    def mixed(x):
        size, half = F.length(x), F.floor(F.length(x) / 2).cast("int")

        def tens(k):
            return F.pow(F.lit(10.0), k).cast("long")
        left, right = F.substring(x, F.lit(1), half), F.substring(x, half + 1, size - half)
        pair = feistel(key, F.concat(kind, size.cast("string")), left, right, tens(half), tens(size - half))
        return _let(pair, lambda p: F.concat(F.lpad(p["left"].cast("string"), half, "0"),
                                             F.lpad(p["right"].cast("string"), size - half, "0")))
    return _let(number, mixed)


def luhn_sum(number: Column) -> Column:
    """Luhn sum, the last digit counted once."""
    each = F.split(F.reverse(number), "")
    return F.aggregate(F.transform(F.filter(each, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.floor(c.cast("int") * 2 / 10).cast("int") + (c.cast("int") * 2) % 10)), F.lit(0), lambda a, x: a + x)


def luhn_valid(number: Column) -> Column:
    return (luhn_sum(number) % 10 == 0) & ~number.rlike("^0+$")


def luhn_digit(body: Column) -> Column:
    return F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")


def mod97(text: Column) -> Column:
    """Remainder by 97 of digits and letters (A is 10) read as one number."""
    def step(a, c):
        code = F.ascii(c)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def refill(shape: Column, number: Column) -> Column:
    """``shape`` with its digits replaced in order by those of ``number``."""
    def step(s, c):
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(number, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, s["n"] + 1).otherwise(s["n"]).alias("n"))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda s: s["out"])


def _card(key: str, v: Column) -> Column:
    def new(x):
        body = permute_digits(key, F.lit("card"), F.substring(x, F.lit(1), F.length(x) - 1))
        return refill(v, _let(body, lambda b: F.concat(b, luhn_digit(b))))
    return F.when(luhn_valid(digits(v)), _let(digits(v), new))


def _phone(key: str, v: Column) -> Column:
    """The digits after the country code are permuted."""
    code = F.regexp_extract(v, r"^\+[0-9]{1,3}(?=[ .(-])|^\+1|^\+[0-9]{2}|", 0)
    rest = F.substring(v, F.length(code) + 1, F.length(v))
    number = digits(rest)
    return F.when(F.length(digits(v)).between(7, 15) & (F.length(number) >= 6),
                  F.concat(code, refill(rest, permute_digits(key, F.concat(F.lit("phone"), code), number))))


def _ip(key: str, v: Column) -> Column:
    o = F.transform(F.split(v, r"\."), lambda x: x.cast("long"))
    big = F.lit(65536).cast("long")
    pair = feistel(key, F.lit("ip"), F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), big, big)
    new = _let(pair, lambda p: F.concat_ws(".", F.shiftright(p["left"], 8).cast("string"), (p["left"] % 256).cast("string"),
                                           F.shiftright(p["right"], 8).cast("string"), (p["right"] % 256).cast("string")))
    return F.when(F.array_max(o) <= 255, new)


def _ssn(key: str, v: Column) -> Column:
    """Valid numbers only: area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.substring(v, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = feistel(key, F.lit("ssn"), index, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"))
    new = _let(pair, lambda p: F.concat_ws(
        "-", F.lpad(F.when(p["left"] >= 665, p["left"] + 2).otherwise(p["left"] + 1).cast("string"), 3, "0"),
        F.lpad((F.floor(p["right"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["right"] % 9999 + 1).cast("string"), 4, "0")))
    return F.when(valid, new)


def _iban(key: str, v: Column) -> Column:
    """Country and letters stay, the account's digits are permuted, the check digits worked out again."""
    plain = F.regexp_replace(v, " ", "")
    head, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = F.length(plain).between(15, 34) & (mod97(F.concat(account, F.substring(plain, 1, 4))) == 1) & (F.length(digits(account)) >= 2)

    def new(old):
        body = refill(old, permute_digits(key, F.concat(F.lit("iban"), head), digits(old)))
        return _let(body, lambda b: refill_all(v, F.concat(head, F.lpad((F.lit(98) - mod97(F.concat(b, head, F.lit("00")))).cast("string"), 2, "0"), b)))
    return F.when(valid, _let(account, new))


def refill_all(shape: Column, plain: Column) -> Column:
    """``shape`` with its characters but spaces replaced in order by those of ``plain``."""
    def step(s, c):
        return F.struct(F.concat(s["out"], F.when(c == " ", c).otherwise(F.substring(plain, s["n"] + 1, F.lit(1)))).alias("out"),
                        F.when(c == " ", s["n"]).otherwise(s["n"] + 1).alias("n"))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda s: s["out"])


# Dates from 1900-01-01 to 2099-12-31 are 17 * 4297 days.
_DAYS = (17, 4297)


def _date(key: str, v: Column) -> Column:
    """Calendar dates of 1900 to 2099 map to each other; the way of writing
    stays. With dots or slashes the day is read first, or the month where only that is a date."""
    iso = v.rlike(r"^[0-9]{4}-")
    mark = F.substring(v, 3, 1)
    day_first = F.when(~iso, F.try_to_timestamp(F.regexp_replace(v, "[./]", "-"), F.lit("dd-MM-yyyy")).cast("date"))
    month_first = F.when(~iso & v.contains("/"), F.try_to_timestamp(F.regexp_replace(v, "[./]", "-"), F.lit("MM-dd-yyyy")).cast("date"))
    date = F.coalesce(F.when(iso, F.try_to_timestamp(v, F.lit("yyyy-MM-dd")).cast("date")), day_first, month_first)
    index = F.datediff(date, F.lit("1900-01-01").cast("date")).cast("long")
    size = _DAYS[0] * _DAYS[1]
    pair = feistel(key, F.lit("date"), F.floor(index / _DAYS[1]), index % _DAYS[1], F.lit(_DAYS[0]).cast("long"), F.lit(_DAYS[1]).cast("long"))

    def new(p):
        d = F.date_add(F.lit("1900-01-01").cast("date"), (p["left"] * _DAYS[1] + p["right"]).cast("int"))
        return (F.when(iso, F.date_format(d, "yyyy-MM-dd"))
                 .when(day_first.isNotNull(), F.concat_ws("", F.date_format(d, "dd"), mark, F.date_format(d, "MM"), F.substring(v, 6, 1), F.date_format(d, "yyyy")))
                 .otherwise(F.concat_ws("", F.date_format(d, "MM"), mark, F.date_format(d, "dd"), F.substring(v, 6, 1), F.date_format(d, "yyyy"))))
    return F.when(index.between(0, size - 1), _let(pair, new))


def _digest(key: str, kind: str, v: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), v), 256)


def _email(key: str, v: Column) -> Column:
    return F.concat(F.lit("user"), F.substring(_digest(key, "email", F.lower(v)), 1, 12), F.lit("@example.invalid"))


def _secret(key: str, v: Column) -> Column:
    """Only the value behind the equals sign changes; its length stays."""
    head = F.regexp_extract(v, r"^[^=:]*[=:] ?[\"']?", 0)
    tail = F.regexp_extract(v, r"[\"']?$", 0)
    size = F.length(v) - F.length(head) - F.length(tail)
    value = F.substring(v, F.length(head) + 1, size)
    return F.concat(head, F.substring(F.repeat(_digest(key, "secret", value), F.ceil(size / 64).cast("int")), F.lit(1), size), tail)


def pseudonym(key: str, v: Column) -> Column:
    """Struct (kind, value) for a match, null where it does not validate."""
    def whole(p):
        return v.rlike(f"^(?:{p})$")
    tests = (("secret", whole(SECRET), _secret), ("email", whole(EMAIL), _email), ("ip", whole(IP), _ip),
             ("date", whole(DATE_ISO) | whole(DATE_EUROPEAN), _date), ("ssn", whole(SSN), _ssn),
             ("phone", whole(PHONE) | whole(PHONE_LOCAL), _phone), ("iban", whole(IBAN), _iban), ("card", whole(CARD), _card))
    kind, value = None, None
    for name, test, make in tests:
        kind = F.when(test, name) if kind is None else kind.when(test, name)
        value = F.when(test, make(key, v)) if value is None else value.when(test, make(key, v))
    return F.struct(kind.alias("kind"), value.alias("value"))


def key_of(spark: SparkSession) -> str:
    """The session's key (``spark.corpus.pseudonymKey``), or the open one where none is set."""
    return spark.conf.get(KEY_SETTING, OPEN_KEY)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, ``n_chars`` (if there)
    counted again, and ``pii``, one struct (kind, old length, value) per replacement in order."""
    text = F.col("text")
    none = F.expr("array()").cast("array<string>")
    d = docs.drop("pii").withColumn("__found", F.when(text.rlike(QUICK), F.regexp_extract_all(text, F.lit(ALL), F.lit(0))).otherwise(none))
    d = d.withColumn("__new", F.transform("__found", lambda v: F.struct(v.alias("old"), pseudonym(key, v).alias("p"))))
    gaps = F.split(text, ALL, -1)
    joined = F.concat(F.array_join(F.transform("__new", lambda x, i: F.concat(F.get(F.col("__gaps"), i), F.coalesce(x["p"]["value"], x["old"]))), ""),
                      F.get(F.col("__gaps"), F.size("__new")))
    hit = F.exists("__new", lambda x: x["p"]["value"].isNotNull())
    d = d.withColumn("__gaps", F.when(hit, gaps)).withColumn("text", F.when(F.col("__gaps").isNotNull(), joined).otherwise(text))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("__gaps").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    done = F.filter("__new", lambda x: x["p"]["value"].isNotNull())
    done = F.transform(done, lambda x: F.struct(x["p"]["kind"].alias("kind"), F.length(x["old"]).alias("old_length"), x["p"]["value"].alias("value")))
    return d.withColumn("pii", F.coalesce(done, F.expr("array()").cast("array<struct<kind:string,old_length:int,value:string>>"))).drop("__found", "__new", "__gaps")
