"""Format-preserving pseudonyms for personal data, by DataFrame functions only.

Candidates are cut out of the text by one pattern, checked (Luhn digit, IBAN check
digits, octets, calendar dates, number plans), and replaced by their image under
a keyed Feistel permutation of the values of the same format. So a card number becomes
another valid card number, a date another date, separators and lengths of digits
stay, equal values get equal pseudonyms in all documents and different ones different
ones. What does not pass its check is left as it is.

Nothing is shuffled: each text is rewritten where it lies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import free_names

ROUNDS = 8

# The shapes of personal data, tried in this order at each place.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
# the first test, of one character, spares most places the second
SECRET = (r"(?<=[=:\s\"'])(?<=(?:(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
          r"|(?i:bearer)\s{1,3}))(?=[^\s\"']*[0-9])[A-Za-z0-9_+/.=!@#$%^*?~-]{8,}(?<!\.)")
KEY = (r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{20,255}"
       r"|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])")
#: Length of the account numbers of each country; others may have any length.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK",
                21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL",
                24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM",
                28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC",
                32: "LC", 33: "RU"}
IBAN = (r"(?<![A-Za-z0-9])(?:"
        + "|".join(rf"(?:{names})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
        + rf"|(?!{'|'.join(IBAN_LENGTHS.values())})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)"
        + r"(?![A-Za-z0-9])")
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
        r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
        r"(?![0-9]|[./-][0-9])")
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])"
ABROAD = r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]\(?[0-9]{1,8}\)?){1,5}(?![0-9])"
# a run of groups of digits, which may hold cards beside other numbers
COMPACT = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9A-Za-z]|[.-][0-9])"
CARD = (r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12}[0-9]*+"
        r"(?:(?: (?![0-9]{3}[ -][0-9]{3}[ -][0-9]{4}(?![0-9]))[0-9]++){0,63}|(?:-[0-9]++){1,63})(?![0-9A-Za-z]|[.-][0-9])")
# the groups of one card: unbroken, of four, or 4-6-4 and 4-6-5
GROUPED = (r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1(?:[0-9]{1,4}|[0-9]{4}\1[0-9]{1,3})"
           r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$")
#: The country code that a number's digits begin with: one digit, the assigned ones of two, else three.
COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
SHAPES = (EMAIL, SECRET, KEY, IBAN, ADDRESS, DATE, SOCIAL, PHONE, ABROAD, COMPACT, CARD)
PATTERN = "|".join(SHAPES)
#: Days that dates are permuted among: 184 * 397 days from 1900-01-01 on; those before (from
#: year 1) and after (to year 9999) among themselves. Values: first day, and the two factors.
FIRST_DAY, WEEKS_OF, DAYS_OF = "1900-01-01", 184, 397
AGES = ((FIRST_DAY, WEEKS_OF, DAYS_OF, "date"), ("0001-01-01", 745, 931, "early"),
        ("2099-12-31", 1558, 1852, "late"))
#: Longest text permuted at once, and the pieces of longer ones.
LONGEST, PIECE = 200, 64
HEXADECIMAL = "^[0-9a-f]+$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash(key: str | Column, *parts: Column) -> Column:
    """60 keyed bits of the parts."""
    text = F.concat_ws("|", key if isinstance(key, Column) else F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _rounds() -> Column:
    return F.array(*[F.lit(i) for i in range(ROUNDS)])


def permute_pair(key: str | Column, left: Column, right: Column, lefts: Column, rights: Column) -> Column:
    """The image (l, r) of (left, right), 0 <= left < lefts and 0 <= right < rights, under
    a Feistel permutation of all such pairs: each round adds a keyed hash of one half
    to the other, modulo its size."""
    pair = lambda l, r: F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))
    return F.aggregate(_rounds(), pair(left, right), lambda x, i: F.when(
        i % 2 == 0, pair(F.pmod(x["l"] + _hash(key, i, x["r"], lefts, rights), lefts), x["r"])).otherwise(
        pair(x["l"], F.pmod(x["r"] + _hash(key, i, x["l"], lefts, rights), rights))))


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), "0").cast("long")


def permute_digits(key: str, digits: Column) -> Column:
    """Another string of as many digits (2 to 36)."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    image = permute_pair(key, F.substring(digits, F.lit(1), half).cast("long"),
                         F.substring(digits, half + 1, n - half).cast("long"), _power(half), _power(n - half))
    return _let(image, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"),
                                          F.lpad(p["r"].cast("string"), n - half, "0")))


def _shift(c: Column, by: Column, hexadecimal: Column) -> Column:
    """The character ``by`` places on among those of its class."""
    code = F.ascii(c)
    turned = lambda first, size: F.chr(F.pmod(code - first + by, F.lit(size)) + first)
    return (F.when(hexadecimal, F.substring(F.lit("0123456789abcdef"), (F.pmod(
        F.instr(F.lit("0123456789abcdef"), c) - 1 + by, F.lit(16)) + 1).cast("int"), F.lit(1)))
        .when((code >= 48) & (code <= 57), turned(48, 10))
        .when((code >= 65) & (code <= 90), turned(65, 26))
        .when((code >= 97) & (code <= 122), turned(97, 26)).otherwise(c))


def permute_text(key: str | Column, text: Column, hexadecimal: Column | None = None) -> Column:
    """Another ASCII text with digits, capitals and small letters in the same places
    (of hexadecimal digits alone: hexadecimal digits); other characters stay."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    hexadecimal = text.rlike(HEXADECIMAL) if hexadecimal is None else hexadecimal

    def turned(part: Column, other: Column, i: Column) -> Column:
        places = F.when(F.length(part) > 0, F.sequence(F.lit(1), F.length(part))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(places, lambda p: _shift(
            F.substring(part, p, F.lit(1)), _hash(key, i, p, other), hexadecimal)), "")

    pair = lambda l, r: F.struct(l.alias("l"), r.alias("r"))
    image = F.aggregate(_rounds(), pair(F.substring(text, F.lit(1), half), F.substring(text, half + 1, n - half)),
                        lambda x, i: F.when(i % 2 == 0, pair(turned(x["l"], x["r"], i), x["r"])).otherwise(
                            pair(x["l"], turned(x["r"], x["l"], i))))
    return _let(image, lambda p: F.concat(p["l"], p["r"]))


def permute_long(key: str, text: Column) -> Column:
    """``permute_text``; of more than LONGEST characters in pieces, the key of each
    linked to all characters before it."""
    pair = lambda link, out: F.struct(link.alias("link"), out.alias("out"))

    def step(x: Column, i: Column) -> Column:
        return _let(F.substring(text, i * PIECE + 1, F.lit(PIECE)), lambda piece: pair(
            F.sha2(F.concat(x["link"], piece), 256),
            F.concat(x["out"], permute_text(F.concat(F.lit(key), x["link"]), piece, text.rlike(HEXADECIMAL)))))

    pieces = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / PIECE).cast("int"))
    linked = F.aggregate(pieces, pair(F.lit(""), F.lit("")), step)["out"]
    return F.when(F.length(text) <= LONGEST, permute_text(key, text)).otherwise(linked)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` in order."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: F.when(
        F.substring(shape, i, F.lit(1)).rlike("[0-9]"),
        F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))), F.lit(1)))
        .otherwise(F.substring(shape, i, F.lit(1)))), "")


def _number(text: Column, at: int, n: int) -> Column:
    return F.substring(text, at, n).cast("long")


def _luhn(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), lambda s, i: s + _let(
        F.substring(payload, F.length(payload) + 1 - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1),
        lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    """The number that digits and capitals (A is 10) spell, modulo 97."""
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), lambda s, i: _let(
        F.ascii(F.substring(text, i, F.lit(1))),
        lambda c: F.when(c >= 65, (s * 100 + c - 55) % 97).otherwise((s * 10 + c - 48) % 97)))


def _payload(m: Column) -> Column:
    d = _digits(m)
    return F.substring(d, F.lit(1), F.length(d) - 1)


def _one_card(m: Column, key: str) -> Column:
    new = _let(permute_digits(key + "card", _payload(m)), lambda p: F.concat(p, _luhn(p)))
    return _filled(m, new)


def _card(m: Column, key: str) -> Column:
    """The run ``m`` with its cards replaced. From left to right the longest stretch of
    groups with a valid check digit counts; it must be grouped as cards are, unless it
    begins the run."""
    groups = F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0))
    pair = lambda done, out: F.struct(done.cast("int").alias("done"), out.alias("out"))

    def run(g: Column) -> Column:
        def stretch(i: Column, n: Column) -> Column:
            return F.regexp_replace(F.array_join(F.slice(g, i, n), ""), "[ -]$", "")

        def is_card(i: Column, n: Column) -> Column:
            return _let(stretch(i, n), lambda c: F.when(
                F.length(_digits(c)).between(13, 19) & ((i == 1) | c.rlike(GROUPED)),
                _luhn(_payload(c)) == F.substring(c, -1, 1)).otherwise(False))

        def step(x: Column, i: Column) -> Column:
            counts = F.sequence(F.least(F.lit(19), F.size(g) - i + 1), F.lit(1), F.lit(-1))
            found = F.try_element_at(F.filter(counts, lambda n: is_card(i, n)), F.lit(1))
            chosen = _let(found, lambda n: F.when(n.isNull(), pair(i, F.concat(x["out"], F.element_at(g, i)))).otherwise(
                _let(stretch(i, n), lambda c: pair(i + n - 1, F.concat(x["out"], _one_card(c, key), F.substring(
                    F.array_join(F.slice(g, i, n), ""), F.length(c) + 1, F.lit(1)))))))
            return F.when(i <= x["done"], x).otherwise(chosen)

        return F.aggregate(F.sequence(F.lit(1), F.size(g)), pair(F.lit(0), F.lit("")), step)["out"]

    return _let(groups, run)


def _iban(m: Column, key: str) -> Column:
    plain = F.regexp_replace(m, " ", "")
    valid = _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1
    own = F.substring(plain, F.lit(5), F.length(plain))

    def spelled(new: Column) -> Column:
        account = _filled(own, new)
        check = F.lpad((98 - _mod97(F.concat(account, F.substring(plain, 1, 2), F.lit("00")))).cast("string"), 2, "0")
        return _filled(m, F.concat(check, new))

    return F.when(valid & (F.length(_digits(own)) >= 2), _let(permute_digits(key + "iban", _digits(own)), spelled)).otherwise(m)


def _address(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    image = permute_pair(key + "address", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3],
                         F.lit(65536), F.lit(65536))
    spelled = _let(image, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
        F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256)]))
    return F.when(F.array_max(octets) <= 255, spelled).otherwise(m)


def _date(m: Column, key: str) -> Column:
    def moved(day: Column, form: Column) -> Column:
        ages = [F.struct(F.lit(first).cast("date").alias("first"), F.lit(lefts).alias("lefts"), F.lit(rights).alias("rights"),
                         F.lit(key + name).alias("key")) for first, lefts, rights, name in AGES]
        index = lambda age: F.datediff(day, age["first"])
        held = F.try_element_at(F.filter(F.array(*ages), lambda age: (index(age) >= 0) & (
            index(age) < age["lefts"] * age["rights"])), F.lit(1))
        return _let(held, lambda age: _let(
            permute_pair(age["key"], F.floor(index(age) / age["rights"]), index(age) % age["rights"], age["lefts"], age["rights"]),
            lambda p: F.call_function("date_format", F.date_add(
                age["first"], (p["l"] * age["rights"] + p["r"]).cast("int")), form)))

    def read(year: int, month: int, day: int, form: str) -> Column:
        parts = F.split(m, "[-/.]")
        value = F.concat_ws("-", *[F.lpad(parts[at], n, "0") for at, n in ((year, 4), (month, 2), (day, 2))])
        short = form.replace("MM", "M").replace("dd", "d")
        return _let(value.try_cast("date"), lambda d: F.when(d.isNotNull(), F.struct(
            d.alias("day"), F.when(one_digit, short).otherwise(form).alias("form"))))

    # a day or month of one digit: none is filled up in the pseudonym
    one_digit = m.rlike("(?<![0-9])[0-9](?![0-9])")
    known = (F.when(m.rlike("^[0-9]{4}-"), read(0, 1, 2, "yyyy-MM-dd"))
             .when(m.rlike("^[0-9]{4}/"), read(0, 1, 2, "yyyy/MM/dd"))
             .when(m.contains("."), read(2, 1, 0, "dd.MM.yyyy"))
             .otherwise(F.coalesce(read(2, 0, 1, "MM/dd/yyyy"), read(2, 1, 0, "dd/MM/yyyy"))))
    return F.coalesce(_let(known, lambda k: moved(k["day"], k["form"])), m)


def _social(m: Column, key: str) -> Column:
    d = _digits(m)
    area, group, serial = _number(d, 1, 3), _number(d, 4, 2), _number(d, 6, 4)
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = area - F.when(area > 666, 2).otherwise(1)
    image = permute_pair(key + "social", place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    spelled = _let(image, lambda p: F.concat(
        F.lpad((p["l"] + F.when(p["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((F.floor(p["r"] / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((p["r"] % 9999 + 1).cast("string"), 4, "0")))
    return F.when(valid, _filled(m, spelled)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    local = F.substring(d, -10, 10)
    area, exchange = _number(local, 1, 3), _number(local, 4, 3)
    image = permute_pair(key + "phone", (area - 200) * 800 + exchange - 200, _number(local, 7, 4),
                         F.lit(640000), F.lit(10000))
    spelled = _let(image, lambda p: F.concat(
        (F.floor(p["l"] / 800) + 200).cast("string"), (p["l"] % 800 + 200).cast("string"),
        F.lpad(p["r"].cast("string"), 4, "0")))
    other = permute_digits(key + "number", local)
    return _filled(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10),
                               F.when((area >= 200) & (exchange >= 200), spelled).otherwise(other)))


def _abroad(m: Column, key: str) -> Column:
    return _let(_digits(m), lambda d: _let(F.regexp_extract(d, COUNTRY, 0), lambda country: _let(
        F.substring(d, F.length(country) + 1, F.length(d)), lambda rest: F.when(
            F.length(rest).between(5, 14), _filled(m, F.concat(country, permute_digits(key + "abroad", rest)))).otherwise(m))))


def _compact(m: Column, key: str) -> Column:
    return F.when(m.rlike(r"^\+1[0-9]{10}$"), _phone(m, key)).otherwise(_abroad(m, key))


def _email(m: Column, key: str) -> Column:
    return F.concat(permute_text(key + "email", F.substring_index(m, "@", 1)), F.lit("@"), F.substring_index(m, "@", -1))


def _key(m: Column, key: str) -> Column:
    mark = F.regexp_extract(m, r"^(AKIA|gh[pousr]_|github_pat_|sk-)", 0)
    return F.concat(mark, permute_long(key + "key", F.substring(m, F.length(mark) + 1, F.length(m))))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of PATTERN; the match itself if its check fails."""
    is_ = lambda shape: m.rlike("^(?:" + shape + ")$")
    no_context = lambda shape: is_(shape.split(")", 1)[1] if shape.startswith("(?<!") else shape)
    return (F.when(m.contains("@") & no_context(EMAIL), _email(m, key))
            .when(no_context(KEY), _key(m, key))
            .when(no_context(IBAN), _iban(m, key))
            .when(no_context(ADDRESS), _address(m, key))
            .when(no_context(DATE), _date(m, key))
            .when(no_context(SOCIAL), _social(m, key))
            .when(no_context(PHONE), _phone(m, key))
            .when(no_context(ABROAD), _abroad(m, key))
            .when(no_context(COMPACT), _compact(m, key))
            .when(no_context(CARD), _card(m, key))
            .otherwise(permute_long(key + "secret", m)))


def pseudonymise(docs: DataFrame, key: str = "starloom", text_col: str = "text",
                 count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; with ``count_col`` also the
    number of replaced values. Null texts stay null (count 0) and texts without a
    match, also empty ones, stay as they are. Rows, repeats and other columns of any name are
    kept; a column named ``count_col`` is replaced; an empty table stays empty."""
    found_, made_ = free_names(docs, 2)
    text = F.col(text_col)
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    gaps = F.split(text, PATTERN, -1)
    held = docs.withColumn(found_, F.coalesce(found, F.array().cast("array<string>")))
    held = held.withColumn(made_, F.transform(found_, lambda m: pseudonym(m, key)))
    joined = F.array_join(F.zip_with(gaps, F.concat(made_, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    if count_col:
        held = held.withColumn(count_col, F.size(F.filter(F.arrays_zip(found_, made_), lambda x: x[found_] != x[made_])))
    return held.withColumn(text_col, F.when(F.size(found_) > 0, joined).otherwise(text)).drop(found_, made_)
