"""Personal data replaced by keyed pseudonyms of the same format.

Found by pattern, then validated: payment cards and bank accounts (IBAN) by check digits, IPv4 and
IPv6 addresses, calendar dates (also at the head of a timestamp), social security numbers, phone
numbers; also e-mail addresses and long hexadecimal secrets. A number or date is permuted within
its own format by a Feistel network over two halves of mixed radix, keyed by SHA-256, so different
values stay different, equal values stay linked in all documents, and the result is valid again
(cards and accounts keep right check digits, dates stay dates). An IPv6 address, e-mail address or
secret, whose domain is too wide for that, gets a keyed digest in its place. What fails validation
stays as it is.

A date with slashes is read as day/month/year, and as month/day/year where only that is a date. The
permutation is walked on until it meets a date that reads the same way and has fields of the same
width, so each way of writing is permuted within itself and no two texts get one pseudonym; padded
day/month dates and ISO dates of one day stay linked.

All of it is one projection of built-in functions: no shuffle, and texts without a digit or ``@``
are passed on as they are.

Defined results: null stays null; empty and repeated texts are texts like others; an empty table
gives an empty result; other columns are carried whatever their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Dates from the first day on, as many as the two radices make: 1900-01-01 to 2100-02-20.
FIRST_DAY, DATE_RADIX = "1900-01-01", (100, 731)
#: Area numbers 001 to 899 without 666, times groups 01 to 99; serials 0001 to 9999.
SSN_RADIX = (898 * 99, 9999)

EMAIL = r"[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,126}"
SECRET = r"[0-9a-fA-F]{32,}+(?![\p{L}\p{N}_])"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
IPV6 = (r"(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"
        r"|(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?)"
        r"(?![\p{L}\p{N}:])")
ISO_DATE = r"\d{4}-\d{2}-\d{2}(?!(?!T\d{2}:\d{2})[\p{L}\p{N}])"
SLASH_DATE = r"\d{1,2}/\d{1,2}/\d{4}(?![\p{L}\p{N}/])"
IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
SSN = r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
PHONE = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\p{L}\p{N}])"
#: A number as machines write it: + and up to 15 digits.
DIAL = r"\+[1-9]\d{7,14}(?![\p{L}\p{N}])"
CARD = (r"(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})"
        r"(?![\p{L}\p{N}])")
ANY = (rf"(?<![\p{{L}}\p{{N}}._%+@-]){EMAIL}|(?<![\p{{L}}\p{{N}}_.+-])"
       rf"(?:{SECRET}|{IBAN}|{ISO_DATE}|{SLASH_DATE}|{IPV4}|{SSN}|{PHONE}|{DIAL}|{CARD})"
       rf"|(?<![\p{{L}}\p{{N}}_.:+-]){IPV6}")

KINDS = ("email", "secret", "date", "ip", "ssn", "phone", "card", "iban")
#: Steps of a walk; each meets a fitting date with a chance of a fifth at least.
_WALK = 256


def _digest(key: str, *parts) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: str,
            back: bool = False) -> Column:
    """Struct (x, y) of a keyed permutation of the pairs 0 <= x < a, 0 <= y < b. Each round adds a
    keyed digest of one half to the other and swaps them; ``back`` undoes it."""
    def mix(half: Column, i: Column) -> Column:
        return F.conv(F.substring(_digest(key, F.lit(tweak), i, half), 1, 15), 16, 10).cast("long")

    def forth(s: Column, i: Column) -> Column:
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + mix(s["y"], i), s["a"]).alias("y"),
                        s["b"].alias("a"), s["a"].alias("b"))

    def undo(s: Column, i: Column) -> Column:
        return F.struct(F.pmod(s["y"] - mix(s["x"], i), s["b"]).alias("x"), s["x"].alias("y"),
                        s["b"].alias("a"), s["a"].alias("b"))

    start = F.struct(*(c.cast("long").alias(n) for c, n in ((x, "x"), (y, "y"), (a, "a"), (b, "b"))))
    order = list(range(ROUNDS))
    return F.aggregate(F.array(*map(F.lit, order[::-1] if back else order)), start,
                       undo if back else forth)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _padded(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _fill(mask: Column, digits: Column) -> Column:
    """The mask with its digits replaced, in order, by the given ones."""
    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c))
            .alias("out"),
            (s["at"] + F.when(digit, 1).otherwise(0)).alias("at"))

    chars = F.filter(F.split(mask, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step,
                       lambda s: s["out"])


def permuted_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 18."""
    n = F.char_length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    power = [F.pow(F.lit(10.0), k).cast("long") for k in (left, right)]
    halves = (F.substr(digits, F.lit(1), left).cast("long"),
              F.substr(digits, left + 1, right).cast("long"))
    return _let(feistel(*halves, *power, key, tweak, back), lambda s: F.concat(
        _padded(s["x"], left), _padded(s["y"], right)))


def _luhn_sum(digits: Column) -> Column:
    """Sum whose last digit is zero for a number with a right check digit."""
    return F.aggregate(
        F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: _let(
            c.cast("int") * (1 + i % 2), lambda d: d - F.when(d > 9, 9).otherwise(0))),
        F.lit(0), lambda s, d: s + d)


def _card(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        body = permuted_digits(F.substr(digits, F.lit(1), F.char_length(digits) - 1), key, "card")
        whole = _let(body, lambda b: F.concat(
            b, F.pmod(-_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(F.pmod(_luhn_sum(digits), F.lit(10)) == 0, _fill(value, whole))
    return _let(_digits(value), of)


def _ip(value: Column, key: str) -> Column:
    def of(o: Column) -> Column:
        half = [o[0] * 256 + o[1], o[2] * 256 + o[3]]
        side = F.lit(1 << 16)
        made = _let(feistel(*half, side, side, key, "ip"), lambda s: F.concat_ws(
            ".", *(e.cast("string") for h in (s["x"], s["y"])
                   for e in (F.shiftright(h, 8), h.bitwiseAND(F.lit(255))))))
        return F.when(F.array_max(o) < 256, made)
    return _let(F.transform(F.split(value, r"\."), lambda p: p.cast("int")), of)


def _rank(text: Column, form: str) -> Column:
    """Days since the first day; null if the text is no date, or none in the range."""
    a, b = DATE_RADIX
    day = F.datediff(F.try_to_timestamp(text, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
    return _let(day, lambda d: F.when((d >= 0) & (d < a * b), d.cast("long")))


def _moved(rank: Column, key: str) -> Column:
    a, b = DATE_RADIX
    return _let(feistel(F.floor(rank / b), rank % b, F.lit(a), F.lit(b), key, "date"),
                lambda s: s["x"] * b + s["y"])


def _day(rank: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), rank.cast("int"))


def _date(value: Column, key: str) -> Column:
    return _let(_rank(value, "yyyy-MM-dd"), lambda rank: F.when(
        rank.isNotNull(), F.date_format(_day(_moved(rank, key)), "yyyy-MM-dd")))


def _slash_date(value: Column, key: str) -> Column:
    def walked(rank: Column, fits) -> Column:
        def step(s: Column, _: Column) -> Column:
            return F.when(s["done"], s).otherwise(_let(_moved(s["rank"], key), lambda r: F.struct(
                r.alias("rank"), fits(_day(r)).alias("done"))))

        start = F.struct(rank.alias("rank"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), start, step,
                           lambda s: F.when(s["done"], _day(s["rank"])))

    def of(field: Column) -> Column:
        narrow = [F.char_length(field[k]) == 1 for k in (0, 1)]

        def written(number: Column, k: int) -> Column:
            return F.when(narrow[k], number.cast("string")).otherwise(_padded(number, 2))

        def made(day_at: int) -> Column:
            month_at = 1 - day_at
            text = F.concat_ws("-", field[2], _padded(field[month_at], 2), _padded(field[day_at], 2))

            def fits(d: Column) -> Column:
                fine = (~narrow[day_at] | (F.dayofmonth(d) < 10)) & (~narrow[month_at] | (F.month(d) < 10))
                return fine if day_at == 0 else fine & (F.dayofmonth(d) > 12)

            def told(d: Column) -> Column:
                parts = {day_at: F.dayofmonth(d), month_at: F.month(d)}
                return F.when(d.isNotNull(), F.concat_ws(
                    "/", written(parts[0], 0), written(parts[1], 1), _padded(F.year(d), 4)))

            return _let(_rank(text, "yyyy-MM-dd"), lambda rank: F.when(
                rank.isNotNull(), _let(walked(rank, fits), told)))

        return F.coalesce(made(0), made(1))
    return _let(F.split(value, "/"), of)


def _ssn(value: Column, key: str) -> Column:
    a, b = SSN_RADIX

    def of(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        rank = area - F.when(area > 666, 2).otherwise(1)
        made = _let(
            feistel(rank * 99 + group - 1, serial - 1, F.lit(a), F.lit(b), key, "ssn"),
            lambda s: _let(F.floor(s["x"] / 99), lambda r: F.concat_ws(
                "-", _padded(r + F.when(r >= 665, 2).otherwise(1), 3),
                _padded(s["x"] % 99 + 1, 2), _padded(s["y"] + 1, 4))))
        return F.when(valid, made)
    return _let(F.transform(F.split(value, "-"), lambda x: x.cast("int")), of)


def _phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^(\+\d{1,3}[ .-]?(?=[(\d]))?", 0)
    rest = F.substr(value, F.char_length(code) + 1)
    return F.concat(code, _fill(rest, permuted_digits(_digits(rest), key, "phone")))


def _dial(value: Column, key: str) -> Column:
    """The country code stays: 1 before ten digits, else two digits."""
    code = F.regexp_extract(value, r"^\+(?:1(?=\d{10}$)|\d{2})", 0)
    return F.concat(code, permuted_digits(F.substr(value, F.char_length(code) + 1), key, "phone"))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text's digits, letters counting as 10 to 35."""
    def step(r: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (r * 10 + c.try_cast("int")) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    """Country and letters stay; the account's digits are permuted, eighteen at a time, and the
    check digits follow."""
    def block(digits: Column, first: int, tweak: str) -> Column:
        part = F.substring(digits, first, 18)
        return F.when(F.char_length(part) < 2, part).otherwise(permuted_digits(part, key, tweak))

    def of(plain: Column) -> Column:
        body = F.substr(plain, F.lit(5))

        def checked(account: Column) -> Column:
            head = F.concat(account, F.substring(plain, 1, 2), F.lit("00"))
            return F.concat(F.substring(plain, 1, 2), _padded(98 - _mod97(head), 2), account)

        made = _let(_digits(body), lambda d: _fill(body, F.concat(
            block(d, 1, "iban"), block(d, 19, "iban2"))))
        spread = _let(_let(made, checked), lambda m: _spaced(value, m))
        return F.when(_mod97(F.concat(body, F.substring(plain, 1, 4))) == 1, spread)
    return _let(F.regexp_replace(value, " ", ""), of)


def _spaced(mask: Column, text: Column) -> Column:
    """The text with blanks where the mask has them."""
    def step(s: Column, c: Column) -> Column:
        return F.struct(
            F.concat(s["out"], F.when(c == " ", c).otherwise(F.substr(text, s["at"], F.lit(1)))).alias("out"),
            (s["at"] + F.when(c == " ", 0).otherwise(1)).alias("at"))

    chars = F.filter(F.split(mask, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step,
                       lambda s: s["out"])


def _ipv6(value: Column, key: str) -> Column:
    """A digest of the address written out in full, as an address of eight groups. Without a digit
    it is no address but two names."""
    def groups(text: Column) -> Column:
        return F.filter(F.split(F.lower(text), ":"), lambda g: g != "")

    def of(sides: Column) -> Column:
        left, right = groups(sides[0]), F.coalesce(groups(F.try_element_at(sides, F.lit(2))), F.array().cast("array<string>"))
        missing = 8 - F.size(left) - F.size(right)
        short = F.size(sides) == 2
        whole = F.transform(F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right),
                            lambda g: F.lpad(g, 4, "0"))
        fine = F.when(short, missing >= 1).otherwise(missing == 0) & value.rlike("[0-9]") & (
            F.size(left) + F.size(right) > 0)
        digest = F.substring(_digest(key, F.lit("ip6"), F.array_join(whole, ":")), 1, 32)
        return F.when(fine, F.regexp_replace(digest, "(.{4})(?=.)", "$1:"))
    return _let(F.split(value, "::"), of)


def _secret(value: Column, key: str) -> Column:
    first = _digest(key, F.lit("secret"), F.lower(value))
    more = F.transform(F.sequence(F.lit(1), F.floor(F.char_length(value) / 64).cast("int") + 1),
                       lambda i: _digest(key, F.lit("secret"), i, F.lower(value)))
    made = F.substr(F.concat(first, F.array_join(more, "")), F.lit(1), F.char_length(value))
    return F.when(value.rlike("[0-9]") & value.rlike("[a-fA-F]"),
                  F.when(value == F.upper(value), F.upper(made)).otherwise(made))


def _email(value: Column, key: str) -> Column:
    made = F.concat(F.lit("user-"), F.substring(_digest(key, F.lit("email"), F.lower(value)), 1, 16),
                    F.lit("@example.invalid"))
    return F.when(value == F.upper(value), F.upper(made)).otherwise(made)


def _replaced(value: Column, key: str) -> Column:
    """Struct (kind, text) of a match; kind is null and the text as it was if it is not valid."""
    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    def of(kind: str, made: Column) -> Column:
        return F.struct(F.when(made.isNotNull(), F.lit(kind)).alias("kind"),
                        F.coalesce(made, value).alias("text"))

    return (
        F.when(value.contains("@"), of("email", _email(value, key)))
        .when(whole(SECRET), F.when(whole(r"\d{13,19}"), of("card", _card(value, key)))
              .otherwise(of("secret", _secret(value, key))))
        .when(whole(IBAN), of("iban", _iban(value, key)))
        .when(whole(ISO_DATE), of("date", _date(value, key)))
        .when(whole(SLASH_DATE), of("date", _slash_date(value, key)))
        .when(whole(IPV4), of("ip", _ip(value, key)))
        .when(whole(SSN), of("ssn", _ssn(value, key)))
        .when(whole(PHONE), of("phone", _phone(value, key)))
        .when(whole(DIAL), of("phone", _dial(value, key)))
        .when(value.contains(":"), of("ip", _ipv6(value, key)))
        .otherwise(of("card", _card(value, key))))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = None
                 ) -> DataFrame:
    """The input with the text column replaced. ``found`` names a further column: the kinds of
    what was replaced, in order."""
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.col(f"`{text}`").cast("string").alias("t"))
    parts = F.when(F.col("t").rlike("[0-9@]"), F.transform(
        F.regexp_extract_all("t", F.lit(ANY), F.lit(0)), lambda m: _replaced(m, key)))
    made = inner.withColumn("m", parts)
    joined = F.when(F.size("m") > 0, F.array_join(F.zip_with(
        F.split("t", ANY), F.col("m"),
        lambda gap, m: F.concat(gap, F.coalesce(m["text"], F.lit("")))), "")).otherwise(F.col("t"))
    columns = [joined.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    if found:
        columns.append(F.coalesce(F.filter(F.col("m")["kind"], lambda k: k.isNotNull()),
                                  F.array().cast("array<string>")).alias(found))
    return made.select(*columns)
