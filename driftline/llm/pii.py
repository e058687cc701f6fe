"""Operator 9: format-preserving pseudonyms for personal data, in DataFrame functions only.

One pattern finds candidates; each kind has its own check (Luhn for cards, mod 97 for
IBANs, octets, calendar days, area numbers), and what fails it stays as it is. A valid
value is replaced by another valid value of the same format: a keyed Feistel network
permutes the values of the format, so equal values get equal pseudonyms in all
documents, different values different ones, and without the key nothing leads back.
A value is cut in two parts (x, y) of sizes m and n; each round turns (x, y) into
(y, x + F(key, kind, round, y) mod m), F from SHA-256, which can be undone for any
sizes, so no value of a format is hit twice or left out. Numbers with a check digit
permute the rest and compute the digit anew; dates permute the days of their
400-year cycle; e-mail names and secrets permute letters among letters and digits
among digits (letters beside ASCII among those of their script). The text around the
values is not touched. Phone numbers are told by their digits, however they are spaced,
and with or without +1; a number in a national form without a leading + is none, other
than ten digits in the North American form, as nothing tells it from other numbers.

Cases: a null text stays null, an empty one empty; a value that occurs often or in
many documents maps alike everywhere; an empty table gives no rows; other columns
pass through untouched (the operator adds one struct, which replaces a column of its
name)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.quality import let

ROUNDS = 8

#: Letters of names and domains beside ASCII: Latin, Greek, Cyrillic and combining marks.
_LETTERS = "À-ԯ"
#: Patterns of the kinds, in order of precedence. Runs of one class have no upper limit: Java reads them in a loop.
EMAIL = (rf"(?<![A-Za-z0-9._%+{_LETTERS}-])[A-Za-z0-9._%+{_LETTERS}-]++@[A-Za-z0-9{_LETTERS}]"
         rf"[A-Za-z0-9.{_LETTERS}-]*\.[A-Za-z{_LETTERS}]{{2,}}(?![A-Za-z0-9{_LETTERS}])")
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
#: Key words and the shortest value that counts after them.
KEY_WORDS = ((r"(?i:pass(?:word|wd|phrase)|pwd)", 4), (r"(?i:token|secret|(?:api|access|private|secret)[_-]?key)", 8))
#: What stands between a key word and its value: =, :, := or =>, blanks, the quote that ends a quoted key.
_SEP = r"[\"']?[ \t]*+(?::=|=>|=|:)[ \t]*+"
#: (what stays, value): a quoted value goes up to its quote, an unquoted one to the next blank or quote.
ASSIGNED = [(r"(?i:authorization)" + _SEP + r"[\"']?(?i:bearer|basic|token)[ \t]++", r"[^\s\"',;]{8,}+"),
            (r"(?i:bearer)[ \t]++", r"(?=[A-Za-z._~+/-]*+[0-9])[A-Za-z0-9._~+/-]{8,}+=*+")] + [
    (word + _SEP + quote, value.replace("LEAST", str(least))) for word, least in KEY_WORDS
    for quote, value in (('"', r"[^\"\r\n]{LEAST,}+(?=\")"), ("'", r"[^'\r\n]{LEAST,}+(?=')"),
                         (r"[\"']?", r"[^\s\"']{LEAST,}+"))]
#: What an assignment can begin with; other places are passed over at once.
_FIRST = "(?=[aAbBpPsStT])"
HEX = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
        r"(?![0-9]|[./-][0-9])")
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
IPV6 = (r"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])")
PHONE = (r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
         r"|(?<![0-9(])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])")
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
#: Every candidate: what stays in the odd groups, the value in the even ones and in the last.
ANY = (_FIRST + "(?:" + "|".join(f"({before})({value})" for before, value in ASSIGNED) + ")|("
       + "|".join(f"(?:{p})" for p in (EMAIL, IBAN, ACCESS_KEY, HEX, SSN, DATE, IP, IPV6, PHONE, CARD)) + ")")
_STAYS = "".join(f"${2 * i + 1}" for i in range(len(ASSIGNED)))
_VALUE = "".join(f"${2 * i + 2}" for i in range(len(ASSIGNED))) + f"${2 * len(ASSIGNED) + 1}"
#: Noncharacters: the mark around values, and what a text's own marks and escapes are written as.
_MARK, _ESCAPE, _FOR_ESCAPE, _FOR_MARK = "\uFDD0", "\uFDD1", "\uFDD2", "\uFDD3"


def _full(v: Column, pattern: str) -> Column:
    """Whether the whole value has the format (the surroundings were looked at before)."""
    import re
    plain = re.sub(r"\(\?<?[!=](?:[^()\[\]\\]|\\.|\[[^\]]*\])*\)", "", pattern)
    return v.rlike(f"^(?:{plain})$")


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _prf(key: str, kind: str, rnd: Column, value: Column, modulus: Column) -> Column:
    mac = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), rnd.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(mac, 1, 15), 16, 10).cast("bigint"), modulus)


def permute(x: Column, y: Column, m: Column, n: Column, key: str, kind: str) -> Column:
    """Struct (x, y) of a keyed permutation of the pairs 0 <= x < m, 0 <= y < n.
    The moduli are part of the keyed input, so formats are permuted apart."""
    big = lambda c: c.cast("bigint")
    start = F.struct(big(x).alias("x"), big(y).alias("y"), big(m).alias("m"), big(n).alias("n"))
    # the sizes change sides with the parts; an even number of rounds brings them back
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, r: F.struct(
        s["y"].alias("x"),
        F.pmod(s["x"] + _prf(key, kind, r, F.concat_ws("/", s["m"], s["n"], s["y"]), s["m"]), s["m"]).alias("y"),
        s["n"].alias("m"), s["m"].alias("n")))


def permute_digits(d: Column, key: str, kind: str) -> Column:
    """Another string of as many digits (2 to 36 digits)."""
    half = (F.length(d) / 2).cast("int")
    rest = F.length(d) - half
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")
    return let(permute(F.substr(d, F.lit(1), half), F.substr(d, half + 1), power(half), power(rest), key, kind),
               lambda p: F.concat(F.lpad(p["x"].cast("string"), half, "0"), F.lpad(p["y"].cast("string"), rest, "0")))


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Classes of names: small and capital Latin-1 letters, Greek and Cyrillic letters, and the rest of _LETTERS.
_span = lambda *parts: "".join(chr(c) for a, b in parts for c in range(a, b))
_NAME_CLASSES = (*_CLASSES, _span((0xE0, 0xF7), (0xF8, 0x100)), _span((0xC0, 0xD7), (0xD8, 0xDF)),
                 _span((0x3B1, 0x3CA)), _span((0x391, 0x3A2), (0x3A3, 0x3AA)), _span((0x430, 0x450)),
                 _span((0x410, 0x430)),
                 _span((0xD7, 0xD8), (0xDF, 0xE0), (0xF7, 0xF8), (0x100, 0x391), (0x3A2, 0x3A3), (0x3AA, 0x3B1),
                       (0x3CA, 0x410), (0x450, 0x530)))


def permute_chars(v: Column, key: str, kind: str, classes: tuple[str, ...] = _CLASSES) -> Column:
    """Another string with digits, small and capital letters where ``v`` has them. Parts
    are strings here and F shifts each character within its class."""
    half = (F.length(v) / 2).cast("int")

    def shifted(part: Column, other: Column, r: Column) -> Column:
        # the classes of both parts are keyed input, which stays the same in every round
        mac = lambda i, o: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"),
                                              i.cast("string"), F.length(part).cast("string"), o), 256)

        def one(c: Column, i: Column, o: Column) -> Column:
            out = F.when(F.lit(False), c)
            for letters in classes:
                at = F.instr(F.lit(letters), c)
                n = len(letters)
                out = out.when(at > 0, F.substr(F.lit(letters), F.pmod(
                    at - 1 + F.conv(F.substring(mac(i, o), 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int") + 1,
                    F.lit(1)))
            return out.otherwise(c)
        # a long part is hashed once and not for every character of the other
        return let(F.when(F.length(other) > 100, F.sha2(other, 256)).otherwise(other), lambda o: F.array_join(
            F.transform(F.split(part, ""), lambda c, i: one(c, i, o)), ""))

    start = F.struct(F.substr(v, F.lit(1), half).alias("x"), F.substr(v, half + 1).alias("y"))
    out = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, r: F.struct(
        s["y"].alias("x"), shifted(s["x"], s["y"], r).alias("y")))
    return let(out, lambda s: F.concat(s["x"], s["y"]))


def _refill(v: Column, digits: Column) -> Column:
    """The digits in the places of the digits of ``v``."""
    return let(digits, lambda d: F.array_join(F.transform(F.split(v, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substr(d, F.length(_digits(F.substr(v, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), ""))


def _luhn_sum(d: Column) -> Column:
    """Luhn sum of digits whose last one is not doubled."""
    n = F.length(d)
    return F.aggregate(F.transform(F.split(d, ""), lambda c, i: let(c.cast("int"), lambda x: F.when(
        F.pmod(n - i, F.lit(2)) == 1, x).otherwise(F.pmod(2 * x, F.lit(10)) + F.floor(2 * x / 10).cast("int")))),
        F.lit(0), lambda a, x: a + x)


def _mod97(v: Column) -> Column:
    """Value of a string of digits and capitals (A = 10 ...) modulo 97."""
    return F.aggregate(F.split(v, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(
        c.rlike("^[0-9]$"), F.pmod(a * 10 + c.cast("int"), F.lit(97)))
        .otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))).cast("int"))


def _card(v, key):
    def made(d):
        front = permute_digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(front, lambda f: _refill(v, F.concat(f, F.pmod(
            F.lit(10) - F.pmod(_luhn_sum(F.concat(f, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))))
    return let(_digits(v), lambda d: F.when(F.pmod(_luhn_sum(d), F.lit(10)) == 0, made(d)).otherwise(v))


#: First digits of country codes of one digit, and the codes of two; all others have three.
_ONE_DIGIT = ("1", "7")
_TWO_DIGITS = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
               "81 82 84 86 90 91 92 93 94 95 98").split()


def _phone(v, key):
    """The digits after the country code are permuted, whatever stands between them."""
    def made(d):
        code = F.when(~v.startswith("+"), 0).when(F.substr(d, F.lit(1), F.lit(1)).isin(*_ONE_DIGIT), 1) \
            .when(F.substr(d, F.lit(1), F.lit(2)).isin(*_TWO_DIGITS), 2).otherwise(3)
        return let(code, lambda n: _refill(v, F.concat(
            F.substr(d, F.lit(1), n), permute_digits(F.substr(d, n + 1), key, "phone"))))
    return let(_digits(v), made)


def _ip(v, key):
    def made(o):
        p = permute(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
        hi, lo = (lambda c: F.floor(c / 256).cast("string")), (lambda c: F.pmod(c, F.lit(256)).cast("string"))
        return let(p, lambda s: F.concat_ws(".", hi(s["x"]), lo(s["x"]), hi(s["y"]), lo(s["y"])))
    return let(F.split(v, r"\.").cast("array<int>"),
               lambda o: F.when(F.array_max(o) <= 255, made(o)).otherwise(v))


def _ssn(v, key):
    area, group, serial = (F.substr(v, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    x = (area - 1 - (area > 666).cast("int")) * 99 + group - 1
    p = permute(x, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def made(s):
        a = F.floor(s["x"] / 99).cast("int")
        part = lambda c, n: F.lpad(c.cast("string"), n, "0")
        return F.concat_ws("-", part(a + 1 + (a >= 665).cast("int"), 3), part(F.pmod(s["x"], F.lit(99)) + 1, 2),
                           part(s["y"] + 1, 4))
    return F.when(valid, let(p, made)).otherwise(v)


#: Days of 400 years, and two factors of that number.
_CYCLE, _CYCLE_X, _CYCLE_Y = 146_097, 189, 773


def _date(v, key):
    """y-m-d, m/d/y and d.m.y; the pseudonym is a day of the same 400 years."""
    day = F.coalesce(F.try_to_date(v, "yyyy-MM-dd"), F.try_to_date(v, "MM/dd/yyyy"), F.try_to_date(v, "dd.MM.yyyy"))
    written = lambda x: F.when(v.contains("-"), F.date_format(x, "yyyy-MM-dd")).when(
        v.contains("/"), F.date_format(x, "MM/dd/yyyy")).otherwise(F.date_format(x, "dd.MM.yyyy"))

    def made(d):
        cycle = F.floor((F.year(d) - 1) / 400) * 400 + 1
        n = F.datediff(d, F.make_date(cycle, F.lit(1), F.lit(1)))
        p = permute(F.floor(n / _CYCLE_Y), F.pmod(n, F.lit(_CYCLE_Y)), F.lit(_CYCLE_X), F.lit(_CYCLE_Y), key, "date")
        return let(p, lambda s: written(
            F.date_add(F.make_date(cycle, F.lit(1), F.lit(1)), (s["x"] * _CYCLE_Y + s["y"]).cast("int"))))
    return let(day, lambda d: F.when(d.isNotNull() & (F.year(d) > 0), made(d)).otherwise(v))


def _iban(v, key):
    flat = F.replace(v, F.lit(" "), F.lit(""))
    valid = _mod97(F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))) == 1

    def made(b):
        body = permute_chars(b, key, "iban")
        country = F.substr(v, F.lit(1), F.lit(2))
        return let(body, lambda x: F.concat(country, F.lpad(
            (F.lit(98) - _mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x))
    spaced = let(made(F.substr(flat, F.lit(5))), lambda f: F.array_join(F.transform(
        F.split(v, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(
            f, F.length(F.replace(F.substr(v, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), ""))
    return F.when(valid, spaced).otherwise(v)


def _email(v, key):
    return let(F.split(v, "@"), lambda p: F.concat(permute_chars(p[0], key, "email", _NAME_CLASSES), F.lit("@"), p[1]))


def _ipv6(v, key):
    return permute_chars(v, key, "ipv6", ("0123456789abcdef", "ABCDEF"))


def _secret(v, key):
    hexed = lambda *classes: permute_chars(v, key, "hex", classes)
    return F.when(v.startswith("AKIA"), F.concat(F.lit("AKIA"), permute_chars(F.substr(v, F.lit(5)), key, "akia"))) \
        .when(v.rlike("^[0-9a-f]+$"), hexed("0123456789abcdef")) \
        .when(v.rlike("^[0-9A-F]+$"), hexed("0123456789ABCDEF")) \
        .when(v.rlike("^[0-9A-Fa-f]+$"), hexed("0123456789", "abcdef", "ABCDEF")) \
        .otherwise(permute_chars(v, key, "secret"))


#: (kind, pattern, pseudonym of a value with that pattern; invalid values come back unchanged)
KINDS: list[tuple[str, str, Callable[[Column, str], Column]]] = [
    ("email", EMAIL, _email), ("date", DATE, _date), ("ssn", SSN, _ssn), ("ip", IP, _ip),
    ("ipv6", IPV6, _ipv6), ("phone", PHONE, _phone),
    ("card", CARD, _card), ("access key", ACCESS_KEY, _secret), ("iban", IBAN, _iban)]


def pseudonym(v: Column, key: str) -> Column:
    """Struct (kind, value, pseudonym) of a match of ANY."""
    kind, made = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), v)
    for name, pattern, f in KINDS:
        fits = _full(v, pattern)
        kind, made = kind.when(fits, F.lit(name)), made.when(fits, f(v, key))
    return F.struct(kind.otherwise(F.lit("secret")).alias("kind"), v.alias("value"),
                    made.otherwise(_secret(v, key)).alias("pseudonym"))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", out: str = "pii") -> DataFrame:
    """The rows with pseudonyms in ``text`` and a struct ``out``: values replaced, by kind."""
    t, cut = F.col(text), "__pieces"
    while cut in docs.columns:
        cut += "_"
    # one pass: marks are written around the values, and the marked text is cut at the marks
    own = F.coalesce(t.contains(_MARK) | t.contains(_ESCAPE), F.lit(False))
    plain = F.when(own, F.replace(F.replace(t, F.lit(_ESCAPE), F.lit(_ESCAPE + _FOR_ESCAPE)), F.lit(_MARK),
                                  F.lit(_ESCAPE + _FOR_MARK))).otherwise(t)
    rows = docs.withColumn(cut, F.split(F.regexp_replace(plain, ANY, f"{_STAYS}{_MARK}{_VALUE}{_MARK}"), _MARK, -1))
    odd = lambda at: (lambda p, i: F.pmod(i, F.lit(2)) == at)
    rows = rows.withColumn(out, F.transform(F.filter(cut, odd(1)), lambda v: pseudonym(v, key)))
    joined = F.array_join(F.zip_with(F.filter(cut, odd(0)), F.col(out), lambda p, m: F.concat(
        F.coalesce(p, F.lit("")), F.coalesce(m["pseudonym"], F.lit("")))), "")
    joined = F.when(own, F.replace(F.replace(joined, F.lit(_ESCAPE + _FOR_MARK), F.lit(_MARK)),
                                   F.lit(_ESCAPE + _FOR_ESCAPE), F.lit(_ESCAPE))).otherwise(joined)
    rows = rows.withColumn(text, F.when(F.size(F.coalesce(F.col(out), F.array())) > 0, joined).otherwise(t)).drop(cut)
    changed = F.filter(F.coalesce(F.col(out), F.array().cast(rows.schema[out].dataType)),
                       lambda m: m["value"] != m["pseudonym"])
    return rows.withColumn(out, let(changed, lambda c: F.struct(
        F.size(c).alias("replaced"),
        F.array_sort(F.array_distinct(F.transform(c, lambda m: m["kind"]))).alias("kinds"))))
