"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Validated numbers, dates and the local parts of e-mail addresses are permuted
within their own format by a keyed Feistel network, so that equal values stay
equal across documents.  The network works on two residues (l mod a, r mod b):
in turn, each is shifted by a keyed hash of the other.  That is a permutation
for any a and b, so a domain of any size a * b needs no walking, and the same
network serves digit strings, calendar days and addresses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fresh, text_or_empty

ROUNDS = 8
MARK = "\ue000\ue001\ue000"

# Fixed formats of what may be personal data; each is then validated.  An address has at most 64 characters before
# its sign and 127 labels after it, as mail standards say; anything longer is none and stays as it is.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,126}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
    "card": r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
}
KINDS = tuple(PATTERNS)
_ANY = r"(?<![A-Za-z0-9_+.@/-])(?:" + "|".join(PATTERNS.values()) + r")(?![A-Za-z0-9_@]|[.-][0-9])"

_DAYS = (189, 773)  # 189 * 773 = 146,097: the days of 400 Gregorian years
_FIRST_DAY = "1800-01-01"
_BASE26, _LETTERS = "0123456789abcdefghijklmnop", "abcdefghijklmnopqrstuvwxyz"


def _power(base: int, exponent: Column) -> Column:
    """base ** exponent as a long, for exponents up to what a long holds."""
    most = {10: 18, 26: 13}[base]
    return F.element_at(F.array(*(F.lit(base**k) for k in range(most + 1))), exponent + 1)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column | str) -> Column:
    """struct(l, r): the keyed permutation of (left mod a, right mod b)."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak

    def shift(i: Column, value: Column, modulus: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, a.cast("string"), b.cast("string"), i.cast("string"), value.cast("string")), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), modulus)

    def turn(pair: Column, i: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(i % 2 == 0, F.struct(F.pmod(l + shift(i, r, a), a).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), F.pmod(r + shift(i, l, b), b).alias("r"))
        )

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, turn)


def permute(s: Column, key: str, tweak: str, base: int = 10) -> Column:
    """A string of digits (base 10, up to 36) or of lower-case letters (base 26, up to 26), permuted within its length."""
    n = F.length(s)
    na = F.floor(n / 2).cast("int")
    nb = n - na
    number = (lambda x: F.coalesce(F.conv(F.translate(x, _LETTERS, _BASE26), 26, 10), F.lit("0"))) if base == 26 else (lambda x: F.coalesce(x, F.lit("0")))
    value = lambda x: F.when(F.length(x) == 0, F.lit(0)).otherwise(number(x).cast("bigint"))
    out = feistel(value(F.substring(s, F.lit(1), na)), value(F.substring(s, na + 1, nb)), _power(base, na), _power(base, nb), key, tweak)

    def text(x: Column, width: Column) -> Column:
        digits = F.lower(F.conv(x.cast("string"), 10, 26)) if base == 26 else x.cast("string")
        padded = F.lpad(digits, width, "0")
        return F.translate(padded, _BASE26, _LETTERS) if base == 26 else padded

    # one character has no halves, so the network would only turn it: it is looked up in a keyed order of all of them
    signs = _LETTERS if base == 26 else "0123456789"
    keyed = sorted(range(base), key=lambda i: hashlib.sha256("|".join(map(str, (key, tweak, base, i))).encode()).digest())
    return F.when(n == 1, F.translate(s, signs, "".join(signs[i] for i in keyed))).otherwise(_let(out, lambda p: F.concat(text(p["l"], na), text(p["r"], nb))))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _only(s: Column, kept: str) -> Column:
    return F.regexp_replace(s, f"[^{kept}]", "")


def refill(shape: Column, kept: str, chars: Column) -> Column:
    """shape with its characters of class `kept` replaced, in order, by those of chars."""
    place = F.sequence(F.lit(1), F.length(shape))
    one = lambda i: F.when(F.substring(shape, i, F.lit(1)).rlike(f"[{kept}]"), F.substring(chars, F.length(_only(F.substring(shape, F.lit(1), i), kept)), F.lit(1))).otherwise(F.substring(shape, i, F.lit(1)))
    return F.array_join(F.transform(place, one), "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum; the last digit counts once."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def mod97(iban: Column) -> Column:
    """ISO 7064 remainder of an IBAN without blanks; 1 if valid."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def _date(s: Column) -> Column:
    """The day of any of the layouts, or null; with slashes, month first is tried where day first is no date."""
    joined = lambda *at: F.concat_ws("-", *(F.substring(s, a, n) for a, n in at)).try_cast("date")
    return F.when(s.rlike("^[0-9]{4}"), joined((1, 4), (6, 2), (9, 2))).otherwise(F.coalesce(joined((7, 4), (4, 2), (1, 2)), F.when(_month_first(s), joined((7, 4), (1, 2), (4, 2)))))


def _month_first(s: Column) -> Column:
    """Whether the second part of a date with slashes can only be a day."""
    return F.substring(s, 3, 1).eqNullSafe("/") & (F.substring(s, 4, 2) > "12")


def kind_of(s: Column) -> Column:
    """The kind of a match if it is valid, else null."""
    is_ = lambda kind: s.rlike(f"^(?:{PATTERNS[kind]})$")
    digits = _only(s, "0-9")
    octets = F.split(s, r"\.")
    day = _date(s)
    return (
        F.when(F.contains(s, F.lit("@")), F.when(is_("email"), "email"))
        .when(is_("iban") & (mod97(F.replace(s, F.lit(" "))) == 1), "iban")
        .when(s.startswith("+"), F.when(is_("phone") & F.length(digits).between(8, 15), "phone"))
        .when(is_("date"), F.when(day.between(F.lit(_FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date")), "date"))
        .when(is_("ssn"), F.when(~digits.rlike("^(?:000|666|9)") & (F.substring(digits, 4, 2) != "00") & (F.substring(digits, 6, 4) != "0000"), "ssn"))
        .when(is_("ip"), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ip"))
        .when(is_("card") & F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0), "card")
    )


def pseudonym(s: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid match, in its own format and valid again."""
    digits = _only(s, "0-9")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    card = _let(permute(body, key, "card"), lambda p: refill(s, "0-9", F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))))

    head = F.when(digits.startswith("1"), 1).otherwise(2)
    phone = refill(s, "0-9", F.concat(F.substring(digits, F.lit(1), head), permute(F.substring(digits, head + 1, F.length(digits)), key, "phone")))

    bare = F.replace(s, F.lit(" "))
    account = F.substring(bare, F.lit(5), F.length(bare))
    changed = refill(account, "0-9", permute(_only(account, "0-9"), key, "iban"))
    checked = _let(changed, lambda p: F.concat(F.substring(bare, 1, 2), F.lpad((98 - mod97(F.concat(F.substring(bare, 1, 2), F.lit("00"), p))).cast("string"), 2, "0"), p))
    iban = _let(checked, lambda p: refill(s, "A-Z0-9", p))

    day = F.datediff(_date(s), F.lit(_FIRST_DAY).cast("date"))
    moved = feistel(F.floor(day / _DAYS[1]), day % _DAYS[1], F.lit(_DAYS[0]), F.lit(_DAYS[1]), key, "date")
    new_day = _let(moved, lambda p: F.date_add(F.lit(_FIRST_DAY).cast("date"), (p["l"] * _DAYS[1] + p["r"]).cast("int")))
    shaped = lambda d: F.when(s.rlike("^[0-9]{4}"), F.date_format(d, "yyyyMMdd")).when(_month_first(s), F.date_format(d, "MMddyyyy")).otherwise(F.date_format(d, "ddMMyyyy"))
    date = _let(new_day, lambda d: refill(s, "0-9", shaped(d)))

    area = F.substring(digits, 1, 3).cast("bigint")
    place = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + F.substring(digits, 4, 2).cast("bigint") - 1
    social = feistel(place, F.substring(digits, 6, 4).cast("bigint") - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def ssn_text(p: Column) -> Column:
        area = F.floor(p["l"] / 99) + 1
        area = area + F.when(area >= 666, 1).otherwise(0)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((p["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((p["r"] + 1).cast("string"), 4, "0"))

    octet = F.split(s, r"\.")
    pair = lambda i: F.element_at(octet, i).cast("bigint") * 256 + F.element_at(octet, i + 1).cast("bigint")
    address = feistel(pair(1), pair(3), F.lit(65536), F.lit(65536), key, "ip")
    ip = _let(address, lambda p: F.concat_ws(".", *(x.cast("string") for half in (p["l"], p["r"]) for x in (F.floor(half / 256), half % 256))))

    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
    low = F.lower(local)
    letters, numbers = _only(low, "a-z"), _only(low, "0-9")
    chunks = lambda x, size, base: F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(x) - 1, F.lit(0)) / size).cast("int")), lambda i: permute(F.substring(x, (i * size + 1).cast("int"), F.lit(size)), key, "email", base)), "")
    email = F.concat(refill(refill(low, "a-z", chunks(letters, 24, 26)), "0-9", chunks(numbers, 30, 10)), F.lit("@"), domain)

    return (
        F.when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "iban", iban)
        .when(kind == "date", date)
        .when(kind == "ssn", _let(social, ssn_text))
        .when(kind == "ip", ip)
        .when(kind == "email", email)
        .otherwise(s)
    )


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", into: str = "pii") -> DataFrame:
    """docs with the text pseudonymised and a struct `into` of counts by kind.

    The text is cut at candidate matches with a mark, the odd pieces are
    validated and permuted, and the pieces are joined again; a mark that the
    text itself holds cuts it first, and is put back.  Null texts become
    empty; case is lost in the local part of an e-mail address.  The key is
    part of the plan, so plans and event logs are as secret as the key.
    """
    segments, kinds, text = fresh(docs, "segments", "kinds", "plain")
    cut = lambda part: F.split(F.regexp_replace(part, _ANY, MARK + "$0" + MARK), MARK, -1)
    # any candidate has a digit or an at sign; other texts are not searched
    likely = F.col(text).rlike("[0-9@]")
    out = docs.withColumn(text, text_or_empty(text_col)).withColumn(
        segments, F.when(likely, F.transform(F.split(F.col(text), MARK, -1), cut)).otherwise(F.array(F.array(F.col(text))))
    )
    kind = F.transform(segments, lambda p: F.transform(p, lambda s, i: F.when(i % 2 == 1, kind_of(s))))
    out = out.withColumn(kinds, F.when(likely, kind))
    changed = F.transform(
        F.arrays_zip(F.col(segments).alias("s"), F.col(kinds).alias("k")),
        lambda p: F.array_join(F.transform(F.arrays_zip(p["s"].alias("x"), p["k"].alias("y")), lambda q: F.when(q["y"].isNull(), q["x"]).otherwise(pseudonym(q["x"], q["y"], key))), ""),
    )
    found = F.size(F.filter(F.flatten(kinds), lambda k: k.isNotNull())) > 0
    flat = F.coalesce(F.flatten(kinds), F.array().cast("array<string>"))
    number = lambda kind: F.size(F.filter(flat, lambda k: k == F.lit(kind))).cast("long").alias(kind)
    counts = F.struct(*map(number, KINDS))
    return out.withColumn(text_col, F.when(found, F.array_join(changed, MARK)).otherwise(F.col(text))).withColumn(into, counts).drop(segments, kinds, text)


def pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """Per row: doc_id, text (pseudonymised), n_<kind> for each kind and n_found.  An empty table gives no rows."""
    out = pseudonymise(docs.select("doc_id", "text"), key)
    counts = [F.col(f"pii.{k}").alias(f"n_{k}") for k in KINDS]
    total = sum((F.col(f"pii.{k}") for k in KINDS[1:]), F.col(f"pii.{KINDS[0]}"))
    return out.select("doc_id", "text", *counts, total.alias("n_found"))
