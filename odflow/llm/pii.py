"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame functions only.

Values are found by fixed patterns, validated (Luhn sum, octets, calendar, area codes) and run through a keyed
Feistel network over their own format: a card number becomes another valid card number of that length,
an address another address, a date another date. The same value under the same key becomes the same pseudonym in every
document, so links survive, and the key holder can undo it. Whole texts are rewritten where they
lie, with no shuffle. Values that fail validation stay as they are.

The network is generalised to mixed radices: a value in 0 .. a * b - 1 is held as (x mod a, y mod b) and the rounds
add a keyed hash of one half to the other, modulo a or b in turn. Each round is a bijection, so
the domain is met exactly, without cycle walking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.columns import let

ROUNDS = 10
KEY = "corpus-key-1"

# Fixed patterns; alternatives are tried in this order at each place of the text.
_BEFORE, _AFTER = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Phone numbers: with a country code; (ddd) ddd-dddd, ddd-ddd-dddd, ddd.ddd.dddd, ddd ddd dddd; groups of 3 2 2 2 or 2 3 2 2; with a
#: leading 0, in brackets or before a separator, 8 digits or more. None asks for a digit that a pseudonym may change, and
#: those with a 0 do not take the forms of a date or of an ssn.
_ZERO_PLACE = r"(?<![0-9][./-])"
#: A group after a space belongs to the number unless something else that is known begins there.
_GROUP = (r" (?!(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.)|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
          r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9]))")
_PHONES = [
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:(?:[.-]?|" + _GROUP + r")[0-9]{2,4}){1,5}(?:-[0-9])?",
    r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}", r"[0-9]{3}-[0-9]{3}-[0-9]{4}",
    _ZERO_PLACE + r"(?:[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?!\.?[0-9])|[0-9]{3} [0-9]{3} [0-9]{4}(?! ?[0-9]))",
    _ZERO_PLACE + r"(?:[0-9]{3} [0-9]{2}|[0-9]{2} [0-9]{3}) [0-9]{2} [0-9]{2}(?! ?[0-9])",
    r"\(0[0-9]{1,5}\)(?=(?:[ ./-]?[0-9]){5}) ?[0-9]{2,8}(?:(?:[./-]|" + _GROUP + r")[0-9]{2,8}){0,4}(?:-[0-9])?",
    _ZERO_PLACE + r"(?![0-9]{2}[./ -][0-9]{2}[./ -][0-9]{4}(?![./ -]?[0-9]))(?![0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))(?=0(?:[ ./-]?[0-9]){7})"
    r"(?:0[0-9]{1,4}[ /-][0-9]{2,8}(?:(?:-|" + _GROUP + r")[0-9]{2,8}){0,4}(?:-[0-9])?|0[0-9]{1,3}(?:\.[0-9]{2,4}){2,4})(?![./]?[0-9])",
]
PATTERNS = {
    "secret": r"(?<![0-9A-Za-z])(?=[0-9]{0,63}[A-Fa-f])(?:[0-9a-f]{64}|[0-9A-F]{64}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{32}|[0-9A-F]{32})(?![0-9A-Za-z])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\.?[0-9])",
    "date": _BEFORE + r"(?:[12][0-9]{3}-[01][0-9]-[0-3][0-9]|[0-3][0-9][/.][01][0-9][/.][12][0-9]{3})" + r"(?![-./]?[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": _BEFORE + "(?:" + "|".join(_PHONES) + ")(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
KINDS = tuple(PATTERNS)
#: 400 Gregorian years are 146,097 = 189 * 773 days; the cycles start on 1000-01-01 of the proleptic calendar.
_CYCLE_A, _CYCLE_B, _CYCLE_START = 189, 773, -354285


def _round_value(key: str, tag: Column, r: Column, half: Column) -> Column:
    """60-bit keyed hash of a round's input."""
    text = F.concat_ws("|", F.lit(key), tag, r.cast("string"), half.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """Keyed bijection on pairs x in 0..a-1, y in 0..b-1; a struct of both."""
    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if inverse else 1

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        x1 = F.when(even, F.pmod(s["x"] + sign * (_round_value(key, tag, r, s["y"]) % a), a)).otherwise(s["x"])
        y1 = F.when(even, s["y"]).otherwise(F.pmod(s["y"] + sign * (_round_value(key, tag, r, s["x"]) % b), b))
        return F.struct(x1.cast("long").alias("x"), y1.cast("long").alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(order, start, step)


def _ten_to(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: str, tag: str, inverse: bool = False) -> Column:
    """Keyed permutation of the digit strings of one length (2 to 36 digits)."""

    def body(d: Column) -> Column:
        n = F.char_length(d)
        left = F.floor(n / 2).cast("int")
        right = n - left
        moved = feistel(F.substr(d, F.lit(1), left).cast("long"), F.substr(d, left + 1, right).cast("long"),
                        _ten_to(left), _ten_to(right), key, F.concat(F.lit(tag), n.cast("string")), inverse)
        return let(moved, lambda m: F.concat(F.lpad(m["x"].cast("string"), left, F.lit("0")),
                                             F.lpad(m["y"].cast("string"), right, F.lit("0"))))

    return let(digits, body)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by those of ``digits``; other characters stay."""
    state = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["s"], F.when(is_digit, F.substr(digits, s["i"], F.lit(1))).otherwise(c)).alias("s"),
                        (s["i"] + is_digit.cast("int")).alias("i"))

    return F.aggregate(F.split(form, ""), state, step, lambda s: s["s"])


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(v: Column, key: str, inverse: bool) -> Column:
    def body(d: Column) -> Column:
        head = permute_digits(F.substr(d, F.lit(1), F.char_length(d) - 1), key, "card", inverse)
        whole = let(head, lambda h: F.concat(h, F.get(F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: c.cast("string")),
            lambda c: _luhn(F.concat(h, c))), F.lit(0))))
        return F.when(_luhn(d) & ~d.rlike("^0+$"), _refill(v, whole)).otherwise(v)

    return let(_digits(v), body)


def _phone(v: Column, key: str, inverse: bool) -> Column:
    """All digits but a leading country code's, or a leading 0 where the form is only known by it."""

    def body(d: Column) -> Column:
        code = F.when(v.startswith("+"), F.char_length(F.regexp_extract(v, r"^\+([0-9]{1,3})", 1))).when(
            v.rlike(r"^\(?0") & ~v.rlike("^(?:" + "|".join(_PHONES[1:5]) + ")$"), 1).otherwise(0)
        return let(code, lambda c: F.when(
            (F.char_length(d) - c).between(6, 15) & (F.char_length(d) <= 15),
            _refill(v, F.concat(F.substr(d, F.lit(1), c), permute_digits(F.substr(d, c + 1, F.lit(36)), key, "phone", inverse))))
            .otherwise(v))

    return let(_digits(v), body)


def _ip(v: Column, key: str, inverse: bool) -> Column:
    parts = F.transform(F.split(v, r"\."), lambda p: p.cast("long"))
    moved = let(parts, lambda p: feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key,
                                         F.lit("ip"), inverse))
    return let(moved, lambda m: F.concat_ws(".", F.floor(m["x"] / 256), m["x"] % 256, F.floor(m["y"] / 256), m["y"] % 256))


def _date(v: Column, key: str, inverse: bool) -> Column:
    """Another day of the same 400 years, written in the same order and with the same separators."""
    iso = v.rlike("^[12][0-9]{3}-")
    parts = let(_digits(v), lambda d: F.when(iso, d).otherwise(
        F.concat(F.substring(d, 5, 4), F.substring(d, 3, 2), F.substring(d, 1, 2))))
    day = F.unix_date(F.try_to_timestamp(parts, F.lit("yyyyMMdd")).cast("date"))

    def body(n: Column) -> Column:
        since = n - _CYCLE_START
        cycle, at = F.floor(since / (_CYCLE_A * _CYCLE_B)), F.pmod(since, F.lit(_CYCLE_A * _CYCLE_B))
        moved = feistel(F.floor(at / _CYCLE_B), at % _CYCLE_B, F.lit(_CYCLE_A), F.lit(_CYCLE_B), key, F.lit("date"), inverse)
        new = let(moved, lambda m: F.date_from_unix_date(
            (m["x"] * _CYCLE_B + m["y"] + cycle * (_CYCLE_A * _CYCLE_B) + _CYCLE_START).cast("int")))
        text = let(new, lambda d: F.when(iso, F.date_format(d, "yyyyMMdd")).otherwise(F.date_format(d, "ddMMyyyy")))
        return F.when(n.isNull(), v).otherwise(_refill(v, text))

    return let(day, body)


def _ssn(v: Column, key: str, inverse: bool) -> Column:
    """Area 1-899 without 666 (898 values), group 1-99, serial 1-9999: 88,902 times 9,999 numbers."""

    def body(d: Column) -> Column:
        area, group, serial = (F.substring(d, p, n).cast("long") for p, n in ((1, 3), (4, 2), (6, 4)))
        place = area - F.when(area > 666, 2).otherwise(1)
        moved = feistel(place * 99 + group - 1, serial - 1, F.lit(88902), F.lit(9999), key, F.lit("ssn"), inverse)

        def text(m: Column) -> Column:
            p = F.floor(m["x"] / 99)
            return F.concat_ws("-", F.lpad((p + F.when(p >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                               F.lpad((m["x"] % 99 + 1).cast("string"), 2, "0"), F.lpad((m["y"] + 1).cast("string"), 4, "0"))

        return let(moved, text)

    return let(_digits(v), body)


def _secret(v: Column, key: str, inverse: bool) -> Column:
    """Hexadecimal strings, in sections of 16 digits, each permuted under the sections before it."""
    upper = v.rlike("[A-F]")

    def section(s: Column, i: Column) -> Column:
        part = F.substr(F.lower(v), i * 16 + 1, F.lit(16))
        n = F.char_length(part)

        def moved(p: Column) -> Column:
            half = F.floor(n / 2).cast("int")
            size = F.pow(F.lit(16.0), half).cast("long")
            x, y = F.conv(F.substr(p, F.lit(1), half), 16, 10), F.conv(F.substr(p, half + 1, half), 16, 10)
            m = feistel(x.cast("long"), y.cast("long"), size, size, key, F.concat(F.lit("hex"), s["chain"]), inverse)
            return let(m, lambda q: F.concat(F.lpad(F.lower(F.conv(q["x"].cast("string"), 10, 16)), half, F.lit("0")),
                                             F.lpad(F.lower(F.conv(q["y"].cast("string"), 10, 16)), half, F.lit("0"))))

        return let(let(part, moved), lambda new: F.struct(
            F.concat(s["out"], new).alias("out"), F.concat(s["chain"], new if inverse else part).alias("chain")))

    last = F.ceil(F.char_length(v) / 16).cast("int") - 1
    out = F.aggregate(F.sequence(F.lit(0), last), F.struct(F.lit("").alias("out"), F.lit("").alias("chain")), section,
                      lambda s: s["out"])
    return F.when(upper, F.upper(out)).otherwise(out)


def _email(v: Column, key: str, inverse: bool) -> Column:
    """The local part becomes a keyed code of 16 hexadecimal digits (not undone); the domain stays."""
    if inverse:
        return v
    local = F.lower(F.substring_index(v, "@", 1))
    domain = F.lower(F.substring_index(v, "@", -1))
    code = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), local, domain, F.lit(key)).cast("binary"), 256), 1, 16)
    return F.concat(F.lit("u"), code, F.lit("@"), F.substring_index(v, "@", -1))


_MAKERS: dict[str, Callable[[Column, str, bool], Column]] = {
    "secret": _secret, "email": _email, "ip": _ip, "date": _date, "card": _card, "phone": _phone, "ssn": _ssn}


def _whole(kind: str) -> str:
    return "^(?:" + PATTERNS[kind] + ")$"


def _kind(v: Column, kinds: tuple[str, ...]) -> Column:
    found = F.lit(None).cast("string")
    for kind in reversed(kinds):
        found = F.when(v.rlike(_whole(kind)), F.lit(kind)).otherwise(found)
    return found


def pseudonym(value: Column, kind: Column, key: str = KEY, inverse: bool = False, kinds: tuple[str, ...] = KINDS) -> Column:
    """The pseudonym of one found value (itself where it fails validation); with ``inverse`` the value again."""
    out = value
    for k in kinds:
        out = F.when(kind == k, _MAKERS[k](value, key, inverse)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, kinds: tuple[str, ...] = KINDS,
                 inverse: bool = False) -> DataFrame:
    """``docs`` with its text rewritten, and ``pii`` added (array of struct<kind, was_valid>, in order of place).

    All other columns stay; an input column ``pii`` is replaced. A null text stays null with a null array; an
    empty text, or one without findings, stays byte for byte as it was with an empty array. Equal
    values of one kind and format get equal pseudonyms in every row; repeated rows give repeated results.
    ``inverse`` undoes every kind but email for the same key.
    """
    pattern = "|".join(f"(?:{PATTERNS[k]})" for k in kinds)  # one capturing group at most: the separator of cards
    text = F.col(f"`{text_col}`")

    def rewrite(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))

        def made(values: Column) -> Column:
            return F.transform(values, lambda v: let(_kind(v, kinds), lambda k: let(
                pseudonym(v, k, key, inverse, kinds), lambda p: F.struct(k.alias("kind"), p.alias("new"), (p != v).alias("was_valid")))))

        def joined(m: Column) -> Column:
            plain = F.split(t, pattern, -1)
            news = F.concat(F.transform(m, lambda x: x["new"]), F.array(F.lit("")))
            whole = F.array_join(F.zip_with(plain, news, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
            return F.struct(F.when(F.size(m) == 0, t).otherwise(whole).alias("text"), F.transform(
                m, lambda x: F.struct(x["kind"].alias("kind"), x["was_valid"].alias("was_valid"))).alias("pii"))

        return let(let(found, made), joined)

    quick = text.rlike("[0-9@]|[0-9a-fA-F]{32}")
    none = F.struct(text.alias("text"), F.when(text.isNotNull(), F.array().cast("array<struct<kind:string,was_valid:boolean>>")).alias("pii"))
    one = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "pii"],
                      F.when(quick, let(text, rewrite)).otherwise(none).alias("_p"))
    return one.select(*[F.col("_p")["text"].alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "pii"],
                      F.col("_p")["pii"].alias("pii"))
