"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame functions only.

One regular expression finds candidates (for card numbers it is made from
the text's valid ones, see :func:`card_numbers`); each is validated by its kind
(Luhn digit, octet range, calendar date, digit counts), and a valid one is
replaced by a keyed permutation of its own format: a card number by a card
number with a valid check digit and the same separators, a date by a date in the same
notation, an address by an address. The permutation is a Feistel network
whose round function is SHA-256 of key, kind, round and the other half. It is
a bijection of each format, so equal values get equal pseudonyms in all
documents, different values different ones, and no table of values is kept.

==========  =============================================  ==================================
kind        valid if                                       permuted
==========  =============================================  ==================================
card        13 to 19 digits, Luhn sum divisible by 10      all digits but the last, which is set
phone       8 to 15 digits, ``+`` or 3-3-4 groups          the digits after the country code
ssn         3-2-4 digits, no zero group, area valid        all nine digits, within valid ones
ipv4        four octets up to 255                          the 32 bits
email       a local part and a domain with a dot           letters and digits of the local part
date        a calendar date of the years 1800 to 2199      the day within these 400 years
==========  =============================================  ==================================

Everything else is left as it is, numbers that fail their validation too.
The work is per row: nothing is shuffled or collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
WALK = 64
FIRST_DAY = "1800-01-01"
# 400 years of the Gregorian calendar are 146,097 days, and 146,097 = 189 * 773.
DAYS_A, DAYS_B = 189, 773

# Fixed formats of the candidates, longest kinds first where they could overlap.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}"
_IP = r"(?<![0-9A-Za-z])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])"
_ISO = r"(?<![0-9A-Za-z])[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{2}(?![0-9A-Za-z])"
_DMY = r"(?<![0-9A-Za-z])[0-9]{2}(?:-[0-9]{2}-|/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{4}(?![0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])"
_PLUS = r"\+[0-9][0-9 ().-]{6,18}[0-9](?![0-9A-Za-z])"
_GROUPS = r"(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
# Numbers of other kinds that may stand beside a card number; a card number does not run into them.
_BESIDE = "|".join((_IP, _ISO, _DMY, _SSN, _GROUPS))
_CARD = rf"(?<![0-9A-Za-z])[0-9](?:[ -]?(?!{_BESIDE})[0-9]){{12,18}}(?![0-9A-Za-z])"
_BEFORE_CARD = "|".join((_EMAIL, _IP, _ISO, _DMY, _SSN, _GROUPS))
CANDIDATE = "|".join((_BEFORE_CARD, _CARD, _PLUS))
# From every border on, the digits in which card numbers that start there and their neighbours lie.
_REACH = r"(?<![0-9A-Za-z])(?=([0-9](?:[ -]?[0-9]){12,36}(?![0-9A-Za-z])(?:[./][0-9./-]{1,12})?))"
# Usual groupings of card numbers; they come before chance sums over parts of neighbouring numbers.
_USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}(?:(?: [0-9]{4}){3}(?: [0-9]{1,3})?|(?:-[0-9]{4}){3}(?:-[0-9]{1,3})?|[ -][0-9]{6}[ -][0-9]{4,5}))$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _pick(*cases: tuple[Column, Column], default: Column) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), half), 256)


def _number(digest: Column) -> Column:
    """The first 60 bits of a digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel_pair(key: str, kind: str, a: Column, b: Column, size_a: int, size_b: int) -> Column:
    """A keyed permutation of pairs of numbers below ``size_a`` and ``size_b``."""

    def turn(s: Column, r: Column) -> Column:
        on_a = F.pmod(s["a"] + F.pmod(_number(_digest(key, kind, r, s["b"].cast("string"))), F.lit(size_a)), F.lit(size_a))
        on_b = F.pmod(s["b"] + F.pmod(_number(_digest(key, kind, r, s["a"].cast("string"))), F.lit(size_b)), F.lit(size_b))
        even = r % 2 == 0
        return F.struct(
            F.when(even, on_a).otherwise(s["a"]).cast("long").alias("a"),
            F.when(even, s["b"]).otherwise(on_b).cast("long").alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _shift(text: Column, digest: Column) -> Column:
    """Every character moved on within its alphabet by four hex digits of the digest (repeated every 16)."""

    def one(i: Column) -> Column:
        step = F.conv(F.substr(digest, F.pmod(i - 1, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        ch = F.substr(text, i, F.lit(1))
        moved = [
            (F.instr(F.lit(a), ch) > 0, F.substr(F.lit(a), F.pmod(F.instr(F.lit(a), ch) - 1 + step, F.lit(len(a))) + 1, F.lit(1)))
            for a in _ALPHABETS
        ]
        return _pick(*moved, default=ch)

    return F.when(F.length(text) == 0, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")
    )


def _feistel_text(key: str, kind: str, text: Column) -> Column:
    """A keyed permutation of texts of equal length and character classes (digits, small, capital letters)."""

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        other = F.when(even, s["b"]).otherwise(s["a"])
        mine = F.when(even, s["a"]).otherwise(s["b"])
        moved = _let(_digest(key, kind, r, other), lambda d: _shift(mine, d))
        return F.struct(
            F.when(even, moved).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(moved).alias("b")
        )

    half = F.ceil(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1, F.length(text)).alias("b"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _let(done, lambda s: F.concat(s["a"], s["b"]))


def _walk(value: Column, step: Callable[[Column], Column], valid: Callable[[Column], Column]) -> Column:
    """Apply a permutation until its value is valid again: a permutation of the valid values.

    The chance of a longer way than ``WALK`` steps is below 1e-12 for the
    formats here; such a value raises an error, as its last step may be invalid.
    """

    def turn(s: Column, _: Column) -> Column:
        moved = F.when(s["done"], s["v"]).otherwise(step(s["v"]))
        return _let(moved, lambda v: F.struct(v.alias("v"), (s["done"] | valid(v)).alias("done")))

    start = F.struct(value.alias("v"), F.lit(False).alias("done"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, turn)
    error = F.raise_error(F.lit(f"no valid pseudonym within {WALK} steps; use another key"))
    return _let(last, lambda s: F.when(s["done"], s["v"]).otherwise(error))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, keep: str, chars: Column) -> Column:
    """``shape`` with its characters of class ``keep`` replaced in order by ``chars``; all others stay."""
    symbols = F.split(shape, "")
    here = F.transform(symbols, lambda c: c.rlike(f"^{keep}$").cast("int"))
    rank = lambda i: F.aggregate(F.slice(here, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x)
    return F.array_join(
        F.transform(
            symbols, lambda c, i: F.when(c.rlike(f"^{keep}$"), F.substr(chars, rank(i), F.lit(1))).otherwise(c)
        ),
        "",
    )


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string: every second digit from the right counts double, less 9 above 9."""

    def one(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + one(i))


def _card(m: Column, key: str) -> Column:
    def body(d: Column) -> Column:
        payload = _feistel_text(key, "card", F.substr(d, F.lit(1), F.length(d) - 1))
        number = _let(payload, lambda p: F.concat(p, F.pmod(10 - luhn_sum(F.concat(p, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _refill(m, "[0-9]", number)).otherwise(m)

    return _let(_digits(m), body)


def _phone(m: Column, key: str) -> Column:
    """The country code (digits after ``+`` up to a separator, else one digit) stays."""
    code = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[^0-9])|\+[0-9]|)", 1)
    rest = F.substr(m, F.length(code) + 1, F.length(m))
    moved = _let(rest, lambda r: F.concat(code, _refill(r, "[0-9]", _feistel_text(key, "phone", _digits(r)))))
    return F.when(F.length(_digits(m)).between(8, 15), moved).otherwise(m)


def _ssn_valid(d: Column) -> Column:
    return ~d.rlike("^(000|666|9)") & ~d.rlike("^...00") & ~d.rlike("0000$")


def _ssn(m: Column, key: str) -> Column:
    def body(d: Column) -> Column:
        moved = _walk(d, lambda v: _feistel_text(key, "ssn", v), _ssn_valid)
        return F.when(_ssn_valid(d), _refill(m, "[0-9]", moved)).otherwise(m)

    return _let(_digits(m), body)


def _ip(m: Column, key: str) -> Column:
    def body(octets: Column) -> Column:
        at = lambda i: F.get(octets, i)
        moved = _feistel_pair(key, "ipv4", at(0) * 256 + at(1), at(2) * 256 + at(3), 1 << 16, 1 << 16)
        part = lambda x: [F.shiftright(x, 8), x.bitwiseAND(F.lit(255))]
        text = _let(moved, lambda s: F.concat_ws(".", *(p.cast("string") for p in part(s["a"]) + part(s["b"]))))
        return F.when(F.forall(octets, lambda o: o <= 255), text).otherwise(m)

    return _let(F.transform(F.split(m, r"\."), lambda o: o.cast("int")), body)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    rest = F.substr(m, F.length(local) + 1, F.length(m))
    moved = _let(
        F.regexp_replace(local, "[^A-Za-z0-9]", ""),
        lambda x: _refill(local, "[A-Za-z0-9]", _feistel_text(key, "email", x)),
    )
    return F.concat(moved, rest)


def _day(text: Column, pattern: str) -> Column:
    """Days since the first day of the range; null if the text is not a date of the range in this notation."""
    day = F.datediff(F.try_to_timestamp(text, F.lit(pattern)).cast("date"), F.lit(FIRST_DAY).cast("date"))
    return F.when(day.between(0, DAYS_A * DAYS_B - 1), day)


def _move_day(day: Column, key: str) -> Column:
    split = _feistel_pair(key, "date", F.floor(day / DAYS_B), F.pmod(day, F.lit(DAYS_B)), DAYS_A, DAYS_B)
    return _let(split, lambda s: (s["a"] * DAYS_B + s["b"]).cast("int"))


def _as_text(day: Column, pattern: str) -> Column:
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), day), pattern)


def _date(m: Column, key: str) -> Column:
    out = m
    for sep in "-/.":
        for pattern in (f"yyyy{sep}MM{sep}dd", f"dd{sep}MM{sep}yyyy", f"MM{sep}dd{sep}yyyy"):
            if pattern[0] == "M":
                # Month first only where day first is no date; the pseudonym is again one of these.
                late = lambda d: F.dayofmonth(F.date_add(F.lit(FIRST_DAY).cast("date"), d)) > 12
                moved = lambda d: _walk(d, lambda v: _move_day(v, key), late)
            else:
                moved = lambda d: _move_day(d, key)
            value = _let(_day(m, pattern), lambda d: F.when(d.isNotNull(), _as_text(moved(d), pattern)))
            shape = "^[0-9]{4}" if pattern[0] == "y" else "^[0-9]{2}[^0-9]"
            test = m.rlike(shape) & m.contains(sep)
            if pattern[0] == "M":
                test = test & _day(m, f"dd{sep}MM{sep}yyyy").isNull()
            out = F.when(test, F.coalesce(value, m)).otherwise(out)
    return out


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate, or the candidate itself if it is not valid."""
    return _pick(
        (m.contains("@"), _email(m, key)),
        (m.startswith("+") | m.rlike(r"^\(|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"), _phone(m, key)),
        (m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), _ip(m, key)),
        (m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(m, key)),
        (m.rlike(r"^([0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})$"), _date(m, key)),
        (m.rlike(r"^[0-9]([ -]?[0-9]){12,18}$"), _card(m, key)),
        default=m,
    )


def card_numbers(text: Column) -> Column:
    """Distinct valid card numbers of a text that start and end at borders of digit groups, preferred ones first.

    Every border is tried with every number of digits, so a number is found
    beside others, too. Where numbers overlap, one of a usual grouping comes
    before others, then the longer one; a number into which a date or another
    number of fixed groups would run is none.
    """

    def windows(reach: Column) -> Column:
        sized = F.array(*(F.regexp_extract(reach, rf"^[0-9](?:[ -]?[0-9]){{{n}}}(?![0-9])", 0) for n in range(12, 19)))
        valid = lambda w: F.when(w != "", luhn_sum(_digits(w)) % 10 == 0).otherwise(F.lit(False))
        beside = F.regexp_instr(reach, F.lit(rf"(?<=[ -])(?:{_BESIDE})"))  # 0 if none
        clear = lambda w: (beside == 0) | (beside > F.length(w))
        return F.transform(
            F.filter(F.filter(sized, valid), clear),
            lambda w: F.struct((~w.rlike(_USUAL)).alias("odd"), (-F.length(w)).alias("size"), w.alias("w"), reach.alias("reach")),
        )

    def chosen(found: Column, usual: Column) -> Column:
        # A usual number that starts inside an odd one takes its digits.
        inside = lambda f: F.exists(
            usual,
            lambda u: (F.instr(f["reach"], u) > 0)
            & F.regexp_instr(f["reach"], F.concat(F.lit("(?<=[ -])"), u, F.lit("(?![0-9])"))).between(1, -f["size"]),
        )
        kept = F.filter(found, lambda f: ~f["odd"] | ~inside(f))
        return F.array_distinct(F.transform(F.array_sort(kept), lambda f: f["w"]))

    reaches = F.array_distinct(F.regexp_extract_all(text, F.lit(_REACH), F.lit(1)))
    found = F.flatten(F.transform(reaches, windows))
    usual = lambda x: F.array_distinct(F.transform(F.filter(x, lambda f: ~f["odd"]), lambda f: f["w"]))
    return _let(found, lambda x: _let(usual(x), lambda u: chosen(x, u)))


def _pattern(text: Column) -> Column:
    """The expression that finds what ``text`` holds: its valid card numbers, and candidates of the other kinds."""
    without = F.lit(f"{_BEFORE_CARD}|{_PLUS}")
    cards = lambda c: F.concat(
        F.lit(_BEFORE_CARD + r"|(?<![0-9A-Za-z])(?:"), F.array_join(c, "|"), F.lit(r")(?![0-9A-Za-z])|" + _PLUS)
    )
    some = _let(card_numbers(text), lambda c: F.when(F.size(c) > 0, cards(c)).otherwise(without))
    return F.when(text.rlike(_REACH), some).otherwise(without)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and the column ``n_replaced`` added (replaced if present).

    ``key`` selects the permutation; keep it secret. Null and empty texts stay
    as they are with 0 replacements. Rows are independent: repeated rows and
    null ids give equal results, an empty table an empty one. Other columns
    pass through.
    """
    body = F.col("text").cast("string")

    def parts(pattern: Column) -> Column:
        found = F.regexp_extract_all(body, pattern, F.lit(0))
        # A text is its pieces around the candidates, in turns.
        pieces = F.split(body, pattern, -1)
        swap = lambda f: F.transform(f, lambda m: pseudonym(m, key))
        return _let(found, lambda f: F.struct(pieces.alias("pieces"), f.alias("found"), swap(f).alias("swapped")))

    state = F.when(body.rlike("[0-9@]"), _let(_pattern(body), parts))
    names = [c for c in docs.columns if c != "n_replaced"]
    wide = docs.select(*(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(names)), state.alias("_pii"))
    text = F.array_join(
        F.flatten(F.zip_with("_pii.pieces", "_pii.swapped", lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), ""
    )
    changed = F.size(F.filter(F.zip_with("_pii.found", "_pii.swapped", lambda a, b: a != b), lambda x: x))
    at = names.index("text")
    return wide.select(
        *(
            (F.when(F.col("_pii").isNotNull(), text).otherwise(F.col(f"_keep_{i}")) if i == at else F.col(f"_keep_{i}")).alias(c)
            for i, c in enumerate(names)
        ),
        F.coalesce(F.when(F.col("_pii").isNotNull(), changed), F.lit(0)).alias("n_replaced"),
    )
