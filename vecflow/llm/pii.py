"""PII: format-preserving Feistel pseudonyms.

Personal values are found by pattern, validated, and replaced by a keyed permutation of all values of the same format.
The permutation is one-to-one, so equal values stay linked across documents and different ones stay apart; without the
key it can't be turned back.

======  ==========================================================  ==========================================
kind    found                                                       pseudonym
======  ==========================================================  ==========================================
email   local@domain                                                digits by digits, small letters by small ones,
                                                                    capitals by capitals; the domain stays
card    13-19 digits, plain or in groups of four; Luhn valid         digits by digits, the last one makes it Luhn valid
ip      IPv4 address                                                another IPv4 address
ssn     ddd-dd-dddd in the ranges that are issued                   another number of those ranges
phone   +1 and ten digits, (ddd) ddd-dddd, ddd-ddd-dddd, with an     another such number; of others the digits behind
        exchange of 200 or more; + and 8-15 digits, no 0 in front   the country code's first digit
date    yyyy-mm-dd, dd/mm/yyyy or mm/dd/yyyy, dd.mm.yyyy of the      another date of those years in the same format
        years 1800-2199
======  ==========================================================  ==========================================

Every value is a number below a product of two sizes and goes through an alternating Feistel network of ROUNDS rounds on
its two residues: digit strings by their halves, addresses 65,536 x 65,536, social security numbers 898 x 989,901, ten
digit phones 100,000 x 80,000, dates 189 x 773 (the 146,097 days of 400 years). Local parts of mail addresses go in pieces
of PIECE characters, each a number of mixed radix (10 for a digit, 26 for a letter, 1 for other characters); the classes
of a piece's characters, its place and the piece before it enter the round function, so the whole is one-to-one within
its format, case included. The round function is SHA-256 of key, kind, round and the other half. A date written with
slashes is read as dd/mm where that is valid, else as mm/dd. Matches that don't validate stay as they are. Area codes of
phones are not checked, so that numbers with invented ones don't stay.

DataFrame functions only, one pass without a shuffle, in time that grows with the text: a text is matched once, with
possessive patterns, and all values are put back at once. Null texts stay null, empty ones empty. All rows and columns
are kept in place, whatever their names; columns named as the counts are replaced by them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

ROUNDS = 8
#: Characters of a mail address in one Feistel network: their number, 26**12 at most, fits 64 bits.
PIECE = 12
DAYS = (189, 773)
SSN = (898, 99 * 9999)
PHONE = (100_000, 80_000)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Patterns in the order in which they are tried at a place: fixed values.
PATTERNS = {
    # possessive throughout: labels up to the first that starts with two letters, then all further ones
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+\.[A-Za-z]{2}[A-Za-z0-9-]*+(?:\.[A-Za-z0-9-]++)*+",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:1[89]|2[01])[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:1[89]|2[01])[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:1[89]|2[01])[0-9]{2})(?![0-9A-Za-z/-])",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z+])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|\+[0-9]{8,15})(?![0-9A-Za-z])",
}
#: All kinds but the first start with a digit, + or (: other places are passed at once.
NUMBERS = "(?=[0-9+(])(?:" + "|".join(p for k, p in PATTERNS.items() if k != "email") + ")"
ANY = PATTERNS["email"] + "|" + NUMBERS
#: A character that no pattern matches or looks at, and what follows it where a match starts or ends, or where a text
#: holds the character itself.
MARK, EDGE, OWN = "\x01", "\x02", "\x03"
KINDS = ("email", "card", "ip", "ssn", "phone", "date")


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of whole numbers (``/`` gives a double, too coarse for 18 digits)."""
    return F.call_function("div", x, y)


class Feistel:
    """Keyed permutations as Column expressions."""

    def __init__(self, key: str, rounds: int = ROUNDS):
        self.key, self.rounds = key, rounds

    def _f(self, head: Column, *parts: Column) -> Column:
        """60 bits of SHA-256, as a number."""
        digest = F.sha2(F.concat_ws("|", F.lit(self.key), head, *(p.cast("string") for p in parts)), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def pair(self, left: Column, right: Column, a, b, kind: str, *tweak: Column) -> Column:
        """A permutation of pairs (l, r), l below a and r below b, as a struct."""

        def step(s: Column, i: Column) -> Column:
            even = i % 2 == 0
            left = F.when(even, F.pmod(s["l"] + self._f(s["t"], i, s["r"]), s["a"])).otherwise(s["l"])
            right = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + self._f(s["t"], i, s["l"]), s["b"]))
            return F.struct(left.alias("l"), right.alias("r"), s["a"].alias("a"), s["b"].alias("b"), s["t"].alias("t"))

        # sizes and tweak are part of the state, so that they are worked out once
        sizes = (F.lit(n) if isinstance(n, int) else n for n in (a, b))
        start = F.struct(*(c.cast("long").alias(n) for c, n in zip((left, right, *sizes), "lrab", strict=True)), F.concat_ws("|", F.lit(kind), *(x.cast("string") for x in tweak)).alias("t"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(self.rounds - 1)), start, step)

    def residues(self, x: Column, a: int, b: int, kind: str) -> Column:
        """A permutation of 0 .. a * b - 1."""
        both = self.pair(_div(x, F.lit(b)), F.pmod(x, F.lit(b)), a, b, kind)
        return both["l"] * b + both["r"]

    def digits(self, s: Column, kind: str) -> Column:
        """A permutation of the digit strings of s's length (18 at most): its halves are the two residues."""
        n = F.length(s)
        m = F.floor(n / 2).cast("int")
        size = [F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long") for k in (m, n - m)]
        both = self.pair(F.coalesce(F.substr(s, F.lit(1), m).try_cast("long"), F.lit(0)), F.coalesce(F.substr(s, m + 1).try_cast("long"), F.lit(0)), *size, kind, n)
        return F.concat(*(F.when(k == 0, F.lit("")).otherwise(F.lpad(both[c].cast("string"), k, F.lit("0"))) for c, k in (("l", m), ("r", n - m))))

    def _piece(self, s: Column, kind: str, *tweak: Column) -> Column:
        """A permutation of the strings of s's format (PIECE characters at most)."""
        mask = F.translate(s, _ALL, _CLASSES)
        half = F.floor(F.length(s) / 2).cast("int")
        chars = [F.filter(F.split(x, ""), lambda c: c != "") for x in (F.substr(s, F.lit(1), half), F.substr(s, half + 1))]
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        number = [F.aggregate(c, zero, lambda n, x: n * _radix(x) + _value(x)) for c in chars]
        size = [F.aggregate(c, one, lambda n, x: n * _radix(x)) for c in chars]
        both = self.pair(*number, *size, kind, mask, *tweak)

        def write(n: Column, c: Column) -> Column:
            def step(s: Column, x: Column) -> Column:
                rest = F.pmod(s["n"], _radix(x))
                # the least digit belongs to the last character
                return F.struct(_div(s["n"], _radix(x)).alias("n"), F.concat(_char(x, rest), s["out"]).alias("out"))

            return F.aggregate(F.reverse(c), F.struct(n.alias("n"), F.lit("").alias("out")), step)["out"]

        return F.concat(write(both["l"], chars[0]), write(both["r"], chars[1]))

    def string(self, s: Column, kind: str) -> Column:
        """A permutation of the strings of s's format: the classes of its characters in a row (digit, small letter,
        capital, or a character that stays)."""
        pieces = F.regexp_extract_all(s, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
        before = F.concat(F.array(F.lit("")), F.slice(pieces, 1, F.size(pieces) - 1))
        both = F.zip_with(pieces, before, lambda p, b: F.struct(p.alias("p"), b.alias("b")))
        return F.when(s == "", s).otherwise(F.array_join(F.transform(both, lambda x, i: self._piece(x["p"], kind, i, x["b"])), ""))


_DIGITS, _SMALL, _CAPITALS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALL, _CLASSES = _DIGITS + _SMALL + _CAPITALS, "9" * 10 + "a" * 26 + "A" * 26


def _first(c: Column) -> Column:
    """Code of a class's first character, null for other characters."""
    return F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65)


def _radix(c: Column) -> Column:
    return F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), 26).otherwise(1).cast("long")


def _value(c: Column) -> Column:
    return F.coalesce(F.ascii(c) - _first(c), F.lit(0)).cast("long")


def _char(c: Column, value: Column) -> Column:
    return F.coalesce(F.char(_first(c) + value), c)


def _only(s: Column, not_kept: str) -> Column:
    return F.regexp_replace(s, not_kept, "")


def _refill(shape: Column, digits: Column) -> Column:
    """shape (of a few characters) with its digits replaced, one by one, by those given."""

    def char(i: Column) -> Column:
        c = F.substr(shape, i, F.lit(1))
        so_far = F.substr(shape, F.lit(1), i)
        return F.when(c.between("0", "9"), F.substr(digits, F.length(_only(so_far, "[^0-9]")), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), char), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 1
        return F.when(~twice, d).when(d >= 5, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, x: a + x)


def _card(m: Column, f: Feistel) -> Column:
    digits = _only(m, "[^0-9]")
    body = f.digits(F.substr(digits, F.lit(1), F.length(digits) - 1), "card")
    check = F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return _refill(m, F.concat(body, check))


def _ip(m: Column, f: Feistel) -> Column:
    o = F.split(m, r"\.")
    x = F.aggregate(o, F.lit(0).cast("long"), lambda a, b: a * 256 + b.cast("long"))
    y = f.residues(x, 65536, 65536, "ip")
    return F.concat_ws(".", *(F.pmod(F.floor(y / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)))


def _ssn_valid(m: Column) -> Column:
    return m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _ssn(m: Column, f: Feistel) -> Column:
    area, group, serial = (F.regexp_extract(m, r"^([0-9]+)-([0-9]+)-([0-9]+)$", i).cast("long") for i in (1, 2, 3))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    y = f.residues((place * 99 + group - 1) * 9999 + serial - 1, *SSN, "ssn")
    a = F.floor(y / (99 * 9999))
    new_area = F.when(a >= 665, a + 2).otherwise(a + 1)
    return F.concat_ws("-", F.lpad(new_area.cast("string"), 3, "0"), F.lpad((F.floor(y / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((y % 9999 + 1).cast("string"), 4, "0"))


#: Phones of ten digits behind an optional +1; all others are + and digits.
_TEN = r"^(?:\+1[^0-9]*)?(?:[^0-9+]*[0-9]){10}$"


def _ten(m: Column) -> Column:
    """The last ten digits."""
    return F.regexp_extract(_only(m, "[^0-9]"), "([0-9]{10})$", 1)


def _phone_valid(m: Column) -> Column:
    return F.when(m.rlike(_TEN), F.substr(_ten(m), F.lit(4), F.lit(1)) >= "2").otherwise(~m.rlike(r"^\+0"))


def _phone(m: Column, f: Feistel) -> Column:
    ten = _ten(m)
    area, exchange, line = (F.substr(ten, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (4, 3), (7, 4)))
    y = f.residues((area * 800 + exchange - 200) * 10_000 + line, *PHONE, "phone")
    upper = _div(y, F.lit(10_000))
    new = F.concat(F.lpad(_div(upper, F.lit(800)).cast("string"), 3, "0"), (upper % 800 + 200).cast("string"), F.lpad((y % 10_000).cast("string"), 4, "0"))
    ten_new = _refill(m, F.concat(F.when(m.startswith("+"), "1").otherwise(""), new))
    other = F.concat(F.substr(m, F.lit(1), F.lit(2)), f.digits(F.substr(m, F.lit(3)), "phone+"))
    return F.when(m.rlike(_TEN), ten_new).otherwise(other)


#: Pattern of the text, format of the date.
_FORMATS = ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"^[0-9]{2}\.", "dd.MM.yyyy"), (r"^[0-9]{2}/", "dd/MM/yyyy"), (r"^[0-9]{2}/", "MM/dd/yyyy"))


def _read(m: Column, shape: str, fmt: str) -> Column:
    return F.when(m.rlike(shape), F.try_to_timestamp(m, F.lit(fmt)).cast("date"))


def _day(m: Column) -> Column:
    """The date that a text means, null where it is none."""
    return F.coalesce(*(_read(m, *x) for x in _FORMATS))


def _date(m: Column, f: Feistel) -> Column:
    start = F.lit("1800-01-01").cast("date")
    new = F.date_add(start, f.residues(F.datediff(_day(m), start).cast("long"), *DAYS, "date").cast("int"))
    out = F.lit(None).cast("string")
    for shape, fmt in reversed(_FORMATS):
        out = F.when(_read(m, shape, fmt).isNotNull(), F.date_format(new, fmt)).otherwise(out)
    return out


def _email(m: Column, f: Feistel) -> Column:
    local = F.regexp_extract(m, "^([^@]*+)@", 1)
    return F.concat(f.string(local, "email"), F.substr(m, F.length(local) + 1))


def kind_of(m: Column) -> Column:
    """The kind of one match; null where it doesn't validate."""
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    return (
        F.when(F.locate("@", m) > 0, "email")
        .when(whole["date"], F.when(_day(m).isNotNull(), "date"))
        .when(whole["ip"], "ip")
        .when(whole["ssn"], F.when(_ssn_valid(m), "ssn"))
        .when(whole["card"], F.when(luhn_sum(_only(m, "[^0-9]")) % 10 == 0, "card"))
        .otherwise(F.when(_phone_valid(m), "phone"))
    )


def pseudonym(m: Column, kind: Column, f: Feistel) -> Column:
    """What takes the place of one match of a kind."""
    by_kind = {"email": _email, "card": _card, "ip": _ip, "ssn": _ssn, "phone": _phone, "date": _date}
    out = m
    for k, fn in by_kind.items():
        out = F.when(kind == k, fn(m, f)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counts: bool = True) -> DataFrame:
    """docs with personal values of the text column replaced, and with counts also columns n_email, n_card, n_ip, n_ssn,
    n_phone, n_date (in place of columns of these names)."""
    f = Feistel(key)
    t = F.col(text)
    # marks around the matches, by which the text is split into gaps and (every second one) matches
    own = F.when(F.contains(t, F.lit(MARK)), F.replace(t, F.lit(MARK), F.lit(MARK + OWN))).otherwise(t)
    mark = lambda pattern: F.regexp_replace(own, pattern, f"{MARK}{EDGE}$0{MARK}{EDGE}")
    marked = F.when(F.contains(t, F.lit("@")), mark(ANY)).when(t.rlike("[0-9]"), mark(NUMBERS))
    found = F.when(F.contains(marked, F.lit(MARK + EDGE)), F.split(marked, MARK + EDGE, -1))

    def part(p: Column, i: Column) -> Column:
        kind = F.when(i % 2 == 1, kind_of(p))
        return F.struct(kind.alias("kind"), pseudonym(p, kind, f).alias("text"))

    name = f"pii_{uuid.uuid4().hex}"
    d = docs.withColumn(name, F.transform(found, part))
    parts = F.col(name)
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    new = F.when(F.contains(joined, F.lit(MARK)), F.replace(joined, F.lit(MARK + OWN), F.lit(MARK))).otherwise(joined)

    def count(kind: str) -> Column:
        return F.when(parts.isNull(), 0).otherwise(F.size(F.filter(parts, lambda p: p["kind"] == kind))).cast("long")

    added = {f"n_{k}": count(k) for k in KINDS} if counts else {}
    return d.withColumns({text: F.when(parts.isNull(), t).otherwise(new), **added}).drop(name)


#: Key of the registered query; a real run brings its own secret.
DEMO_KEY = "a key for demonstrations"


def op4_pii(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return pseudonymise(docs, DEMO_KEY)
