"""Secret scans: base patterns, and spans of high entropy found by a sliding window.

Base spans, leftmost and non-overlapping for each kind: ``assign`` (a keyword, ``:`` or ``=``, and a value of 12 or
more characters), ``access`` (AKIA and capitals or digits, 18 or more characters in all), ``hex`` (16 or more lower
hex digits).

The method adds spans of kind ``entropy``: candidates are runs of base64 or hex characters of MIN_CANDIDATE or more.
A window of WINDOW characters slides over each. Counts of the alphabet's characters are kept as fields of FIELD bits in
a few numbers; one count goes up as a character enters, another goes down as one leaves, and the window's sum of
c * log2(c), in whole units of 1 / UNIT, is kept by those two changes alone. Its Shannon entropy is log2(WINDOW) - sum / WINDOW. A candidate is a secret if its highest window reaches the threshold of its character
class (THRESHOLDS). The allow-list suppresses candidates that are no secrets whatever their entropy: words of letters
alone, numbers, UUIDs, paths and words joined by hyphens, and texts marked as examples. Entropy spans that a base span
overlaps are not added; base spans always stay.

Offsets count code points, the end is exclusive. DataFrame functions only; the work is one pass without a shuffle, and
grows in proportion to a text and its matches: running values are folded in blocks of BLOCK, and overlaps are found in
one sweep over all spans in order.
Null and empty texts have no spans. Repeated rows give repeated results; extra columns are left behind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

#: Base patterns: fixed values. Runs below the length can't start a longer one, so the length is part of the last two.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12

MIN_CANDIDATE = 20
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Least entropy in bits a character of the best window, by the class of the candidate's characters.
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "base64": 3.7}
#: Candidates that are suppressed.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))*[-_/=+]*$",
    r"(?i)example|placeholder|changeme|xxxx|lorem",
)
#: The same pattern for Java, whose repeated groups must be possessive not to exhaust the stack; classes are disjoint.
_POSSESSIVE = {ALLOWED[3]: r"^/?(?:[A-Za-z]++|[0-9]++)(?:[-_/=+]++(?:[A-Za-z]++|[0-9]++))*+[-_/=+]*+$"}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits of a count, which is at most WINDOW, and counts in one number of 64 bits.
FIELD, FIELDS = 5, 12
UNIT = 1 << 40
#: Entries of one fold that builds an array, each of which copies what is there.
BLOCK = 128
_ORDER = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}


def _let(x: Column, body) -> Column:
    """body(x), with x worked out once."""
    return F.element_at(F.transform(F.array(x), body), 1)


def _running(values: Column, op, start: Column) -> Column:
    """Running values of an array that isn't empty: op of start and the first, of that and the second, and so on."""

    def each(a: Column) -> Column:
        last = F.floor((F.size(a) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * BLOCK + 1, F.lit(BLOCK)))

    def fold(a: Column, first: Column) -> Column:
        """(running values, the last of them)."""
        none = F.slice(F.array(first), 1, 0)

        def step(acc: Column, x: Column) -> Column:
            return _let(op(acc["now"], x), lambda n: F.struct(n.alias("now"), F.concat(acc["out"], F.array(n)).alias("out")))

        return F.aggregate(a, F.struct(first.alias("now"), none.alias("out")), step)["out"]

    def blocks(of: Column) -> Column:
        whole = F.transform(of, lambda b: F.aggregate(b, start, op))
        before = F.concat(F.array(start), fold(whole, start))
        return F.flatten(F.zip_with(of, F.slice(before, 1, F.size(of)), fold))

    return _let(values, lambda a: _let(each(a), blocks))


def _spans(text: Column, pattern: str, kind: str, fits=None) -> Column:
    """array<struct<start, ord, kind, stop>> of a pattern's matches (that fit): gaps and matches alternate."""
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,stop:int>>")

    def located(v: Column) -> Column:
        steps = F.zip_with(F.slice(v["gaps"], 1, F.size(v["m"])), v["m"], lambda g, m: g + F.length(m))
        stops = _running(steps, lambda a, x: a + x, F.lit(0))
        both = F.zip_with(stops, v["m"], lambda stop, m: F.struct(stop.alias("stop"), m.alias("m")))
        kept = both if fits is None else F.filter(both, lambda x: fits(x["m"]))
        return F.transform(kept, lambda x: F.struct((x["stop"] - F.length(x["m"])).alias("start"), F.lit(_ORDER[kind]).alias("ord"), F.lit(kind).alias("kind"), x["stop"].alias("stop")))

    found = F.struct(F.transform(F.split(text, pattern, -1), F.length).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(text.rlike(pattern), _let(found, located)).otherwise(empty)


def _g(c: Column) -> Column:
    """c * log2(c) of a count up to WINDOW, in whole units of 1 / UNIT, by table."""
    return F.element_at(F.array(*(F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(WINDOW + 1))), (c + 1).cast("int"))


def best_entropy(candidate: Column) -> Column:
    """The highest entropy of a window over the candidate (at least WINDOW characters of ALPHABET)."""
    words = [f"w{k}" for k in range(-(-len(ALPHABET) // FIELDS))]

    def changed(s: Column, code: Column, by: int) -> Column:
        """The state after the count of a character goes up or down by one."""
        at, shift = F.floor(code / FIELDS).cast("int"), (code % FIELDS * FIELD).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
        n = F.call_function("shiftright", F.element_at(F.array(*(s[w] for w in words)), at + 1), shift).bitwiseAND(F.lit(31).cast("long"))
        counts = (F.when(at == k, s[w] + one * by).otherwise(s[w]).alias(w) for k, w in enumerate(words))
        return F.struct(*counts, (s["sum"] - _g(n) + _g(n + by)).alias("sum"), s["low"].alias("low"))

    def slid(codes: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            left = F.when(i > WINDOW, changed(s, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1))), -1)).otherwise(s)
            entered = _let(left, lambda x: changed(x, F.element_at(codes, i), 1))
            return _let(entered, lambda x: F.struct(*(x[w].alias(w) for w in words), x["sum"].alias("sum"), F.when(i >= WINDOW, F.least(x["low"], x["sum"])).otherwise(x["low"]).alias("low")))

        zero = F.lit(0).cast("long")
        start = F.struct(*(zero.alias(w) for w in words), zero.alias("sum"), F.lit(2**62).alias("low"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step)["low"]

    chars = F.regexp_extract_all(candidate, F.lit("(?s)."), F.lit(0))
    low = _let(F.transform(chars, lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1), slid)
    return F.lit(math.log2(WINDOW)) - low / F.lit(float(WINDOW * UNIT))


def is_secret(candidate: Column) -> Column:
    """Not on the allow-list, and a window of the entropy its class asks for."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(_POSSESSIVE.get(pattern, pattern))
    least = F.when(candidate.rlike("^[0-9a-fA-F]+$"), THRESHOLDS["hex"]).when(candidate.rlike("^[A-Za-z0-9]+$"), THRESHOLDS["alnum"]).otherwise(THRESHOLDS["base64"])
    return F.when(allowed, False).otherwise(best_entropy(candidate) >= least)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _apart(base: Column, more: Column) -> Column:
    """All of base, and those of more that overlap none of them, in order."""

    def swept(all_: Column) -> Column:
        far = F.lit(2**31 - 1)
        reach = _running(F.transform(all_, lambda s: F.when(s["ord"] < 3, s["stop"]).otherwise(0)), lambda a, x: F.greatest(a, x), F.lit(0))
        ahead = F.reverse(_running(F.reverse(F.transform(all_, lambda s: F.when(s["ord"] < 3, s["start"]).otherwise(far))), lambda a, x: F.least(a, x), far))
        seen = F.zip_with(F.zip_with(all_, reach, lambda s, r: F.struct(s.alias("s"), r.alias("r"))), ahead, lambda x, a: F.struct(x["s"].alias("s"), ((x["s"]["ord"] < 3) | (x["r"] <= x["s"]["start"]) & (a >= x["s"]["stop"])).alias("stays")))
        return F.transform(F.filter(seen, lambda x: x["stays"]), lambda x: x["s"])

    return F.when(F.size(more) == 0, base).otherwise(_let(F.array_sort(F.concat(base, more)), swept))


def scan(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) with n_assign, n_access, n_hex, n_entropy, base_sha256 and spans, one row per row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", text.alias("text"))
    t = F.col("text")
    assign = _spans(t, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE)
    d = d.select("doc_id", assign.alias("a"), _spans(t, ACCESS, "access").alias("k"), _spans(t, HEX, "hex").alias("h"), _spans(t, CANDIDATE, "entropy", is_secret).alias("e"))
    d = d.select("doc_id", "a", "k", "h", "e", F.array_sort(F.concat("a", "k", "h")).alias("base"))
    d = d.select("doc_id", "a", "k", "h", "base", _apart(F.col("base"), F.col("e")).alias("all"))
    return d.select(
        "doc_id", *(F.size(c).cast("long").alias(n) for c, n in (("a", "n_assign"), ("k", "n_access"), ("h", "n_hex"))),
        (F.size("all") - F.size("base")).cast("long").alias("n_entropy"), F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("all")).alias("spans"),
    )


def op6_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


# the same in SQL: matches are found by extracting them and splitting at them; entropy is worked out for every window

_DUCK_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_DUCK_VALUE = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _found(kind: str, pattern: str) -> str:
    """SELECT doc_id, kind, start, stop, m of a pattern's matches."""
    p = _quoted(pattern)
    gaps = f"list_transform(regexp_split_to_array(t, {p}), lambda x: length(x))"
    m = f"regexp_extract_all(t, {p})"
    return f"""SELECT doc_id, '{kind}' AS kind, CAST(list_sum(g[1:i]) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start, ms[i] AS m
  FROM (SELECT doc_id, g, ms, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, {gaps} AS g, {m} AS ms FROM d WHERE regexp_matches(t, {p})))"""


def _sql() -> str:
    allowed = " OR ".join(f"regexp_matches(m, {_quoted(a)})" for a in ALLOWED)
    w = WINDOW
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT *, start + length(m) AS stop, 0 AS o FROM ({_found("assign", _DUCK_ASSIGN)}) WHERE length(regexp_extract(m, {_quoted(_DUCK_VALUE)}, 1)) >= {ASSIGN_VALUE}
  UNION ALL SELECT *, start + length(m), 1 FROM ({_found("access", ACCESS)})
  UNION ALL SELECT *, start + length(m), 2 FROM ({_found("hex", HEX)})
), cand AS (SELECT *, start + length(m) AS stop, row_number() OVER () AS c FROM ({_found("entropy", CANDIDATE)}) WHERE NOT ({allowed})),
wins AS (SELECT c, m, i, substring(m, i, {w}) AS w FROM (SELECT c, m, unnest(range(1, length(m) - {w} + 2)) AS i FROM cand)),
chars AS (SELECT c, i, ch, count(*) AS n FROM (SELECT c, i, substring(w, k, 1) AS ch FROM wins, range(1, {w + 1}) r(k)) GROUP BY ALL),
best AS (SELECT c, max(h) AS h FROM (SELECT c, i, log2({w}) - sum(n * log2(n)) / {w} AS h FROM chars GROUP BY c, i) GROUP BY c),
ent AS (
  SELECT doc_id, kind, start, m, stop, 3 AS o FROM cand JOIN best USING (c)
  WHERE h >= CASE WHEN regexp_matches(m, '^[0-9a-fA-F]+$') THEN {THRESHOLDS["hex"]} WHEN regexp_matches(m, '^[A-Za-z0-9]+$') THEN {THRESHOLDS["alnum"]} ELSE {THRESHOLDS["base64"]} END
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = cand.doc_id AND b.start < cand.stop AND cand.start < b.stop)
), everything AS (SELECT * FROM base UNION ALL SELECT * FROM ent),
agg AS (
  SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex, count(*) FILTER (o = 3) AS n_entropy,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS b, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS s
  FROM everything GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""


OP6_SQL = _sql()
