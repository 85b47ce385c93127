"""The Jaccard join, its components, pseudonyms and the pipeline against brute force."""

import datetime
import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.rows import documents, frame, text
from tests.llm.test_text_operators import words
from vecflow.llm import jaccard_join as jj
from vecflow.llm import pii


def shingles(t):
    w = words(t)
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def slow_join(rows, threshold=0.8):
    """(doc_id, class_id, n_links, n_copies, n_shingles) of rows (doc_id, text)."""
    sets: dict = {}
    for i, t in rows:
        s = shingles(t)
        if s and i is not None:
            sets.setdefault(s, []).append(i)
    reps = {s: min(ids) for s, ids in sets.items()}
    root, links = {s: s for s in sets}, Counter()

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    all_ = list(sets)
    for a in range(len(all_)):
        for b in range(a + 1, len(all_)):
            x, y = all_[a], all_[b]
            if len(x & y) >= threshold * len(x | y):
                links[x] += 1
                links[y] += 1
                p, q = find(x), find(y)
                if p is not q:
                    lo, hi = sorted((p, q), key=lambda s: reps[s])
                    root[hi] = lo
    out = Counter()
    for i, t in rows:
        s = shingles(t)
        if s and i is not None:
            out[i, reps[find(s)], links[s], len(sets[s]), len(s)] += 1
        else:
            out[i, i, 0, 1, len(s)] += 1
    return out


def group(rng, n, edits, words_=80):
    """n texts around one."""
    base = text(rng, words_).split()
    out = []
    for _ in range(n):
        t = list(base)
        for p in rng.choice(words_, int(rng.integers(0, edits + 1)), replace=False):
            t[p] = text(rng, 1)
        out.append(" ".join(t))
    return out


def case():
    rng = np.random.default_rng(11)
    texts = [t for _ in range(6) for t in group(rng, 8, 3)] + group(rng, 40, 2)
    common_line = text(rng, 12)
    texts += [text(rng, 30) + " " + common_line for _ in range(30)]
    return [(i, t) for i, t, _ in documents()] + [(1000 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [4096, 8])
def test_join(spark, small):
    rows = case()
    got = jj.join(frame(spark, [(i, t, None) for i, t in rows]), small=small, recall=1 - 1e-9)
    assert Counter(tuple(r) for r in got.collect()) == slow_join(rows)


def test_recall_of_split_buckets(spark):
    """Buckets larger than ``small`` that each split about halves, at production recall: pairs from 0.8 on, sets within sets."""
    rng = np.random.default_rng(21)
    lines = [text(rng, 12) for _ in range(40)]
    rows = []
    for _ in range(40):
        mine = " ".join(lines[i] for i in sorted(rng.choice(40, 20, replace=False))).split()
        rows += [(len(rows) + i, " ".join(mine[:n])) for i, n in enumerate((240, 216, 194))]
    got = jj.join(frame(spark, [(i, t, None) for i, t in rows]), small=3)
    assert Counter(tuple(r) for r in got.collect()) == slow_join(rows)


def test_bucket_that_does_not_shrink(spark):
    """More than SMALL near copies at the registered settings: compared in pairs of blocks, every link counted once."""
    rng = np.random.default_rng(31)
    base, n = text(rng, 120).split(), jj.SMALL + 60
    rows = []
    for i in range(n):
        own = list(base)
        own[int(rng.integers(len(own)))] = f"only{i}"
        rows.append((i, " ".join(own), None))
    got = jj.join(frame(spark, [*rows, (n, text(rng, 50), None)])).collect()
    assert Counter((r.class_id, r.n_links, r.n_copies) for r in got) == {(0, n - 1, 1): n, (n, 0, 1): 1}


def test_runs():
    """The worst pair at the threshold (a set within another) is missed with 1 - recall at most."""
    none = np.exp(-jj.RATE * jj.THRESHOLD)
    assert none ** jj.runs_for() <= 1 - jj.RECALL
    q = 0
    for _ in range(jj.DEPTH):
        q = np.exp(-jj.RATE * jj.THRESHOLD * (1 - q))
    assert none ** jj.runs_for() + q ** (jj.runs_for() + jj.more_runs_for()) <= 1 - jj.RECALL


def slow_classes(rows, threshold=0.8):
    """Lists of the rows (doc_id, text) of each class; rows without words or id are classes of their own."""
    sets: dict = {}
    for i, t in rows:
        if i is not None and (s := shingles(t)):
            sets.setdefault(s, []).append((i, t))
    group = {s: {s} for s in sets}
    for a in sets:
        for b in sets:
            if group[a] is not group[b] and len(a & b) >= threshold * len(a | b):
                group[a] |= group[b]
                for s in group[b]:
                    group[s] = group[a]
    return [[r for s in g for r in sets[s]] for g in {id(g): g for g in group.values()}.values()] + [[(i, t)] for i, t in rows if i is None or not shingles(t)]


def check_one_of_each(spark, rows):
    docs = frame(spark, [(i, t, None) for i, t in rows])
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    left = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
    for own in slow_classes(rows):
        mine = [r for r in own if left[r]]
        assert len(mine) >= 1 and mine[0][0] == min((i for i, _ in own if i is not None), default=None)
        left.subtract(mine[:1])
    assert not +left, "more than one row of a class stayed"


def test_one_of_each(spark):
    check_one_of_each(spark, case())


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    rng = np.random.default_rng(12)
    a, b, c = (text(rng, 60) for _ in range(3))
    check_one_of_each(spark, [(1, a), (5, a), (5, b)])
    check_one_of_each(spark, [(1, a), (1, b), (5, a)])
    near = a.split()
    near[-1] = "changed"
    check_one_of_each(spark, [(1, a), (1, " ".join(near)), (5, a), (5, b), (5, b), (5, b.upper()), (3, c), (7, None), (7, None), (7, c), (None, c), (None, c), (8, "?!"), (8, b)])


def test_empty_join(spark):
    assert jj.join(frame(spark, [])).count() == 0 and jj.one_of_each(frame(spark, [])).count() == 0


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 200), (300, 200), (7, 7)]
    got = {r.id: r.root for r in jj.components(spark.createDataFrame(chain, "id long, root long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {200: 100, 300: 100}


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(40)]
    assert jj.overlaps(sets).astype(int).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]


# pseudonyms


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


class Twin:
    """The same Feistel networks in plain Python, one value at a time."""

    def __init__(self, key):
        self.key = key

    def f(self, *parts):
        return int(hashlib.sha256("|".join(map(str, (self.key, *parts))).encode()).hexdigest()[:15], 16)

    def pair(self, left, right, a, b, *head):
        for i in range(pii.ROUNDS):
            if i % 2 == 0:
                left = (left + self.f(*head, i, right)) % a
            else:
                right = (right + self.f(*head, i, left)) % b
        return left, right

    def residues(self, x, a, b, kind):
        left, right = self.pair(x // b, x % b, a, b, kind)
        return left * b + right

    def digits(self, s, kind):
        m = len(s) // 2
        left, right = self.pair(int(s[:m] or 0), int(s[m:] or 0), 10**m, 10 ** (len(s) - m), kind, len(s))
        return (str(left).zfill(m) if m else "") + str(right).zfill(len(s) - m)

    def string(self, s, kind):
        classes = [("0123456789", "9"), ("abcdefghijklmnopqrstuvwxyz", "a"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")]
        out, before = "", ""
        for i, at in enumerate(range(0, len(s), pii.PIECE)):
            p = s[at : at + pii.PIECE]
            sets = [next((cs for cs, _ in classes if c in cs), c) for c in p]
            mask = "".join(next((m for cs, m in classes if c in cs), c) for c in p)
            halves, h = [], len(p) // 2
            for x, y in ((p[:h], sets[:h]), (p[h:], sets[h:])):
                n, size = 0, 1
                for c, cs in zip(x, y, strict=True):
                    n, size = n * len(cs) + cs.index(c), size * len(cs)
                halves.append((n, size))
            done = self.pair(halves[0][0], halves[1][0], halves[0][1], halves[1][1], kind, mask, i, before)
            for n, y in zip(done, (sets[:h], sets[h:]), strict=True):
                x = ""
                for cs in reversed(y):
                    x, n = cs[n % len(cs)] + x, n // len(cs)
                out += x
            before = p
        return out


def refilled(shape, digits):
    d = iter(digits)
    return "".join(next(d) if c.isdigit() else c for c in shape)


def slow_pseudonym(m, twin):
    """(kind, replacement) of one match, (None, m) where it doesn't validate."""
    only = re.sub("[^0-9]", "", m)
    is_ = lambda k: re.fullmatch(pii.PATTERNS[k], m)
    if "@" in m:
        local, _, domain = m.partition("@")
        return "email", twin.string(local, "email") + "@" + domain
    if is_("date"):
        for shape, fmt in (("....-..-..", "%Y-%m-%d"), ("..[.].*", "%d.%m.%Y"), ("../.*", "%d/%m/%Y"), ("../.*", "%m/%d/%Y")):
            try:
                day = datetime.datetime.strptime(m, fmt).date() if re.fullmatch(shape, m) else None
            except ValueError:
                day = None
            if day:
                start = datetime.date(1800, 1, 1)
                new = start + datetime.timedelta(days=twin.residues((day - start).days, *pii.DAYS, "date"))
                return "date", f"{new:{fmt}}"
        return None, m
    if is_("ip"):
        y = twin.residues(int.from_bytes(map(int, m.split("."))), 65536, 65536, "ip")
        return "ip", ".".join(map(str, y.to_bytes(4)))
    if is_("ssn"):
        a, g, n = map(int, m.split("-"))
        if a in (0, 666) or a >= 900 or not g or not n:
            return None, m
        y = twin.residues(((a - 2 if a > 666 else a - 1) * 99 + g - 1) * 9999 + n - 1, *pii.SSN, "ssn")
        a = y // (99 * 9999)
        return "ssn", f"{a + 2 if a >= 665 else a + 1:03d}-{y // 9999 % 99 + 1:02d}-{y % 9999 + 1:04d}"
    if is_("card"):
        if not luhn(only):
            return None, m
        body = twin.digits(only[:-1], "card")
        return "card", refilled(m, body + next(c for c in "0123456789" if luhn(body + c)))
    if m.startswith("+") and not re.fullmatch(r"\+1[^0-9]*(?:[^0-9]*[0-9]){10}", m):
        return ("phone", m[:2] + twin.digits(m[2:], "phone+")) if m[1] != "0" else (None, m)
    ten = only[-10:]
    if ten[3] < "2":
        return None, m
    y = twin.residues((int(ten[:3]) * 800 + int(ten[3:6]) - 200) * 10_000 + int(ten[6:]), *pii.PHONE, "phone")
    return "phone", refilled(m, only[:-10] + f"{y // 8_000_000:03d}{y // 10_000 % 800 + 200}{y % 10_000:04d}")


def slow_pseudonyms(t, key):
    """(text, counts by kind) of a whole text."""
    counts, twin = Counter(), Twin(key)

    def put(m):
        kind, new = slow_pseudonym(m[0], twin)
        counts[kind] += kind is not None
        return new

    return (None if t is None else re.sub(pii.ANY, put, t)), counts


PII = {
    "email": ["ann.smith+x@mail.example.com", "a@b.co", "X9.y-8%z@sub.dom-ain.org", "abcdefghijklmnopqrstuvwxyzabcdefgh.1234567890123456789012345@x.io", "John.Smith@x.com", "john.smith@x.com", "m@7.x.1.com", "me@" + "b." * 4000 + "com", "Ab1." * 400 + "@x.de"],
    "card": ["4041894974608795", "4111-1111-1111-1111", "4111 1111 1111 1111", "378282246310005", "6304000000000000000"],
    "ip": ["10.0.0.1", "255.255.255.255", "70.123.182.155"],
    "ssn": ["123-45-6789", "665-01-0001", "667-01-0001", "899-99-9999"],
    "phone": ["+1 (988) 555-2485", "+1 (017) 555-2485", "(212) 555-0100", "212-555-0100", "+12125550100", "+4915112345678", "+12345678"],
    "date": ["2024-02-29", "1800-01-01", "31/12/2199", "12/31/1999", "01.02.2003"],
}
SHAPE = {"email": r"[A-Za-z0-9.+%-]+@.*", "card": r"[0-9 -]+", "ip": r"[0-9.]+", "ssn": r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", "phone": r"[0-9+() -]+", "date": r"[0-9./-]{10}"}
STAY = ["4041894974608796", "1.2.3.4.5", "256.1.1.1", "000-45-6789", "2023-02-29", "99/99/2020", "id4041894974608795", "deadbeef4041894974608795", "12345", "a@b", "a@b.c", "a@.com", "1800-01-01T", "212-155-0100", "+0123456789", "+1 (212) 055-0100", ""]


def test_pseudonyms(spark):
    rows = [(k, v) for k, vs in PII.items() for v in vs]
    texts = [(i, f"é <{v}>, {v}; x{v[:0]}") for i, (_, v) in enumerate(rows)] + [(1000 + i, f"<{v}>") for i, v in enumerate(STAY)] + [(2000, None), (2001, "70.123.182.155 4041894974608795 +1 (988) 555-2485 2024-02-29 ann.smith+x@mail.example.com"), (2002, "\x01\x02 10.0.0.1\x01\x03\x01\x02 a@b.co.1 me@b.com. $1 \\1"), (2003, "a@b.co\n" * 300 + "10.0.0.1 " * 300)]
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts], "doc_id long, text string, kind int")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    new = {}
    for i, (k, v) in enumerate(rows):
        r = got[i]
        a, b = re.fullmatch(r"é <(.*)>, (.*); x", r.text).groups()
        assert a == b and a != v and len(a) == len(v) if k != "ip" else a == b and a != v, (v, r.text)
        assert re.fullmatch(SHAPE[k], a), (v, a)
        assert {c: r[f"n_{c}"] for c in pii.KINDS} == {c: 2 * (c == k) for c in pii.KINDS}, (v, r)
        if k == "card":
            assert luhn(re.sub(r"\D", "", a)) and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", v)
        if k == "ip":
            assert all(0 <= int(x) < 256 for x in a.split("."))
        if k == "email":
            form = lambda x: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "9", x)))
            assert a.partition("@")[2] == v.partition("@")[2] and form(a.partition("@")[0]) == form(v.partition("@")[0])
        new[v] = a
    assert len(set(new.values())) == len(new)
    for i, v in enumerate(STAY):
        assert got[1000 + i].text == f"<{v}>"
    assert got[2000].text is None and got[2000].n_ip == 0
    assert got[2001].text == " ".join(new[v] for v in ("70.123.182.155", "4041894974608795", "+1 (988) 555-2485", "2024-02-29", "ann.smith+x@mail.example.com"))
    for i, t in texts:
        want, counts = slow_pseudonyms(t, "k")
        assert got[i].text == want and {k: got[i][f"n_{k}"] for k in pii.KINDS} == {k: counts[k] for k in pii.KINDS}, t
    again = {r.doc_id: r.text for r in pii.pseudonymise(docs, "other").collect()}
    assert again[0] != got[0].text and pii.pseudonymise(docs.limit(0), "k").count() == 0
    assert pii.pseudonymise(docs, "k", counts=False).columns == docs.columns
    clash = docs.withColumns({"__pii": F.lit(3), "n_ip": F.lit("x")})
    assert pii.pseudonymise(clash, "k").where("n_ip > 0 and __pii = 3").count() == len(PII["ip"]) + 3


def test_pseudonyms_of_very_long_texts(spark):
    """A megabyte of each shape that patterns could stumble on, in time that grows with the text."""
    n = 1_000_000
    texts = ["me@" + "b." * (n // 2) + "com", "x" * n + "@mail.com", "Ab1." * (n // 4), "7" * n, "a@" * (n // 2), "10.0.0.1 " * (n // 9), "b." * (n // 2) + "@", "-" * n, "+1 (" * (n // 4), "\x01" * n]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    start = time.monotonic()
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert time.monotonic() - start < 120
    assert all(len(got[i].text) == len(t) for i, t in enumerate(texts) if i != 5)
    assert got[0].n_email == got[1].n_email == 1 and got[5].n_ip == n // 9 and len(set(got[5].text.split())) == 1
    assert [got[i].text == t for i, t in enumerate(texts)] == [i not in (0, 1, 5) for i in range(len(texts))]


def test_permutations_are_one_to_one(spark):
    f = pii.Feistel("k")
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"), "id")
    got = d.select(f.digits(F.col("s"), "t").alias("a"), f.residues(F.col("id"), 25, 40, "t").alias("b")).collect()
    assert sorted(r.a for r in got) == [f"{i:03d}" for i in range(1000)] and sorted(r.b for r in got) == list(range(1000))
    small = "abcdefghijklmnopqrstuvwxyz"
    words_ = [x + y for x in small + small.upper() for y in small + small.upper()] + [f"{x}.{i}" for x in small for i in range(10)]
    got = spark.createDataFrame([(w,) for w in words_], "s string").select("s", f.string(F.col("s"), "t").alias("a")).collect()
    assert sorted(r.a for r in got) == sorted(words_)


# the pipeline


def test_stages(spark, tmp_path):
    rows = case()
    base = next(t for i, t in rows if i == 1003).split()
    rows += [(5000, "mail ann.smith@mail.example.com from 10.0.0.1 " + text(np.random.default_rng(8), 20)), (5001, text(np.random.default_rng(9), 20) + " " + " ".join(base[20:40]))]
    docs = frame(spark, [(i, t, "xx") for i, t in rows])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(base[15:45]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = at
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, str(tmp_path))
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert kept.columns == at.columns
        if name == "language":
            assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in rows)
        if name == "near_duplicates":
            check_one_of_each(spark, [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
        if name == "decontamination":
            want = " ".join(base[15:45])
            hit = {r.doc_id for r in before.collect() if any(" ".join(want.split()[p : p + 10]) in " ".join(words(r.text)) for p in range(21))}
            assert 5001 in hit and {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()} - hit
        if name == "pii":
            new = {r.doc_id: r for r in kept.collect()}
            for r in before.collect():
                assert (new[r.doc_id].text == r.text) == (r.doc_id != 5000) and new[r.doc_id].n_chars == len(new[r.doc_id].text)
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(r.doc_id for r in kept.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, at.limit(0), str(tmp_path)).count() == 0, name


def test_packed_sequences_hold_their_ids(spark, tmp_path):
    got = corpus_pipeline.pack(spark, frame(spark, [(1, "one two three", "xx")]), str(tmp_path)).collect()
    assert got and all(len(bytes(r.ids)) == 4 * r.length for r in got)
