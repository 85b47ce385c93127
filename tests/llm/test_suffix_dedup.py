import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecflow.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows, length=50):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of rows (doc_id, text)."""
    least: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            if i is not None:
                least[b[p : p + length]] = min(i, least.get(b[p : p + length], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if i is not None and least.get(b[p : p + length], i) < i:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup(df, **options).collect()), key=str)


def rows_of(seed=1):
    rng = np.random.default_rng(seed)
    word = lambda n: "".join(rng.choice(list("abcdef ghé\n"), n))
    passage, long_ = word(300), word(150_000)
    rows = [(i, word(int(rng.integers(0, 400)))) for i in range(20)]
    rows += [(30, passage), (31, word(90) + passage[40:200] + word(7) + passage[:60]), (32, passage), (32, passage), (5000000000, passage * 3)]
    rows += [(40, long_), (41, word(10) + long_[70_000:140_000] + word(5)), (42, "a" * 200), (43, "b" + "a" * 500), (44, None), (45, ""), (46, "x" * 49), (None, passage), (-7, passage[100:160])]
    return rows


def test_against_brute_force(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "src", 1) for r in rows], SCHEMA + ", source string, bucket int").repartition(5)
    assert got(df) == brute(rows)


def test_small_strings(spark):
    rows = [(i, t) for i, t in enumerate(["abcabcabc", "xabcab", "", None, "cabc", "abcabcabc"])]
    assert got(spark.createDataFrame(rows, SCHEMA), length=4, gram=2) == brute(rows, 4)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_kept_text_and_spans(spark):
    p = "0123456789" * 6
    rows = sd.dedup(spark.createDataFrame([(1, p), (2, "<" + p + ">")], SCHEMA)).collect()
    second = next(r for r in rows if r.doc_id == 2)
    assert bytes(second.kept) == b"<>" and second.spans == [[1, 61]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=60))
def test_nearest_smaller(values):
    v = np.array(values)
    back = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]
    ahead = [min((j for j in range(i + 1, len(v)) if v[j] < v[i]), default=-1) for i in range(len(v))]
    assert sd.nearest_smaller(v).tolist() == back and sd.nearest_smaller(v, reverse=True).tolist() == ahead


@pytest.mark.parametrize("packed", [1 << 21, 8])
def test_prefix_ranks_are_suffix_order(packed, monkeypatch):
    monkeypatch.setattr(sd, "PACKED", packed)
    raw = np.frombuffer(b"banana bandana" * 9, np.uint8)
    levels = sd.prefix_ranks(raw, 50)
    assert [n for n, _ in levels] == [4, 8, 16, 32, 50]
    for n, rank in levels:
        cut = [raw[i : i + n].tobytes() for i in range(len(raw))]
        order = {s: k for k, s in enumerate(sorted(set(cut)))}
        assert rank.tolist() == [order[s] for s in cut]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=14), min_size=1, max_size=6), st.sampled_from([2, 4, 5, 6]))
def test_longest_previous_factors(texts, length):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts, doc, at = [], [], 0
    for i, t in enumerate(texts):
        starts += range(at, at + len(t) - length + 1)
        doc += [i % 3] * (len(t) - length + 1)
        at += len(t)

    def common_prefix(a, b):
        return next((k for k in range(length) if raw[a + k] != raw[b + k]), length)

    want = [max((common_prefix(a, b) for b, j in zip(starts, doc, strict=True) if j < i), default=0) for a, i in zip(starts, doc, strict=True)]
    got = sd.longest_previous_factors(raw, np.array(starts), np.array(doc), length)
    assert got.tolist() == want


def test_rows_that_share_a_doc_id(spark):
    """Each row of a repeated doc_id loses its own bytes alone."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    p, a, b = word(100), word(300), word(400)
    rows = [(1, word(50) + p + word(60)), (5, a + p + a[:60]), (5, b), (5, p + b), (5, None), (5, ""), (6, b[100:180]), (7, a[:60] + "x"), (7, a[:60] + "y" + p)]
    for n in (1, 4):
        assert got(spark.createDataFrame(rows, SCHEMA).repartition(n)) == brute(rows)


def test_equal_hashes_do_not_remove(spark, monkeypatch):
    """Passages that share a content hash but differ in bytes keep them."""
    raw = np.frombuffer(b"aaaaabbbbbaaaaacccccaaaaa", np.uint8)
    start, size, doc = np.array([0, 5, 10, 15, 20]), np.full(5, 5), np.array([3, 1, 4, 9, 2])
    by, new, late = sd._equal_passages(raw, start, size, np.zeros(5, np.uint64), doc)
    gone = {int(start[i]) for i in by[late]}
    # the first of the hash is document 1 ("bbbbb"): nothing equals it, so nothing goes without an ordering
    assert gone == set() and new.all()
    by, new, late = sd._equal_passages(raw, start, size, np.array([7, 8, 7, 9, 7], np.uint64), doc)
    assert {int(start[i]) for i in by[late]} == {0, 10}


def test_hot_anchor(spark, monkeypatch):
    """One phrase in ever different surroundings, its strings dealt by hash."""
    monkeypatch.setattr(sd, "WHOLE", 1 << 11)
    rng = np.random.default_rng(8)
    raws, first, size, doc, at = [], [], [], [], 0
    sides, tails = ([bytes(rng.choice(list(b"xyz"), 80).tolist()) for _ in range(12)] for _ in range(2))
    for i in range(300):
        side, tail = sides[rng.integers(12)], tails[rng.integers(12)]
        x = (side[: int(rng.integers(0, 30))] + b"a phrase of twenty by" + tail)[: int(rng.integers(50, 81))]
        raws.append(x)
        first.append(at)
        size.append(len(x))
        doc.append(i // 2)
        at += len(x)
    raw = np.frombuffer(b"".join(raws), np.uint8)
    least: dict = {}
    for x, d in zip(raws, doc, strict=True):
        for p in range(len(x) - 49):
            least[x[p : p + 50]] = min(d, least.get(x[p : p + 50], d))
    want = [least[x[p : p + 50]] < d for x, d in zip(raws, doc, strict=True) for p in range(len(x) - 49)]
    assert sd._repeats(raw, np.array(first), np.array(size), np.array(doc), 50).tolist() == want
    assert any(want) and not all(want)
    # and with hashes of which many are equal by chance
    hashes = sd._string_hashes
    monkeypatch.setattr(sd, "_string_hashes", lambda *a: hashes(*a) & np.uint64(0xFC00000000000000))
    assert sd._repeats(raw, np.array(first), np.array(size), np.array(doc), 50).tolist() == want


def test_memory_of_a_hot_string():
    """60,000 ever different surroundings of one string: hashes and bounded pieces, not an order of all copies."""
    import tracemalloc

    n = 60_000
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 123, (n, 80), np.uint8)
    raw[:, 15:65] = raw[0, 15:65]
    flat, first, size, doc = raw.ravel(), np.arange(n) * 80, np.full(n, 80), np.arange(n) // 3
    tracemalloc.start()
    got = sd._repeats(flat, first, size, doc, 50).reshape(n, 31)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    least: dict = {}
    for x, d in zip(flat.reshape(n, 80), doc.tolist(), strict=True):
        x = x.tobytes()
        for p in range(31):
            least.setdefault(x[p : p + 50], d)
    for i in range(0, n, 50):
        x = flat[80 * i : 80 * i + 80].tobytes()
        assert got[i].tolist() == [least[x[p : p + 50]] < doc[i] for p in range(31)]
