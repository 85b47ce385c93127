"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.rows import documents, frame
from vecflow.llm import spelling as sp


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(rows, least=5, often=3, slip=97):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least and k >= often}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=repr)


def check(spark, rows, **options):
    got = sp.variants(frame(spark, [(i, t, None) for i, t in rows]), **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = slow(rows, **({"slip": options["slip"]} if "slip" in options else {}))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def drawn(seed, n_docs=60, letters="abcdé", sizes=(4, 9)):
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list(letters), int(rng.integers(*sizes)))) for _ in range(400)]
    p = 1 / np.arange(1, 401)
    rows = []
    for i in range(n_docs):
        w = list(rng.choice(pool, 300, p=p / p.sum()))
        for k in rng.choice(len(w), 30, replace=False):
            at = int(rng.integers(len(w[k])))
            w[k] = w[k][:at] + str(rng.choice(["", "a", w[k][at] * 2])) + w[k][at + 1 :]
        rows.append((i * 7 - 3, ", ".join(w)))
    return rows


def test_variants(spark):
    rows = [(i, t) for i, t, _ in documents()] + drawn(1)
    rows += [(None, "kettle Kettle KETTLE kettles kettles kettles"), (None, None), (9, ""), (9, "kettle-kettle kettel kettel kettel"), (9, "kettle-kettle kettel kettel kettel")]
    rows += [(10, " ".join(["Étage étage ÉTAGE ××××× ÷×××× naıve naivé straße strasse"] * 3))]
    want = check(spark, rows)
    assert any(f for _, f, *_ in want) and any(f and r != f for _, f, r, *_ in want)


def test_slips(spark):
    """With every third run spelt with a letter less."""
    check(spark, drawn(4, 30), slip=3)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_tiles(spark, letters):
    """Blocks far larger than ``large`` are dealt into tiles: the same pairs."""
    check(spark, drawn(2, 40, letters, (5, 8)), large=8)


def test_long_words(spark):
    rng = np.random.default_rng(3)
    long = "".join(rng.choice(list("abcxyz"), 20_000))
    mid = "".join(rng.choice(list("abcxyz"), 90))
    others = [long[:700] + long[701:], long[:-1] + "q", "q" + long, long[:9000] + "ab" + long[9001:], long[::-1], mid, mid + "a", mid[:64], mid[:63], "b" + mid[1:63], mid[:30] + "q" + mid[31:]]
    check(spark, [(i, " ".join([long] * 7 + others)) for i in range(3)], slip=10**9)


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "a bc def ghij"), (3, "12 34")])


def test_near_pairs_by_hand():
    words = ["abcde", "abcdf", "abdce", "abcdef", "abcdeg", "aabcde", "abcdé"]
    everything = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    found = Counter()
    for side in (0, 1):
        for base in (5, 6):
            for half in {h for w in words for h in (w[: base // 2], w[len(w) - (base - base // 2) :])}:
                own = [w for w in words if len(w) in (base, base + 1) and (w[: base // 2] if side == 0 else w[len(w) - (base - base // 2) :]) == half]
                if not own:
                    continue
                k = len(own)
                i, j = sp.near_pairs(own, np.zeros(k, int), np.full(k, base), np.full(k, side), np.array([len(w) > base for w in own]), np.full(k, -1))
                found.update(tuple(sorted((own[a], own[b]))) for a, b in zip(i, j, strict=True))
    assert set(found) == everything and set(found.values()) == {1}
