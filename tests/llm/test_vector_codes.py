"""Vector codes against plain assignment of all parts to all entries."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from vecflow.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error double, id long, vector binary"


def slow(rows, parts=4, size=256, rounds=4):
    """(vec_id, code, error, label_error, digest) by plain Python."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    dims = max(1, -(-max(len(v) for _, v, _ in kept) // parts)) * parts
    width = dims // parts
    whole = [[math.floor(float(np.float32(x)) * 1024) for x in v] + [0] * (dims - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, np.array(whole[k], "<i8").tobytes()))
    books = [[whole[k][p * width : (p + 1) * width] for k in order[:size]] for p in range(parts)]

    def nearest(p, v):
        d = [sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for w in cut:
                own[nearest(p, w[p])[0]].append(w[p])
            for e, members in own.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by = [], defaultdict(int)
    for (i, _, g), w in zip(kept, cut, strict=True):
        got = [nearest(p, w[p]) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c, _ in got), sum(d for _, d in got), g))
        by[g] += out[-1][2]
    return sorted(((i, c, e, by[g], digest) for i, c, e, g in out), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, g, "c", 0.5, 1, b"v") for i, v, g in rows], SCHEMA).repartition(3)
    got = vc.encode(df, **options)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def case(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (7, dims))
    return [(int(i), [float(x) for x in np.float32(centres[rng.integers(7)] + rng.normal(0, 0.3, dims))], int(rng.integers(4)) if rng.random() < 0.8 else None) for i in rng.permutation(n)]


def test_codes(spark):
    rows = case(700, 16)
    rows += [(1000, None, 1), (1001, [1.0, None] * 8, 1), (1002, [float("nan")] * 16, 1), (1003, [float("inf")] + [0.0] * 15, None)]
    rows += [rows[0], rows[0], (5, rows[3][1], None), (None, rows[4][1], 2), (1004, [0.5] * 16, None), (1005, [], 3), (1006, [1.0, -1.0, 0.25], 3)]
    assert run(spark, rows) == slow(rows)


@pytest.mark.parametrize("n", [1, 3, 40])
def test_few_rows(spark, n):
    rows = case(n, 8, n)
    assert run(spark, rows) == slow(rows)


def test_small_codebooks_move(spark):
    """Few entries and tight groups of equal rows: ties, unused entries, entries that move far."""
    rows = [(i, [float(i % 5), float(i % 3) * 4, 0.0, float(i // 50)], i % 2) for i in range(200)]
    assert run(spark, rows, entries=9, rounds=6) == slow(rows, size=9, rounds=6)


def test_large_components(spark):
    rows = [(i, [float((-1) ** i * 90_000 + i), 1.5 * i, 0.0, -1.0], 0) for i in range(30)]
    assert run(spark, rows, entries=4) == slow(rows, size=4)
    assert len(run(spark, [(1, [3e38, -3e38, 0.0, 1.0], 0), (2, [0.0] * 4, 0)])) == 2


def test_nothing_kept(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1), (2, [float("nan")], None)]) == []


def test_bounds_skip_most_distances():
    """Codes are those of plain assignment in every round, for less than all distances; net moves save more than added ones."""
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(0, 300, (40, 16))[rng.integers(0, 40, 3000)] + rng.normal(0, 40, (3000, 16))).astype(np.int64)
    start = x[:256].reshape(256, 4, 4).transpose(1, 0, 2)
    books, state = vc.Codebooks(start[None], vc._grouped(start)), vc.State.unknown(len(x), 4)
    counts = []
    for _ in range(6):
        state, error, taken = vc.assign(x, books, state, books.moved())
        counts.append(taken)
        new = books.now.copy()
        for p, part in enumerate(np.split(x, 4, axis=1)):
            d = ((part[:, None, :] - books.now[p][None]) ** 2).sum(2)
            assert (d.argmin(1) == state.code[:, p]).all() and (d.min(1) == error[:, p]).all()
            for e in np.unique(state.code[:, p]):
                mine = part[state.code[:, p] == e]
                new[p, e] = mine.sum(0) // len(mine)
        books = books._replace(history=np.concatenate([books.history, new[None]]))
    assert counts[0] > 4 * 256 * len(x) and counts[-1] < 0.2 * counts[0]
    steps = np.sqrt((np.diff(books.history.astype(float), axis=0) ** 2).sum(3))
    net = np.sqrt(((books.now - books.history).astype(float) ** 2).sum(3))
    assert (net[0] <= steps.sum(0) + 1e-9).all() and (net[0] < 0.95 * steps.sum(0)).any()
