"""Main text of web pages: a recurrent labeller reads all blocks of a page, forwards and backwards, and keeps the main ones.

A page is a sequence of blocks (``html_blocks``). Each block is read as three vectors and a few numbers: the sum of the
vectors of the hashed words of its tag path (all elements above, and the innermost two apart), the mean of those of its
own hashed words, and lengths, link share and punctuation. A bidirectional LSTM in numpy goes over the
whole sequence, so that each block is judged in the context of its document, and gives each the probability of being
main text; blocks of a half or more are joined by one space. No text is cut, no page is skipped.

The model is fitted to SAMPLE_PAGES drawn pages (``html_samples``): a fixed number, not rows of the table, so fitting
takes the same time whatever the input; it is fitted once a process, by one task, and sent to the tasks with the
expression. No shuffle: pages are judged where they are read.

Defined cases: a null or empty html, or one without main text, gives an empty text; equal rows give equal texts; a page
of one block or of hundreds of thousands is one sequence (recurrences are worked through in groups of sequences of
like length, GROUP blocks at a time, or one page); broken markup is read as far as it goes. page_id and url pass as
they are, nulls included; other columns are left behind. An empty table gives no rows.
"""

from __future__ import annotations

import math
import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.llm import common
from vecflow.llm.html_blocks import BUCKETS, Leaf, Paths, leaves
from vecflow.llm.html_samples import MAIN, Sampler

#: Pages drawn to learn from, and passes over them.
SAMPLE_PAGES = 5000
PASSES = 4
SEED = 20
#: Sizes of path vectors, word vectors, and of the state of each direction.
PATH, WORD, HIDDEN = 20, 8, 24
WORD_BUCKETS = 1024
NUMBERS = 8
#: What a word of a path adds to its path's vector, as a part of its own.
PART = 0.5
RATE, DECAY = 0.01, 1e-5
#: Blocks of pages worked through at once.
GROUP = 40_000


class Labeller(NamedTuple):
    """Weights; ``w``, ``u``, ``b`` are the two directions' input, recurrent and bias weights (gates i, f, o, g)."""

    above: np.ndarray
    inner: np.ndarray
    word: np.ndarray
    w: np.ndarray
    u: np.ndarray
    b: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _numbers(leaf: Leaf) -> tuple:
    t = leaf.text
    n = len(t)
    head = t[:1]
    return (min(math.log1p(n), 7) / 6, min(math.log1p(t.count(" ")), 5) / 5, leaf.linked, min(1.0, 20 * sum(map(t.count, ",;:")) / n), t[-1] in ".!?", head.isupper(), min(1.0, 30 * sum(map(t.count, ".!?")) / n), 1.0)


def _block_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all words in order, number of words of each text)."""
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    low, starts, stops = common.words(np.frombuffer(b" ".join([*raw, b""]), np.uint8))
    own = np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(raw))
    return (common.word_hashes(low, starts, stops) % np.uint64(WORD_BUCKETS)).astype(np.int64), own


def _means(vectors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive groups of rows, zero for empty ones."""
    out = np.zeros((len(counts), vectors.shape[1]), np.float32)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(vectors, (np.cumsum(counts) - counts)[full], axis=0) / counts[full, None]
    return out


def _inputs(model: Labeller, own: list[Leaf]) -> np.ndarray:
    for leaf in own:
        p = leaf.path
        if p.vector is None:
            above, inner = np.array(sorted(p.above), np.int64), np.array(sorted(p.inner), np.int64)
            p.vector = np.concatenate([PART * model.above[above].sum(0), PART * model.inner[inner].sum(0)])
    words = np.zeros((len(own), WORD), np.float32)
    at = 0
    while at < len(own):  # a stretch of text at a time
        to, size = at, 0
        while to < len(own) and (to == at or size + len(own[to].text) < common.STRETCH):
            size += len(own[to].text)
            to += 1
        buckets, counts = _block_words([x.text for x in own[at:to]])
        words[at:to] = _means(model.word[buckets], counts)
        at = to
    return np.concatenate([np.array([x.path.vector for x in own], np.float32), words, np.array([_numbers(x) for x in own], np.float32)], axis=1)


def _run(x: np.ndarray, sizes: np.ndarray, starts: np.ndarray, step: int, u: np.ndarray) -> np.ndarray:
    """States of one direction (step 1 or -1) over sequences that lie behind each other in x (gate inputs), longest first."""
    h_size = u.shape[0]
    out = np.empty((len(x), h_size), np.float32)
    h, c = np.zeros((len(sizes), h_size), np.float32), np.zeros((len(sizes), h_size), np.float32)
    begin = starts if step > 0 else starts + sizes - 1
    live = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # sequences longer than t
    for t in range(int(sizes[0])):
        n = live[t]
        rows = begin[:n] + step * t
        z = x[rows] + h[:n] @ u
        gates = _sigmoid(z[:, : 3 * h_size])
        c = gates[:, h_size : 2 * h_size] * c[:n] + gates[:, :h_size] * np.tanh(z[:, 3 * h_size :])
        h = gates[:, 2 * h_size :] * np.tanh(c)
        out[rows] = h
    return out


def probabilities(model: Labeller, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """For each page the probability of each block to be main text."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: -len(pages[i]))
    at = 0
    while at < len(order):
        to, size = at, 0
        while to < len(order) and (to == at or size + len(pages[order[to]]) <= GROUP):
            size += len(pages[order[to]])
            to += 1
        mine = order[at:to]
        at = to
        x = _inputs(model, [leaf for i in mine for leaf in pages[i]])
        sizes = np.array([len(pages[i]) for i in mine])
        starts = np.cumsum(sizes) - sizes
        states = np.concatenate([_run(x @ model.w[d] + model.b[d], sizes, starts, step, model.u[d]) for d, step in ((0, 1), (1, -1))], axis=1)
        p = _sigmoid(states @ model.out + model.bias)
        for i, lo, n in zip(mine, starts, sizes, strict=True):
            out[i] = p[lo : lo + n]
    return out


# Fitting


def _sample(seed: int, n: int) -> list[tuple[list[Leaf], np.ndarray]]:
    """n drawn pages as (blocks, labels)."""
    draw, paths, out = Sampler(seed), Paths(), []
    for _ in range(n):
        marked = leaves(draw.page(), paths)
        labels = np.array([MAIN in x.text for x in marked], np.float32)
        plain = [x._replace(text=t) for x in marked if (t := " ".join(x.text.translate({0xE000: "", 0xE001: ""}).split())) or True]
        keep = [i for i, x in enumerate(plain) if x.text]
        if keep:
            out.append(([plain[i] for i in keep], labels[keep]))
    return out


class _Bags(NamedTuple):
    """Sums of rows of a table (times PART), one for each cell; equal cells are taken once."""

    rows: np.ndarray  # distinct rows that are met
    parts: np.ndarray  # distinct cells x rows: a row's part of the sum
    cell: np.ndarray  # for each cell its distinct one
    order: np.ndarray
    first: np.ndarray

    def sums(self, table: np.ndarray) -> np.ndarray:
        return (self.parts @ table[self.rows])[self.cell]

    def gradient(self, table: np.ndarray, d: np.ndarray) -> np.ndarray:
        out = np.zeros_like(table)
        out[self.rows] = self.parts.T @ np.add.reduceat(d[self.order], self.first, axis=0)
        return out


def _bags(groups: list) -> _Bags:
    kinds = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    cell = np.array([kinds[g] for g in groups])
    rows = np.array(sorted({x for g in kinds for x in g}), np.int64)
    parts = np.zeros((len(kinds), len(rows)), np.float32)
    for g, i in kinds.items():
        if g:
            parts[i, np.searchsorted(rows, list(g))] = PART
    order = np.argsort(cell, kind="stable")
    return _Bags(rows, parts, cell, order, np.searchsorted(cell[order], np.arange(len(kinds))))


class _Batch(NamedTuple):
    above: _Bags
    inner: _Bags
    words: np.ndarray
    counts: np.ndarray  # words of each cell
    numbers: np.ndarray
    label: np.ndarray
    mask: np.ndarray
    back: np.ndarray  # places of each sequence in reverse


def _batch(pages: list) -> _Batch:
    n, t = len(pages), max(len(p) for p, _ in pages)
    label, mask, numbers, back = np.zeros((n, t), np.float32), np.zeros((n, t), np.float32), np.zeros((n, t, NUMBERS), np.float32), np.tile(np.arange(t), (n, 1))
    counts, none = np.zeros((n, t), np.int64), frozenset()
    above, inner, words = [], [], []
    for i, (own, y) in enumerate(pages):
        m = len(own)
        label[i, :m], mask[i, :m], back[i, :m] = y, 1, np.arange(m)[::-1]
        numbers[i, :m] = [_numbers(x) for x in own]
        above += [*(x.path.above for x in own), *[none] * (t - m)]
        inner += [*(x.path.inner for x in own), *[none] * (t - m)]
        buckets, counts[i, :m] = _block_words([x.text for x in own])
        words.append(buckets)
    return _Batch(_bags(above), _bags(inner), np.concatenate(words), counts.ravel(), numbers, label, mask, back)


def _word_gradient(table: np.ndarray, x: _Batch, d: np.ndarray) -> np.ndarray:
    each = d / np.maximum(1, x.counts)[:, None]
    return np.stack([np.bincount(x.words, np.repeat(c, x.counts), len(table)) for c in each.T], axis=1).astype(np.float32)


def _forward(x: np.ndarray, mask: np.ndarray, w, u, b):
    n, t, _ = x.shape
    size = u.shape[0]
    z_in = x @ w + b
    h, c, kept = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32), []
    out = np.zeros((n, t, size), np.float32)
    for s in range(t):
        z = z_in[:, s] + h @ u
        i, f, o, g = _sigmoid(z[:, :size]), _sigmoid(z[:, size : 2 * size]), _sigmoid(z[:, 2 * size : 3 * size]), np.tanh(z[:, 3 * size :])
        new = f * c + i * g
        th = np.tanh(new)
        kept.append((h, c, i, f, o, g, th))
        m = mask[:, s, None]
        h, c = m * o * th + (1 - m) * h, m * new + (1 - m) * c
        out[:, s] = h
    return out, kept


def _backward(d_out: np.ndarray, kept: list, mask: np.ndarray, u: np.ndarray):
    """Gradients of the gate inputs and of the recurrent weights."""
    n, t, size = d_out.shape
    dz, du = np.zeros((n, t, 4 * size), np.float32), np.zeros_like(u)
    dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    for s in range(t - 1, -1, -1):
        h, c, i, f, o, g, th = kept[s]
        m = mask[:, s, None]
        dh = dh + d_out[:, s]
        now, cell = m * dh, m * dc
        cell = cell + now * o * (1 - th * th)
        z = np.concatenate([cell * g * i * (1 - i), cell * c * f * (1 - f), now * th * o * (1 - o), cell * i * (1 - g * g)], axis=1)
        dz[:, s] = z
        du += h.T @ z
        dh = z @ u.T + (1 - m) * dh
        dc = cell * f + (1 - m) * dc
    return dz, du


def _gradients(m: Labeller, x: _Batch) -> tuple[float, Labeller]:
    n, t = x.mask.shape
    parts = [x.above.sums(m.above), x.inner.sums(m.inner), _means(m.word[x.words], x.counts)]
    inputs = np.concatenate([*(v.reshape(n, t, -1) for v in parts), x.numbers], axis=2)
    turned = np.take_along_axis(inputs, x.back[:, :, None], 1)
    (ahead, kept0), (behind, kept1) = (_forward(v, x.mask, m.w[d], m.u[d], m.b[d]) for d, v in ((0, inputs), (1, turned)))
    states = np.concatenate([ahead, np.take_along_axis(behind, x.back[:, :, None], 1)], axis=2)
    p = _sigmoid(states @ m.out + m.bias)
    weight = x.mask / x.mask.sum()
    loss = -float((weight * (x.label * np.log(p + 1e-7) + (1 - x.label) * np.log(1 - p + 1e-7))).sum())
    d = (p - x.label) * weight
    d_states = d[:, :, None] * m.out
    half = ahead.shape[2]
    dz0, du0 = _backward(d_states[:, :, :half], kept0, x.mask, m.u[0])
    dz1, du1 = _backward(np.take_along_axis(d_states[:, :, half:], x.back[:, :, None], 1), kept1, x.mask, m.u[1])
    dw = np.stack([np.tensordot(inputs, dz0, ((0, 1), (0, 1))), np.tensordot(turned, dz1, ((0, 1), (0, 1)))])
    dx = dz0 @ m.w[0].T + np.take_along_axis(dz1 @ m.w[1].T, x.back[:, :, None], 1)
    flat = dx.reshape(n * t, -1)
    grads = Labeller(
        x.above.gradient(m.above, flat[:, :PATH]), x.inner.gradient(m.inner, flat[:, PATH : 2 * PATH]), _word_gradient(m.word, x, flat[:, 2 * PATH : 2 * PATH + WORD]),
        dw, np.stack([du0, du1]), np.stack([dz0.sum((0, 1)), dz1.sum((0, 1))]), np.tensordot(states, d, ((0, 1), (0, 1))), np.array(d.sum(), np.float32),
    )
    return loss, grads


def fit(n_pages: int = SAMPLE_PAGES, passes: int = PASSES, seed: int = SEED, batch: int = 32) -> Labeller:
    """A labeller fitted to n_pages drawn pages, by Adam with a falling rate; the weights of the last third of all steps are
    averaged. Buckets never met keep zero vectors."""
    rng = np.random.default_rng(seed)
    wide = 2 * PATH + WORD + NUMBERS
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    bias = np.zeros((2, 4 * HIDDEN), np.float32)
    bias[:, HIDDEN : 2 * HIDDEN] = 1
    m = Labeller(rng.normal(0, 0.3, (BUCKETS, PATH)).astype(np.float32), rng.normal(0, 0.3, (BUCKETS, PATH)).astype(np.float32), rng.normal(0, 0.1, (WORD_BUCKETS, WORD)).astype(np.float32), start(2, wide, 4 * HIDDEN), start(2, HIDDEN, 4 * HIDDEN), bias, start(2 * HIDDEN, 1)[:, 0], np.array(0, np.float32))
    pages = sorted(_sample(seed, n_pages), key=lambda p: len(p[0]))
    batches = [_batch(pages[i : i + batch]) for i in range(0, len(pages), batch)]
    for table, met in ((m.above, [x.above.rows for x in batches]), (m.inner, [x.inner.rows for x in batches]), (m.word, [x.words for x in batches])):
        table[np.setdiff1d(np.arange(len(table)), np.concatenate(met))] = 0
    first, second = ([np.zeros_like(v) for v in m] for _ in range(2))
    weights, step, steps = list(m), 0, passes * len(batches)
    late, total = 0, [np.zeros_like(v) for v in m]
    for _ in range(passes):
        for k in rng.permutation(len(batches)):
            _, grads = _gradients(Labeller(*weights), batches[k])
            rate = RATE * (1 - step / steps)
            step += 1
            norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
            for j, g in enumerate(grads):
                g = g / max(1.0, norm) + DECAY * weights[j]
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.99 * second[j] + 0.01 * g * g
                weights[j] = (weights[j] - rate * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            if 3 * step > 2 * steps:
                late += 1
                total = [a + w for a, w in zip(total, weights, strict=True)]
    return Labeller(*(a / np.float32(late) for a in total) if late else weights)


_FITTED: dict[tuple, Labeller] = {}


def fitted(spark: SparkSession, n_pages: int = SAMPLE_PAGES, passes: int = PASSES, seed: int = SEED) -> Labeller:
    """A fitted labeller, by a task of its own: workers of tasks have one thread each for matrices, which suits the small
    ones here. About 0.8 MB of weights come back."""

    def run(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(n_pages, passes, seed))], pa.binary())], ["model"])

    key = n_pages, passes, seed
    if key not in _FITTED:
        rows = spark.range(1).repartition(1).mapInArrow(run, "model binary").collect()
        _FITTED[key] = pickle.loads(rows[0][0])
    return _FITTED[key]


# The operator


def extract(html: Column, model: Labeller) -> Column:
    """Main text of a column of pages; empty for null."""
    paths = Paths()

    @F.arrow_udf("string")
    def main_text(pages: pa.Array) -> pa.Array:
        out: list[str] = [""] * len(pages)
        held: list[tuple[int, list[Leaf]]] = []
        size = 0

        def judge():
            for (i, own), p in zip(held, probabilities(model, [x for _, x in held]), strict=True):
                out[i] = " ".join(leaf.text for leaf, y in zip(own, p, strict=True) if y >= 0.5)
            held.clear()

        for i in range(len(pages)):
            own = leaves(pages[i].as_py() or "", paths)
            held.append((i, own))
            size += len(own)
            if size > GROUP:
                judge()
                size = 0
        judge()
        return pa.array(out, pa.string())

    return main_text(html)


def main_texts(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """pages(page_id, url, html) as (page_id, url, text, n_chars)."""
    spark = pages.sparkSession
    common.bound_batches(spark)
    model = fitted(spark) if model is None else model
    read = pages.select("page_id", "url", extract(F.col("html").cast("string"), model).alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("long"))


def op13_html_text(spark, sf_dir: str) -> DataFrame:
    return main_texts(common.table(spark, sf_dir, "pages"))
