"""Spelling variants: words one edit apart, found by Gram matrices of letter counts, grouped under their commonest form.

Words are runs of letters (``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased) of at least MIN_LETTERS that occur MIN_COUNT
times in the corpus. Two words are near if one inserted, deleted or replaced letter makes one the other. Their letter
counts then lie at a squared distance of one (lengths differ by one) or two (equal lengths), so the distances of all
pairs of a block, |a|^2 + |b|^2 - 2ab, come from one matrix product of its counts; pairs at more than two are out,
the others' edits are verified letter by letter.

Blocks: an edit leaves the first or the second half of the shorter word as it is. So words meet that share such a
half: for every length s, a word of s letters is in the blocks of its first s // 2 and of its other letters, and a word
of s + 1 letters in those of its first s // 2 and of its last s - s // 2, as the longer side; a block holds two adjacent
lengths and compares the first with itself and with the second. Each pair is counted once: by its first half if
that is shared, else by its second. So work follows the words that share half their letters, not the square of the
vocabulary; short words, whose halves are shared by many, are bounded in number by the letters there are. Small blocks
are put into one product together. Blocks of more than LARGE words are dealt into tiles by a hash, and each pair of
tiles is a block of its own: exact, in bounded memory, over many tasks.

Blocks send, for each word, its number of near words and the best of them, never pairs. Counts are added up in
each task before they are shuffled, so a word that every document holds costs one row a task.

Forms: a word's form is its near word of the largest count (ties: the smallest in code-point order), if that count is
at least twice the word's own, else none. Counts at least double from form to form, so forms are no circle, and the
last form of each word is found by jumping: the way covered doubles with each join.

Deletions of the contract (``slip``): with h the crc32 of ``<doc_id>:<run>``, a run whose h is divisible by SLIP counts
as the run less its letter h % length, in this document.

Defined cases: null texts hold no words; the text of a null doc_id is empty in ``<doc_id>``; repeated rows count each;
words of any length are compared as a whole. Other columns are left behind. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

MIN_LETTERS = 5
MIN_COUNT = 3
SLIP = 97
#: A task's counts are sent on when so many words, or so many letters of them, are held.
HELD_WORDS, HELD_LETTERS = 200_000, 1 << 25
#: Words of one product of small blocks; words of a block, beyond which it is dealt into tiles of half as many.
BLOCK, LARGE = 512, 8192
#: Longest words whose edits are verified in columns; longer ones are compared one pair at a time.
COLUMNS = 64
#: Pairs verified at once.
PAIRS = 1 << 18

_LETTER = np.zeros(256, np.int64)
_LETTER[0x61:0x7B] = np.arange(26)
_LETTER[0xC0:0x100] = 26 + np.arange(64)
N_LETTERS = 90


# Words


def _counted(min_letters: int, slip: int):
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}")  # from its first letter on a run is taken whole

    def run(batches):
        held: Counter = Counter()
        letters = 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = Counter(runs.findall(raw[off[i] : off[i + 1]].tobytes().lower().decode()))
                seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for w, k in own.items():
                    h = zlib.crc32(w.encode(), seed)
                    if h % slip == 0:
                        w = w[: h % len(w)] + w[h % len(w) + 1 :]
                        if len(w) < min_letters:
                            continue
                    if w not in held:
                        letters += len(w)
                    held[w] += k
                if len(held) > HELD_WORDS or letters > HELD_LETTERS:
                    yield rows()
                    held.clear()
                    letters = 0
        yield rows()

    return run


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of docs(doc_id, text)."""
    each = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_counted(min_letters, slip), "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# Blocks


def _halves(words: DataFrame, min_letters: int) -> DataFrame:
    """(block, word, n, base, side, longer): each word in its blocks; base is the block's shorter length."""
    size = F.length("word")

    def half(side: int, base, longer: bool):
        first = F.floor(base / 2).cast("int")
        shared = F.substring("word", F.lit(1), first) if side == 0 else F.substring("word", size - (base - first) + 1, base - first)
        return F.struct(F.xxhash64(F.lit(side), base, shared).alias("block"), base.alias("base"), F.lit(side).cast("byte").alias("side"), F.lit(longer).alias("longer"))

    own = F.array(half(0, size, False), half(1, size, False), half(0, size - 1, True), half(1, size - 1, True))
    placed = words.select("word", "n", F.explode(F.filter(own, lambda h: h["base"] >= min_letters)).alias("h"))
    return placed.select("h.block", "word", "n", "h.base", "h.side", "h.longer")


def _tiles(placed: DataFrame, large: int) -> DataFrame:
    """Blocks with ``tile`` (-1 where all pairs count); words of a large block go to each pair of tiles with theirs."""
    sizes = placed.groupBy("block").agg(F.count("*").alias("members")).where(F.col("members") > large).select("block", F.ceil(F.col("members") / (large // 2)).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("word", F.lit("tile")), F.col("tiles")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.xxhash64("block", F.least(tile, o), F.greatest(tile, o)).alias("block"), F.when(tile == o, -1).otherwise(tile).alias("tile")))
    at = F.when(F.col("tiles").isNull(), F.array(F.struct(F.col("block"), F.lit(-1).alias("tile")))).otherwise(pair)
    return placed.join(sizes, "block", "left").select("word", "n", "base", "side", "longer", F.explode(at).alias("at")).select("at.block", "word", "n", "base", "side", "longer", "at.tile")


def letter_counts(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    sizes = np.array([len(w) for w in words])
    at = np.repeat(np.arange(len(words)) * N_LETTERS, sizes) + _LETTER[raw]
    counts = np.bincount(at, minlength=len(words) * N_LETTERS).reshape(len(words), N_LETTERS)
    # squared distances must be exact whole numbers
    return counts.astype(np.float32 if sizes.max(initial=0) < 2048 else np.float64)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _beginnings(words: list[str], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common beginning, whether one edit apart) of pairs of words; word i is not the longer one."""
    sizes = np.array([len(w) for w in words])
    begin, near = np.zeros(len(i), np.int64), np.zeros(len(i), bool)
    wide = sizes[j] > COLUMNS
    for k in np.flatnonzero(wide):
        a, b = words[i[k]], words[j[k]]
        p = begin[k] = _common(a, b)
        near[k] = a != b and a[p + (len(a) == len(b)) :] == b[p + 1 :]
    short = np.flatnonzero(~wide)
    if len(short):
        width = int(min(COLUMNS, sizes.max())) + 1
        letters = np.array([w.encode("latin-1") if len(w) <= COLUMNS else b"" for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)
        for at in range(0, len(short), PAIRS):
            k = short[at : at + PAIRS]
            a, b = letters[i[k]], letters[j[k]]
            same = a == b
            p = np.where(same.all(1), sizes[i[k]], same.argmin(1))  # words end in zeros
            begin[k] = np.minimum(p, sizes[i[k]])
            rest = np.arange(width) >= p[:, None]
            moved = np.zeros_like(same)
            moved[:, :-1] = a[:, :-1] == b[:, 1:]
            equal = sizes[i[k]] == sizes[j[k]]
            replaced, added = (~same).sum(1) == 1, (moved | ~rest)[:, :-1].all(1)
            near[k] = np.where(equal, replaced, added)
    return begin, near


def near_pairs(words: list[str], group: np.ndarray, base: np.ndarray, side: np.ndarray, longer: np.ndarray, tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the near pairs of one product: words of one group, of adjacent lengths, by the side that counts them."""
    counts = letter_counts(words)
    square = (counts * counts).sum(1)
    out_i, out_j = [], []
    rows = np.flatnonzero(~longer)
    for at in range(0, len(rows), BLOCK):
        own = rows[at : at + BLOCK]
        lo, hi = np.searchsorted(group, group[own[0]], "left"), np.searchsorted(group, group[own[-1]], "right")  # rows lie in order of groups
        for start in range(lo, hi, 8 * BLOCK):
            to = slice(start, min(hi, start + 8 * BLOCK))
            d = square[own, None] + square[None, to] - 2 * (counts[own] @ counts[to].T)
            ok = (d <= 2) & (group[own, None] == group[None, to])
            i, j = np.nonzero(ok)
            i, j = own[i], j + start
            apart = (tile[i] < 0) | (tile[i] != tile[j])
            keep = apart & (longer[j] | (i < j))
            out_i.append(i[keep])
            out_j.append(j[keep])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_i, out_j))
    begin, near = _beginnings(words, i, j)
    near &= np.where(side[i] == 0, begin >= base[i] // 2, begin < base[i] // 2)
    return i[near], j[near]


def _best(words: list[str], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """(word, near, form, form_n): numbers of near words, and the commonest of them."""
    of, to = np.concatenate((i, j)), np.concatenate((j, i))
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words))
    np.minimum.at(best, of, rank[to])
    near = np.bincount(of, minlength=len(words))
    at = np.flatnonzero(near)
    form = [order[best[k]] for k in at]
    return pa.RecordBatch.from_arrays([pa.array([words[k] for k in at], pa.string()), pa.array(near[at], pa.int64()), pa.array([words[k] for k in form], pa.string()), pa.array(n[form].astype(np.int64), pa.int64())], ["word", "near", "form", "form_n"])


def _products(batches):
    """Rows of blocks in order of (block, word): gathered to products of BLOCK words or one whole block."""
    held: list[list] = [[] for _ in range(7)]

    def judge(n: int):
        block, words, count, base, side, longer, tile = (col[:n] for col in held)
        for col in held:
            del col[:n]
        group = np.cumsum(np.concatenate(([0], np.diff(np.array(block)) != 0)))
        met = np.bincount(group)[group] > 1
        if not met.any():
            return None
        keep = np.flatnonzero(met)
        words, count = [words[k] for k in keep], np.array(count)[keep]
        i, j = near_pairs(words, group[keep], np.array(base)[keep], np.array(side)[keep], np.array(longer, bool)[keep], np.array(tile)[keep])
        return _best(words, count, i, j) if len(i) else None

    for batch in batches:
        for col, new in zip(held, batch.columns, strict=True):
            col.extend(new.to_pylist())
        while len(held[0]) >= 4 * BLOCK or sum(map(len, held[1])) > HELD_LETTERS:
            # whole blocks from the front, BLOCK words or more; the last block may go on
            blocks = np.array(held[0])
            ends = np.flatnonzero(np.diff(blocks)) + 1
            if not len(ends):
                break
            if (out := judge(int(ends[min(np.searchsorted(ends, BLOCK), len(ends) - 1)]))) is not None:
                yield out
    if held[0] and (out := judge(len(held[0]))) is not None:
        yield out


def near_words(words: DataFrame, min_letters: int = MIN_LETTERS, large: int = LARGE) -> DataFrame:
    """(word, near, form, form_n) of words(word, n): number of near words and the commonest, for words that have any."""
    n = common.partitions(words.sparkSession)
    dealt = _tiles(_halves(words, min_letters), large).repartition(2 * n, "block").sortWithinPartitions("block", "word", "longer")
    found = dealt.mapInArrow(_products, "word string, near long, form string, form_n long")
    best = found.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    return best.select("word", "near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _last_forms(forms: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(word, root) of forms(word, form): the last form that is reached from each word."""
    now = scratch.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = scratch.written(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slip: int = SLIP, large: int = LARGE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    scratch = common.Scratch(spark, "spelling")
    words = scratch.written(count_words(docs, min_letters, min_count, slip), "words")
    found = near_words(words, min_letters, large)
    named = F.col("form_n") >= 2 * F.col("n")
    judged = words.join(found, "word", "left").select("word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(named, F.col("form")).alias("form"), F.when(named, F.col("form_n")).alias("form_n"))
    judged = scratch.written(judged, "judged")
    roots = _last_forms(judged.where("form is not null"), scratch)
    out = common.written(judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling")
    scratch.clear()
    return out


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents"))
