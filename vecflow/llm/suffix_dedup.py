"""Suffix-array dedup: bytes that repeat a passage of an earlier document are removed, the first copy stays.

A byte is removed where a ``length``-byte string that covers it also starts in a document of smaller doc_id. In the
suffix order of all positions, the previous and the next position of a smaller document are the two candidates for the
longest earlier match of a position (its longest previous factor); where that match reaches ``length`` the string has
an earlier copy. Ties of doc_id are no earlier copies, and matches never cross documents.

No single suffix array could hold the corpus, so the suffix order is built in parts that lose no match:

1. Anchors. Each ``length``-byte string has as anchor its ``GRAM``-byte gram of smallest hash (the leftmost of
   equals). Equal strings have equal anchors, about one byte in sixteen is an anchor. Sorted 48-bit anchor hashes go to
   buckets, to find those that occur in more than one row. Rows of one batch that share an anchor are settled
   on the spot and send one entry, so an anchor that a third of all documents hold is one entry for each batch.
2. Passages. Strings in a row with the same shared anchor make up one passage of at most 2 * length - GRAM bytes; it is
   sent to the bucket of its anchor. Equal passages of about GATHER bytes of text are sent once, for the smallest doc_id;
   for the other documents they are removed at once. Equal hashes only propose them: the bytes are compared.
3. Suffix order. Each bucket, in parts of about PART bytes with no anchor in two of them, sets equal passages of
   different batches aside in the same way, and passages whose anchor has no other one. It sorts all positions of the
   other passages by prefix doubling (4, 8, 16, 32, length bytes), finds previous and next smaller positions, and from
   the ranks of all lengths the longest previous factor of each position, up to ``length``. Positions that reach it are
   reported as spans. Where an anchor's passages alone exceed WHOLE bytes, their strings are gathered by hash, and two of
   each repeated string (the smallest document's and another's) are ordered, WHOLE bytes at a time; the others are held
   against the first byte by byte. So working memory is 8 bytes a string besides what WHOLE bounds.
4. Spans of a row are merged and cut out.

The text is shuffled by doc_id once and used for the second and the fourth step. Each step works through its batches or
buckets one by one; the number of buckets grows with the bytes of all texts (BUCKET). All exchanges are ordinary
shuffles that Spark rebuilds after a loss.

Null and empty texts have no bytes; texts shorter than ``length`` lose none. Rows without a doc_id keep all bytes and
are no earlier copy. Rows of equal doc_id are not compared with each other. Passages and spans name rows, not documents:
by doc_id where it is unique, else by a number of each different (doc_id, text), so each row loses its own bytes alone.
Extra columns are left behind.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

LENGTH = 50
GRAM = 20
#: Bytes that are hashed at once; positions in them take 16 bits of a key, the hash the other 48.
SEGMENT = 1 << 16
_POS = np.uint64(SEGMENT - 1)
#: Anchors that are gathered in a task before they are sent (16 bytes each), about.
STRETCH = 1 << 21
#: Bytes of text whose passages are sent together, about.
GATHER = 1 << 23
#: Bytes of text for each bucket of passages, about; there are no fewer buckets than tasks.
BUCKET = 1 << 25
#: Bytes of passages that are ordered at once, about, and those of one anchor from which its strings are dealt.
PART = 1 << 19
WHOLE = 1 << 20
#: Positions that one suffix order holds at most; larger buckets are ordered with wider keys.
PACKED = 1 << 21


def _gram_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each k-byte gram, put together from grams of powers of two."""
    h, size, power = common.BYTE_VALUE[raw], 1, common.BASE
    done, out = 0, None
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if out is None:
                    out, done = h, size
                else:
                    n = len(raw) - done - size + 1
                    out = out[:n] * power + h[done : done + n]
                    done += size
            if size * 2 > k:
                break
            h = h[:-size] * power + h[size:]
            size, power = size * 2, power * power
        return common.mix(out)


def _smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w keys in a row."""
    size = 1
    while size * 2 <= w:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return keys if size == w else np.minimum(keys[: len(keys) - (w - size)], keys[w - size :])


def anchors(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """For stretches of texts laid end to end: (first byte, valid string starts, anchor hash and place of each start)."""
    lens = np.diff(off)
    i, n = 0, len(lens)
    while i < n:
        if lens[i] > SEGMENT:  # a long text in overlapping stretches
            for at in range(int(off[i]), int(off[i + 1]) - length + 1, SEGMENT - length + 1):
                to = min(int(off[i + 1]), at + SEGMENT)
                yield at, np.arange(to - at - length + 1), _keys(raw[at:to], length, gram)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, "right")) - 1)
        at, to = int(off[i]), int(off[j])
        if to - at >= length:
            room = np.repeat(off[i + 1 : j + 1] - at, lens[i:j])[: to - at - length + 1]
            yield at, np.flatnonzero(room - np.arange(len(room)) >= length), _keys(raw[at:to], length, gram)
        i = j


def _keys(raw: np.ndarray, length: int, gram: int) -> np.ndarray:
    h = _gram_hashes(raw, gram)
    return _smallest((h & ~_POS) | np.arange(len(h), dtype=np.uint64), length - gram + 1)


def _pack6(h: np.ndarray) -> bytes:
    """48-bit anchor hashes (as in keys, without the place) in 6 bytes each."""
    return (h >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack6(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1) << np.uint64(16)


def _dump(*arrays, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays, protocol=5))


def _load(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


# step 1


def _send_anchors(n_buckets: int, length: int, gram: int):
    """Rows (bucket, row, payload): anchors of a stretch of batches by bucket, and settled ones by row (bucket below 0)."""

    def send(h: np.ndarray, doc: np.ndarray):
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        once = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
        h, doc = h[once], doc[once]
        starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        many = np.diff(np.append(starts, len(h)))
        settled, many = np.repeat(many > 1, many), many > 1
        yield _settled(doc[settled], h[settled], n_buckets)
        # one row of each anchor stands for the stretch
        h, doc = h[starts], doc[starts]
        bucket = (h >> np.uint64(16)) % np.uint64(n_buckets)
        by = np.lexsort((doc, bucket))
        h, doc, many, bucket = h[by], doc[by], many[by], bucket[by]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        # ids rise in a bucket: their differences take little room
        rows = [_dump(_pack6(h[a:b]), np.diff(doc[a:b], prepend=0), np.packbits(many[a:b]), level=1) for a, b in zip(cut, np.append(cut[1:], len(h)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), pa.nulls(len(rows), pa.int64()), common.blobs(rows)], ["bucket", "row", "payload"])

    def run(batches):
        hashes: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        n = 0
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            raw, off = common.utf8_column(batch.column(1))
            for at, valid, keys in anchors(raw, off, length, gram):
                k = keys[valid]
                first = np.flatnonzero(np.concatenate(([len(k) > 0], k[1:] != k[:-1])))
                hashes.append(k[first] & ~_POS)
                docs.append(ids[np.searchsorted(off, at + valid[first], "right") - 1])
                n += len(first)
            if n >= STRETCH:
                yield from send(np.concatenate(hashes), np.concatenate(docs))
                hashes, docs, n = [], [], 0
        if n:
            yield from send(np.concatenate(hashes), np.concatenate(docs))

    return run


def _settled(doc: np.ndarray, h: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """Shared anchors by row, in buckets below 0: they only pass through the buckets' exchange."""
    by = np.argsort(doc, kind="stable")
    doc, h = doc[by], h[by]
    cut = np.flatnonzero(np.concatenate(([len(doc) > 0], doc[1:] != doc[:-1])))
    blobs = [_pack6(h[a:b]) for a, b in zip(cut, [*cut[1:], len(h)], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array((-1 - doc[cut] % n_buckets).astype(np.int32)), pa.array(doc[cut]), common.blobs(blobs)], ["bucket", "row", "payload"])


def _by_bucket(batches, each, name: str):
    """each(payloads) of every bucket of rows (bucket, row, payload) sorted by bucket; what is settled (bucket below 0)
    passes unchanged."""
    now, held = None, []
    for batch in batches:
        bucket = np.asarray(batch.column(0).to_numpy(zero_copy_only=False))
        settled = int(np.searchsorted(bucket, 0))
        if settled:
            yield pa.RecordBatch.from_arrays([c.slice(0, settled) for c in batch.columns[1:]], ["row", name])
        for b, p in zip(bucket[settled:].tolist(), batch.column(2).slice(settled).to_pylist(), strict=True):
            if b != now and held:
                yield from each(held)
                held = []
            now = b
            held.append(p)
    if held:
        yield from each(held)


def _shared_anchors(payloads):
    hs, docs, manys = [], [], []
    for p in payloads:
        h6, ids, many = _load(p)
        hs.append(_unpack6(h6))
        docs.append(np.cumsum(ids))
        manys.append(np.unpackbits(many, count=len(ids)).astype(bool))
    h, doc, many = np.concatenate(hs), np.concatenate(docs), np.concatenate(manys)
    by = np.argsort(h, kind="stable")
    h, doc, many = h[by], doc[by], many[by]
    size = np.diff([*np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))), len(h)])
    # entries that their batch has settled already need no second word, but tell the others
    shared = np.repeat(size > 1, size) & ~many
    out = _settled(doc[shared], h[shared], 1)
    yield pa.RecordBatch.from_arrays([out.column(1), out.column(2)], ["row", "hashes"])


# step 2


_UP, _DOWN = common._powers(common.BASE, SEGMENT), common._powers(common.INVERSE, SEGMENT)


def _contents(seg: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [s, e) of a segment."""
    total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(common.BYTE_VALUE[seg] * _UP[: len(seg)])))
    return common.mix((total[e] - total[s]) * _DOWN[s] + (e - s).astype(np.uint64))


def _passages(raw: np.ndarray, off: np.ndarray, shared: np.ndarray, length: int, gram: int):
    """(text, first byte, bytes, key) of the passages of shared anchors; shared: sorted (text << 48 | 48-bit hash)."""
    found: list[tuple] = []
    for at, valid, keys in anchors(raw, off, length, gram):
        k = keys[valid]
        if not len(k):
            continue
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        last = np.append(first[1:], len(k)) - 1
        s, n = valid[first], valid[last] - valid[first] + length
        text = np.searchsorted(off, at + s, "right") - 1
        h = (k[first] & ~_POS) >> np.uint64(16)
        own = text.astype(np.uint64) << np.uint64(48) | h
        hit = shared[np.minimum(np.searchsorted(shared, own), len(shared) - 1)] == own
        if hit.any():
            text, s, n = text[hit], s[hit], n[hit]
            found.append((text, at + s, n, common.mix(h[hit]), _contents(raw[at : at + len(keys) + length - 1], s, s + n)))
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else None


def _gathered(batches):
    """Batches put together up to GATHER bytes of text."""
    held, size = [], 0
    for batch in batches:
        batch = batch.filter(batch.column(3).is_valid())
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= GATHER or sum(b.num_rows for b in held) >= 1 << 14:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size bytes from a are those from b, for each of several passages (none of them empty)."""
    out, ends = np.empty(len(a), bool), np.cumsum(size)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + SEGMENT * 4, "right")))
        n = size[i:j]
        differ = raw[_ranges(a[i:j], n)] != raw[_ranges(b[i:j], n)]
        out[i:j] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
        i = j
    return out


def _equal_passages(raw: np.ndarray, start: np.ndarray, size: np.ndarray, content: np.ndarray, doc: np.ndarray):
    """(order, first of an equal run, whether it repeats a passage of a smaller document) of passages.

    The order is by content hash and document. Passages whose bytes differ from those of the first of their hash are
    runs by themselves."""
    by = np.lexsort((doc, content))
    c, d, s, n = content[by], doc[by], start[by], size[by]
    new = np.concatenate(([True], c[1:] != c[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    rest = np.flatnonzero(~new)
    own = rest[(n[rest] != n[head[rest]])]
    rest = rest[n[rest] == n[head[rest]]]
    own = np.concatenate((own, rest[~_same_bytes(raw, s[rest], s[head[rest]], n[rest])])).astype(np.int64)
    late = d != d[head]
    late[own] = False
    new[own] = True
    after = own + 1  # what follows such a one begins a run again
    new[after[after < len(new)]] = True
    return by, new, late


def _send_passages(n_buckets: int, length: int, gram: int):
    """Rows (bucket, row, payload) of rows (row, text, doc_id, hashes): passages by bucket, or (bucket below 0) settled
    spans by row."""

    def run(batches):
        for batch in _gathered(batches):
            rows, ids = (np.asarray(batch.column(c).to_numpy(), np.int64) for c in (0, 2))
            raw, off = common.utf8_column(batch.column(1))
            shared = np.concatenate([np.unique(np.concatenate([_unpack6(x) for x in hits])) >> np.uint64(16) | np.uint64(i) << np.uint64(48) for i, hits in enumerate(batch.column(3).to_pylist())])
            got = _passages(raw, off, shared, length, gram)
            if got is None:
                continue
            text, start, size, key, content = got
            by, new, late = _equal_passages(raw, start, size, content, ids[text])
            text, start, size, key = (x[by] for x in (text, start, size, key))
            doc, row, place = ids[text], rows[text], start - off[text]
            if late.any():
                yield _spans_by_row(row[late], np.stack((place[late], place[late] + size[late]), axis=1), lambda r: -1 - r % n_buckets)
            run_of = np.cumsum(new)
            doc, row, place, start, size, key, run_of = (x[~late] for x in (doc, row, place, start, size, key, run_of))
            # a row that holds a passage at several places sends it once
            by = np.lexsort((place, row, run_of))
            doc, row, place, start, size, key, run_of = (x[by] for x in (doc, row, place, start, size, key, run_of))
            first = np.flatnonzero(np.concatenate(([True], (run_of[1:] != run_of[:-1]) | (row[1:] != row[:-1]))))
            times = np.diff(np.append(first, len(doc)))
            bucket = (key[first] % np.uint64(n_buckets)).astype(np.int64)
            by = np.lexsort((place[first], doc[first], bucket))  # ids that rise take less room
            cut = np.flatnonzero(np.concatenate(([True], bucket[by][1:] != bucket[by][:-1])))
            payloads = []
            for a, b in zip(cut, np.append(cut[1:], len(by)), strict=True):
                one = first[by[a:b]]
                n, t, d = size[one], times[by[a:b]], doc[one]
                payloads.append(_dump(raw[_ranges(start[one], n)].tobytes(), n.astype(np.uint16), np.diff(d, prepend=0), row[one] - d, t.astype(np.uint32), place[_ranges(one, t)].astype(np.uint32), (key[one] >> np.uint64(40)).astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[by][cut].astype(np.int32)), pa.nulls(len(cut), pa.int64()), common.blobs(payloads)], ["bucket", "row", "payload"])

    return run


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + n[0] - 1, start[1] .. and so on."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _spans_by_row(rows: np.ndarray, spans: np.ndarray, bucket) -> pa.RecordBatch:
    by = np.argsort(rows, kind="stable")
    rows, spans = rows[by], spans[by]
    cut = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    blobs = [_spans(spans[i:j]) for i, j in zip(cut, np.append(cut[1:], len(rows)), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket(rows[cut]).astype(np.int32)), pa.array(rows[cut]), common.blobs(blobs)], ["bucket", "row", "payload"])


def _spans(spans: np.ndarray) -> bytes:
    """Merged [start, end) spans as bytes."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    cut = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > ends[:-1])))
    return np.stack((spans[cut, 0], np.append(ends[cut[1:] - 1], ends[-1])), axis=1).astype("<i8").tobytes()


# step 3


def prefix_ranks(raw: np.ndarray, length: int = LENGTH) -> list[tuple[int, np.ndarray]]:
    """Ranks of each position of raw by the first bytes from there (as far as they go), by prefix doubling: pairs of a
    number of bytes and ranks, from 4 (or length, if less) bytes to ``length``."""
    n = len(raw)
    padded = np.concatenate((raw, np.zeros(4, np.uint8))).astype(np.uint64)
    word = padded[:n] << np.uint64(24) | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(8) | padded[3 : n + 3]
    if length < 4:
        word = word >> np.uint64(8 * (4 - length))
    rank, known = _ranked(word, None), min(4, length)
    levels = [(known, rank)]
    while known < length:
        step = min(known, length - known)
        after = np.zeros(n, np.uint64)  # the rest of the bytes counts as smallest
        after[: max(0, n - step)] = rank[step:] + np.uint64(1)
        rank, known = _ranked(rank, after), known + step
        levels.append((known, rank))
    return levels


def _ranked(high: np.ndarray, low: np.ndarray | None) -> np.ndarray:
    """Dense ranks of the pairs (high, low)."""
    n = len(high)
    if low is None and n <= 1 << 32:
        key = np.sort(high << np.uint64(32) | np.arange(n, dtype=np.uint64))
        order, value = (key & np.uint64(0xFFFFFFFF)).astype(np.int64), key >> np.uint64(32)
    elif n < PACKED:  # three numbers of 21 bits in one key: one plain sort
        key = np.sort(high << np.uint64(42) | low << np.uint64(21) | np.arange(n, dtype=np.uint64))
        order, value = (key & np.uint64(PACKED - 1)).astype(np.int64), key >> np.uint64(21)
    else:
        order = np.lexsort((low, high))
        out = np.zeros(n, np.uint64)
        out[order[1:]] = np.cumsum((high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]]))
        return out
    out = np.zeros(n, np.uint64)
    out[order[1:]] = np.cumsum(value[1:] != value[:-1])
    return out


def nearest_smaller(values: np.ndarray, reverse: bool = False) -> np.ndarray:
    """For each place the nearest one before it (after it, if reverse) with a smaller value; -1 where there is none.

    Pointers jump to their pointer's pointer until all rest on a smaller value: the places jumped over are no smaller.
    """
    if reverse:
        got = nearest_smaller(values[::-1])
        return np.where(got >= 0, len(values) - 1 - got, -1)[::-1]
    to = np.arange(-1, len(values) - 1)
    live = np.flatnonzero(to >= 0)
    while len(live):
        live = live[values[to[live]] >= values[live]]
        to[live] = to[to[live]]
        live = live[to[live] >= 0]
    return to


def _matched(raw: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of positions a and b of raw, up to the largest of the levels."""
    length, last = levels[-1]
    out = np.where(last[a] == last[b], length, 0)
    open_ = np.flatnonzero(out == 0)
    a, b, n = a[open_], b[open_], np.zeros(len(open_), np.int64)
    for size, rank in reversed(levels[:-1]):
        n += size * (rank[np.minimum(a + n, len(rank) - 1)] == rank[np.minimum(b + n, len(rank) - 1)])
    on = np.ones(len(n), bool)
    for _ in range(3):  # what is shorter than the first level, byte by byte
        on &= (raw[np.minimum(a + n, len(raw) - 1)] == raw[np.minimum(b + n, len(raw) - 1)]) & (n < length)
        n += on
    out[open_] = np.minimum(n, length - 1)
    return out


def longest_previous_factors(raw: np.ndarray, starts: np.ndarray, doc: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each of the positions ``starts`` of raw (each of document doc, with ``length`` bytes behind it) the length,
    up to ``length``, of its longest match with a position of a smaller document.

    In suffix order that match is with the previous or the next position of a smaller document."""
    levels = prefix_ranks(raw, length)
    rank = levels[-1][1][starts]
    if len(rank) <= 1 << 32:
        order = (np.sort(rank << np.uint64(32) | np.arange(len(rank), dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    else:
        order = np.argsort(rank, kind="stable")
    d, at = doc[order], starts[order]
    factor = np.zeros(len(order), np.int64)
    for near in (nearest_smaller(d), nearest_smaller(d, reverse=True)):
        has = np.flatnonzero((near >= 0) & (factor < length))
        factor[has] = np.maximum(factor[has], _matched(raw, levels, at[has], at[near[has]]))
    out = np.zeros(len(order), np.int64)
    out[order] = factor
    return out


def _string_hashes(raw: np.ndarray, first: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """For each ``length``-byte string of passages, in order, a 64-bit hash."""
    out, ends, at = np.empty(int((size - length + 1).sum()), np.uint64), np.cumsum(size), 0
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + SEGMENT * 4, "right")))
        n = size[i:j]
        h = _gram_hashes(raw[_ranges(first[i:j], n)], length)
        h = common.mix(h[_ranges(np.cumsum(n) - n, n - length + 1)])
        out[at : at + len(h)] = h
        at, i = at + len(h), j
    return out


def _strings(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return raw[at[:, None] + np.arange(length)]


def _factors_of_strings(raw: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    return longest_previous_factors(_strings(raw, at, length).ravel(), np.arange(len(at)) * length, doc, length)


def _repeats(raw: np.ndarray, first: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Whether each ``length``-byte string of passages, in order, has an earlier match among them."""
    n = size - length + 1
    total = int(size.sum())
    if total <= WHOLE:
        owner = np.repeat(np.arange(len(first)), n)
        starts = (np.cumsum(size) - size)[owner] + _ranges(np.zeros(len(first), np.int64), n)
        return longest_previous_factors(raw[_ranges(first, size)], starts, doc[owner], length) >= length
    return _repeats_by_hash(raw, first, size, doc, length)


def _repeats_by_hash(raw: np.ndarray, first: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """_repeats() of passages that are too many to be put in suffix order at once.

    Strings are gathered by hash, a block of hash values at a time. Of each group that several documents hold, two
    strings go into suffix order, that of the smallest document and one of another, WHOLE bytes at a time; where these
    match, the group's others are held against the first byte by byte. Groups in which bytes differ under one hash are put
    in suffix order whole. So memory is the hashes (8 bytes a string) and what WHOLE bounds, however often a string occurs."""
    n = size - length + 1
    begin = np.cumsum(n) - n
    h = _string_hashes(raw, first, size, length)
    out = np.zeros(len(h), bool)
    bits = np.uint64(max(1, (len(h) * length // (4 * WHOLE)).bit_length()))
    room = max(2, WHOLE // length)
    for block in range(1 << int(bits)):
        mine = np.flatnonzero(h >> (np.uint64(64) - bits) == np.uint64(block))
        if len(mine) < 2:
            continue
        owner = np.searchsorted(begin, mine, "right") - 1
        order = np.lexsort((doc[owner], h[mine]))
        mine, owner = mine[order], owner[order]
        d, at, key = doc[owner], first[owner] + mine - begin[owner], h[mine]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(mine))))
        later = np.flatnonzero(d > d[head[group]])
        if not len(later):
            continue
        shared, where = np.unique(group[later], return_index=True)
        odd = np.zeros(len(head), bool)
        for i in range(0, len(shared), room // 2):
            some = shared[i : i + room // 2]
            pair = np.stack((head[some], later[where[i : i + room // 2]]), axis=1).ravel()
            odd[some] = _factors_of_strings(raw, at[pair], d[pair], length).reshape(-1, 2)[:, 1] < length
        later = later[~odd[group[later]]]
        for i in range(0, len(later), room):
            some = later[i : i + room]
            same = (_strings(raw, at[some], length) == _strings(raw, at[head[group[some]]], length)).all(1)
            out[mine[some]] = same
            odd[group[some[~same]]] = True
        odd = np.flatnonzero(odd[group])
        if len(odd):
            out[mine[odd]] = _factors_of_strings(raw, at[odd], d[odd], length) >= length
    return out


def _passage_names(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of passages' bytes, by stretches of about SEGMENT bytes."""
    out = np.empty(len(start), np.uint64)
    ends = np.cumsum(size)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + SEGMENT, "right")))
        n = size[i:j]
        s = np.cumsum(n) - n
        out[i:j] = _contents(raw[_ranges(start[i:j], n)], s, s + n)
        i = j
    return out


def _removed(length: int):
    def run(payloads):
        parts = [_load(p) for p in payloads]
        raw = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
        doc = np.concatenate([np.cumsum(p[2]) for p in parts])
        size, row, times, place, key = (np.concatenate([p[i] for p in parts]) for i in (1, 3, 4, 5, 6))
        row += doc
        size, times, place = size.astype(np.int64), times.astype(np.int64), place.astype(np.int64)
        del parts
        first, begin = np.cumsum(size) - size, np.cumsum(times) - times
        groups = max(1, len(raw) // PART)
        group = key % groups

        def spans(owner, start, end):
            """Byte ranges [start, end) of passages, for each place at which their rows hold them."""
            t = times[owner]
            at = place[_ranges(begin[owner], t)]
            out = _spans_by_row(np.repeat(row[owner], t), np.stack((np.repeat(start, t) + at, np.repeat(end, t) + at), axis=1), lambda r: r * 0)
            return pa.RecordBatch.from_arrays(out.columns[1:], ["row", "spans"])

        by = np.argsort(group, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], group[by][1:] != group[by][:-1])))
        for a, b in zip(cut, np.append(cut[1:], len(by)), strict=True):
            own = np.sort(by[a:b])
            # equal passages of other batches: the smallest document keeps it, the others lose all of it
            order, _, late = _equal_passages(raw, first[own], size[own], _passage_names(raw, first[own], size[own]), doc[own])
            own = own[order]
            gone, own = own[late], own[~late]
            if len(gone):
                yield spans(gone, np.zeros(len(gone), np.int64), size[gone])
            # an anchor with one passage left has nothing to be compared with
            _, code, held = np.unique(key[own], return_inverse=True, return_counts=True)
            own = np.sort(own[held[code] > 1])
            if not len(own):
                continue
            n = size[own] - length + 1
            hit = np.flatnonzero(_repeats(raw, first[own], size[own], doc[own], length))
            if not len(hit):
                continue
            start = np.cumsum(n) - n
            passage = np.searchsorted(start, hit, "right") - 1
            within = hit - start[passage]
            # runs of hits in a passage
            edge = np.flatnonzero(np.concatenate(([True], (passage[1:] != passage[:-1]) | (within[1:] != within[:-1] + 1))))
            yield spans(own[passage[edge]], within[edge], within[np.append(edge[1:], len(within)) - 1] + length)

    return run


# step 4

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def _cut_out(with_text: bool):
    schema = _OUT if with_text else pa.schema([f for f in _OUT if f.name not in ("kept", "spans")])

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: list[dict] = []
            for i, (doc_id, blobs) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                text = raw[off[i] : off[i + 1]].tobytes()
                spans = np.frombuffer(_spans(np.frombuffer(b"".join(blobs), "<i8").reshape(-1, 2)), "<i8").reshape(-1, 2).tolist() if blobs else []
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                row = {"doc_id": doc_id, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(spans), "spans": spans, "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()}
                rows.append({f.name: row[f.name] for f in schema})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _dealt(rows: DataFrame, n: int, each, name: str) -> DataFrame:
    """Rows dealt by bucket, each bucket worked through; what comes out is gathered by row."""
    dealt = rows.repartition(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _by_bucket(batches, each, name), f"row long, {name} binary").groupBy("row").agg(F.collect_list(name).alias(name))


def _with_row(d: DataFrame) -> DataFrame:
    """d(doc_id, text), no doc_id null, with row: the doc_id, or where some repeat a number of each different row."""
    if d.groupBy("doc_id").count().where("count > 1").isEmpty():
        return d.withColumn("row", F.col("doc_id"))
    tagged = d.withColumn("tag", F.sha2("text", 256))
    numbers = common.written(tagged.select("doc_id", "tag").distinct().withColumn("row", F.monotonically_increasing_id()), "rows")
    return common.written(tagged.join(numbers, (tagged["doc_id"] == numbers["doc_id"]) & tagged["tag"].eqNullSafe(numbers["tag"])).select(tagged["doc_id"], "text", "row"), "numbered")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with with_text also
    spans (removed byte ranges) and kept (the remaining bytes)."""
    if not 1 <= gram <= length <= min(SEGMENT, 30_000):
        raise ValueError("1 <= gram <= length <= 30000 is needed")
    spark = docs.sparkSession
    common.bound_batches(spark)
    n = 2 * common.partitions(spark)
    all_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = _with_row(all_.where("doc_id is not null"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(n, min(1 << 30, -(-total // BUCKET)))
    # many small buckets, so that a bucket holds few anchors of a row whatever the size
    sent = d.where("text is not null").select("row", "text").mapInArrow(_send_anchors(4 * n, length, gram), "bucket int, row long, payload binary")
    shared = _dealt(sent, n, _shared_anchors, "hashes")
    passages = d.join(shared.hint("shuffle_hash"), "row", "left").select("row", "text", "doc_id", "hashes").mapInArrow(_send_passages(buckets, length, gram), "bucket int, row long, payload binary")
    spans = _dealt(passages, n, _removed(length), "spans")
    kinds = {"spans": "array<array<long>>", "kept": "binary", "kept_sha256": "string"}
    schema = ", ".join(f"{f.name} {kinds.get(f.name, 'long')}" for f in _OUT if with_text or f.name not in ("kept", "spans"))
    named = d.join(spans.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spans").mapInArrow(_cut_out(with_text), schema)
    # rows without a doc_id meet no others, so they need not be dealt
    rest = all_.where("doc_id is null").withColumn("spans", F.lit(None).cast("array<binary>"))
    return named.unionByName(rest.mapInArrow(_cut_out(with_text), schema))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"), with_text=False)
