"""Document fingerprints by Order MinHash.

A text is taken as its k-mers of code points, each numbered by its occurrence (the second "abcdefgh" differs from
the first). For each of ``hashes`` hash functions the ``ell`` occurrence-numbered k-mers of smallest hash are
selected, put in the order in which they stand in the text, and the tuple of their k-mers is hashed to 32 bits. Two
texts agree in an entry with a probability that falls with their edit distance, not only with their sets of k-mers:
moving passages changes the order. The likeness of two fingerprints is the part of entries that agree.

The fingerprint is written as 8 hex digits for each entry. Texts of fewer than k code points are one k-mer by
themselves; null and empty texts have the fingerprint of no k-mers, alike only to each other. Equal texts have equal
fingerprints. Texts are hashed in stretches, so that memory stays at some times the text's size.

``with_edits`` compares each document with the next in descending doc_id order (after the last: the first) and with
its edited text. Documents are dealt into ranges of doc_id by one shuffle; the document on which a range begins is
also sent to the range before it, so each range is worked through in order, one document at a time, with nothing
held but the last one. Documents without an id come last; equal ids are in the order of their texts. Repeated rows
each count as a document. An empty table gives no rows. Extra columns are left behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

K = 8
ELL = 2
HASHES = 32
#: k-mers that are hashed at once.
STRETCH = 1 << 14

_SEEDS = np.random.default_rng(20240).integers(0, 2**32, 1024, dtype=np.uint32)
_ODD = np.random.default_rng(20241).integers(0, 2**32, 1024, dtype=np.uint32) | np.uint32(1)
NONE = np.uint32(0xFFFFFFFF)


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-mer of code points; of the whole where it is shorter."""
    if not len(points):
        return np.zeros(0, np.uint64)
    k = min(k, len(points))
    v = points.astype(np.uint64) + np.uint64(1)
    n = len(v) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= common.BASE
        out += v[i : i + n]
    return common.mix(out + np.uint64(k))


def _numbered(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hash of k-mer and occurrence number, position), for each k-mer, sorted by k-mer and position."""
    n = len(kmers)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    order = (kmers & ~mask) | np.arange(n, dtype=np.uint64)  # one plain sort by k-mer, then position
    order.sort()
    at = (order & mask).astype(np.int64)
    key = order & ~mask
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return (common.mix(key + number.astype(np.uint64) * common.BASE) >> np.uint64(32)).astype(np.uint32), at


def fingerprint(text: str, k: int = K, ell: int = ELL, hashes: int = HASHES) -> np.ndarray:
    """The ``hashes`` entries of a text's fingerprint."""
    kmers = _kmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), k)
    if not len(kmers):
        return np.full(hashes, NONE, np.uint32)
    x, at = _numbered(kmers)
    seeds, odd = _SEEDS[:hashes, None], _ODD[:hashes, None]
    rows = np.arange(hashes)
    best_h = np.zeros((hashes, 0), np.uint32)
    best_at = np.zeros((hashes, 0), np.int64)
    for i in range(0, len(x), STRETCH):
        h = (x[None, i : i + STRETCH] ^ seeds) * odd
        pos = at[i : i + STRETCH]
        got_h, got_at = [best_h], [best_at]
        for j in range(min(ell, h.shape[1])):
            a = h.argmin(axis=1)
            got_h.append(h[rows, a][:, None])
            got_at.append(pos[a][:, None])
            if j + 1 < ell:
                h[rows, a] = NONE
        all_h, all_at = np.concatenate(got_h, axis=1), np.concatenate(got_at, axis=1)
        keep = np.lexsort((all_at, all_h), axis=1)[:, :ell]
        best_h, best_at = np.take_along_axis(all_h, keep, 1), np.take_along_axis(all_at, keep, 1)
    chosen = kmers[np.sort(best_at, axis=1)]
    out = np.zeros(hashes, np.uint64)
    for j in range(chosen.shape[1]):
        out = common.mix(out * common.BASE + chosen[:, j])
    return np.minimum((out >> np.uint64(32)).astype(np.uint32), NONE - np.uint32(1))


def written(entries: np.ndarray) -> str:
    return entries.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, k: int = K, ell: int = ELL, hashes: int = HASHES) -> DataFrame:
    """docs(doc_id, text) with n_chars and fingerprint, where they are scanned."""
    common.bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([written(fingerprint(t, k, ell, hashes)) for t in texts], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def with_edits(docs: DataFrame, k: int = K, ell: int = ELL, hashes: int = HASHES) -> DataFrame:
    """Each document of docs(doc_id, text) beside its edited text and the next document."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = min(1024, 2 * common.partitions(spark))
    head = d.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("b"), F.max("doc_id").alias("top"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("no_id"), F.count("*").alias("n")).first()
    # ranges descend: range r holds ids from bounds[r] downwards; bounds[0] is the largest id
    bounds = sorted({*(head["b"] or []), *([] if head["top"] is None else [head["top"]])}, reverse=True)
    last = max(0, len(bounds) - 1)
    at_least = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("doc_id"))) - 1 if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(at_least).cast("int")
    here = F.struct(part.alias("part"), F.lit(0).alias("next"))
    # the ids on which ranges begin also close the range before; the largest closes the last one
    before = F.struct(F.when(part == 0, F.lit(last)).otherwise(part - 1).cast("int").alias("part"), F.lit(1).alias("next"))
    begins = F.col("doc_id").isin(bounds) if bounds else F.col("doc_id").isNull()
    dealt = d.select(F.explode(F.when(begins, F.array(here, before)).otherwise(F.array(here))).alias("p"), "doc_id", "text").select("p.part", "p.next", "doc_id", "text")
    dealt = dealt.repartition(max(1, len(bounds)), "part").sortWithinPartitions("part", "next", F.col("doc_id").desc_nulls_last(), "text")

    def run(batches):
        held = None  # (part, doc_id, text, fingerprint) that waits for the next document
        remembered: dict[str, np.ndarray] = {}

        def of(text):
            if text not in remembered:
                if len(remembered) > 4:
                    remembered.clear()
                remembered[text] = fingerprint(text, k, ell, hashes)
            return remembered[text]

        for batch in batches:
            rows: list[tuple] = []
            for p, is_next, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == p:
                    _, own_id, own, print_ = held
                    cut = len(own) // 2
                    edited = own[: len(own) - cut] + text[:cut]
                    theirs, after = of(text), of(edited)
                    rows.append((own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(print_), written(after), likeness(print_, after), likeness(print_, theirs)))
                # of several documents that begin the next range, the first one is next
                held = None if is_next else (p, doc_id, text, of(text))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_OUT), _OUT, strict=True)], schema=_OUT)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_order_minhash(spark, sf_dir: str) -> DataFrame:
    return with_edits(common.table(spark, sf_dir, "documents"))
