"""Vector codes: each vector is cut into parts, and each part is written as the number of its codebook's nearest entry.

Codebooks are refined in rounds: all parts are assigned to their nearest entries (squared Euclidean distances of
integers, ties to the lower number), then each entry becomes the floor of the mean of its parts; entries without parts
stay. A last assignment gives codes and errors. All figures are exact integers, so results don't depend on the order
of rows, on partitions or on the machine.

Bounds by norms of sums save most distances. Entries are dealt into groups; a part keeps, for each group, a lower bound
of its distance to the group's entries other than its own, together with the round in which it was taken. All
codebooks of earlier rounds are kept, so that in a later round the bound falls by the largest *net* displacement of the
group's entries since then, |c_now - c_then|, the norm of the sum of their moves. That is never more, and often far
less, than the sum of the norms of the moves that bounds updated round by round would pay. Only groups whose bound
doesn't exceed the exact distance to the part's present entry are gone through again, exactly.

One pass over the table a round: it reads the last round's state (codes and bounds), and writes the new state together
with its own sums of parts by entry (a file apart), which are added up to the new codebooks: parts x ENTRIES rows a
task, and parts x ENTRIES rows to the driver. Codebooks and their history (rounds x parts x ENTRIES entries) are all
that is sent to tasks. States are tables in the shared folder, so lost executors cost the tasks of one round.

Defined cases: vectors that are null, or hold a null, NaN or infinite component, are dropped. Shorter vectors count as
ended by zeros, up to the longest length, and that up to a multiple of the number of parts. Rows of equal id are
separate rows; codebooks start from the smallest ids (ties by vector), rows without an id last. With fewer rows than
entries, codebooks have as many entries as rows. Components beyond ``limit_for`` (about 100,000 for 64 dimensions)
count as that, as errors would not fit 64 bits. Other columns are left behind. An empty table, or one of which
nothing is kept, gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
GROUPS = 16
#: Up to so many labels are sent to every executor (16 bytes each).
BROADCAST_LABELS = 200_000
#: Bounds are loosened by this part, far more than rounding could make them wrong.
SLACK = 1e-9


def limit_for(dims: int) -> int:
    """Largest integer component for which squared distances of whole vectors fit 63 bits."""
    return math.isqrt(2**60 // max(1, dims))


# Vectors


def _length(col: pa.Array) -> np.ndarray:
    return np.diff(np.asarray(col.offsets)) if len(col) else np.zeros(0, np.int64)


def _integers(col: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept rows, their integer vectors) of a list column."""
    values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    good = np.isfinite(values)
    if col.values.null_count:
        good &= ~np.asarray(col.values.is_null())
    starts, sizes = np.asarray(col.offsets)[:-1].astype(np.int64), _length(col)
    bad = np.concatenate(([0], np.cumsum(~good)))
    kept = np.flatnonzero(np.asarray(col.is_valid()) & (bad[starts + sizes] == bad[starts]))
    limit = limit_for(dims)
    out = np.zeros((len(kept), dims), np.int64)
    at = np.arange(dims)
    inside = at < sizes[kept, None]
    whole = np.clip(np.floor(values[(starts[kept, None] + at)[inside]] * scale), -limit, limit)
    out[inside] = whole.astype(np.int64)
    return kept, out


class Codebooks(NamedTuple):
    """Codebooks of all rounds so far (rounds x parts x entries x width), and the group of each part's entries."""

    history: np.ndarray
    groups: np.ndarray

    @property
    def now(self) -> np.ndarray:
        return self.history[-1]

    def moved(self) -> np.ndarray:
        """(rounds, parts, groups): the farthest that an entry of the group is now from where it was then."""
        net = np.sqrt(((self.now - self.history).astype(np.float64) ** 2).sum(3))
        return np.stack([np.where(self.groups == g, net, 0).max(2) for g in range(GROUPS)], axis=2)


def _grouped(book: np.ndarray) -> np.ndarray:
    """For each part the group of each entry: the nearest of GROUPS entries that lie far from each other."""
    out = np.zeros(book.shape[:2], np.int64)
    for p, entries in enumerate(book.astype(np.float64)):
        near = ((entries - entries[0]) ** 2).sum(1)
        for g in range(1, min(GROUPS, len(entries))):
            d = ((entries - entries[near.argmax()]) ** 2).sum(1)
            out[p][d < near] = g
            near = np.minimum(near, d)
    return out


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all entries. Both are int64; products are taken in floating point
    where they stay below 2**53, which gives the same."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * x.shape[1] * int(most) ** 2 < 2**53 else np.int64
    x, entries = x.astype(kind), entries.astype(kind)
    return ((x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)).astype(np.int64)


class State(NamedTuple):
    """Of each row and part: code, lower bound of each group, and the round of each bound."""

    code: np.ndarray
    bound: np.ndarray
    stamp: np.ndarray

    @classmethod
    def unknown(cls, n: int, parts: int) -> State:
        return cls(np.zeros((n, parts), np.uint8), np.full((n, parts, GROUPS), -1.0, np.float32), np.zeros((n, parts, GROUPS), np.uint8))


def assign(x: np.ndarray, books: Codebooks, was: State, moved: np.ndarray) -> tuple[State, np.ndarray, int]:
    """(new state, squared distances (rows, parts), exact distances taken) of rows x (rows, dims)."""
    n, parts, now = len(x), len(books.now), len(books.history) - 1
    code, bound, stamp = was.code.copy(), was.bound.copy(), was.stamp.copy()
    error = np.zeros((n, parts), np.int64)
    taken = 0
    for p, part in enumerate(np.split(x, parts, axis=1)):
        entries, group = books.now[p], books.groups[p]
        old = code[:, p].astype(np.int64)
        best, at = ((part - entries[old]) ** 2).sum(1), old.copy()
        taken += n
        # bounds as they are now: down by the net moves since each was taken
        lower = bound[:, p].astype(np.float64) - moved[stamp[:, p].astype(np.int64), p, np.arange(GROUPS)]
        again = lower * (1 - SLACK) <= np.sqrt(best.astype(np.float64))[:, None] * (1 + SLACK)
        own = group[old]
        seen = []
        for g in range(GROUPS):
            mine, rows = np.flatnonzero(group == g), np.flatnonzero(again[:, g])
            if not len(mine):
                bound[:, p, g] = np.inf
                continue
            if not len(rows):
                continue
            d = _squares(part[rows], entries[mine])
            taken += d.size
            first = d.argmin(1)  # the first of equals: the lowest number
            least, number = d[np.arange(len(rows)), first], mine[first]
            better = (least < best[rows]) | ((least == best[rows]) & (number < at[rows]))
            best[rows[better]], at[rows[better]] = least[better], number[better]
            seen.append((g, rows, mine, d))
        # bounds anew where distances were taken, over entries other than the row's own
        for g, rows, mine, d in seen:
            free = np.where(mine[None, :] == at[rows, None], np.inf, np.sqrt(d.astype(np.float64)))
            bound[rows, p, g] = np.nextafter(free.min(1).astype(np.float32), np.float32(-np.inf))
            stamp[rows, p, g] = now
        # a row that left its entry counts it among the others of that entry's group, if that wasn't gone through
        left = np.flatnonzero((at != old) & ~again[np.arange(n), own])
        if len(left):
            g = own[left]
            d = np.sqrt(((part[left] - entries[old[left]]) ** 2).sum(1).astype(np.float64))
            bound[left, p, g] = np.nextafter(np.minimum(lower[left, g], d).astype(np.float32), np.float32(-np.inf))
            stamp[left, p, g] = now
        code[:, p], error[:, p] = at, best
    return State(code, bound, stamp), error, taken


# Tables


_STATE = "id {id}, label {label}, vector binary, code binary, bound binary, stamp binary, error long"


def _packed(a: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(a).reshape(len(a), math.prod(a.shape[1:]))
    width = raw.shape[1] * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((np.arange(len(a) + 1) * width).astype(np.int32)), pa.py_buffer(raw.tobytes())])


def _unpacked(col: pa.Array, kind, shape: tuple) -> np.ndarray:
    _, off, data = col.buffers()
    if not len(col) or data is None:
        return np.zeros((len(col), *shape), kind)
    off = np.frombuffer(off, np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]].view(kind).reshape(len(col), *shape)


def _first_states(dims: int, parts: int, scale: int):
    def run(batches):
        for batch in batches:
            kept, x = _integers(batch.column(2), dims, scale)
            none = State.unknown(len(kept), parts)
            take = pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), _packed(x), _packed(none.code), _packed(none.bound), _packed(none.stamp), pa.array(np.zeros(len(kept), np.int64))], ["id", "label", "vector", "code", "bound", "stamp", "error"])

    return run


def _round(books: Codebooks, dims: int, last: bool):
    """State rows of a round; then, from each task, its sums: rows with ``sums`` set and no state."""
    parts, width = books.now.shape[0], books.now.shape[2]
    moved = books.moved()
    names = ["id", "label", "vector", "code", "bound", "stamp", "error", "sums"]

    def run(batches):
        size = books.now.shape[1]
        total, count, kinds = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64), None
        for batch in batches:
            kinds = [batch.column(0).type, batch.column(1).type]
            n = batch.num_rows
            x = _unpacked(batch.column(2), np.int64, (dims,))
            was = State(_unpacked(batch.column(3), np.uint8, (parts,)), _unpacked(batch.column(4), np.float32, (parts, GROUPS)), _unpacked(batch.column(5), np.uint8, (parts, GROUPS)))
            new, error, _ = assign(x, books, was, moved)
            if not last:
                for p, part in enumerate(np.split(x, parts, axis=1)):
                    code = new.code[:, p]
                    order = np.argsort(code, kind="stable")
                    met, first = np.unique(code[order], return_index=True)
                    total[p, met] += np.add.reduceat(part[order], first, axis=0) if n else 0
                    count[p] += np.bincount(code, minlength=size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), _packed(new.code), _packed(new.bound), _packed(new.stamp), pa.array(error.sum(1)), pa.nulls(n, pa.binary())], names)
        if kinds and not last:
            sums = np.concatenate([total, count[:, :, None]], axis=2)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, k) for k in (*kinds, *[pa.binary()] * 4, pa.int64())] + [pa.array([sums.tobytes()], pa.binary())], names)

    return run


def _next_book(sums: DataFrame, book: np.ndarray) -> np.ndarray:
    """Floors of means; sums are added up by entry in the cluster, and come to the driver as parts x entries rows."""
    parts, size, width = book.shape

    def entries(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                a = np.frombuffer(raw, np.int64).reshape(parts * size, width + 1)
                used = np.flatnonzero(a[:, -1])
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * (width + 1), pa.array(a[used].ravel()))], ["entry", "sums"])

    each = sums.mapInArrow(entries, "entry long, sums array<long>")
    added = each.groupBy("entry").agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width + 1))).collect()
    new = book.reshape(parts * size, width).copy()
    for row in added:
        new[row[0]] = [s // row[width + 1] for s in row[1 : width + 1]]
    return new.reshape(book.shape)


def encode(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept row: the id, code, error, label_error, codebooks_sha256. Codes are bytes, so entries are 256 at most."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    spark = vectors.sparkSession
    common.bound_batches(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dims = max(parts, -(-longest // parts) * parts)
    scratch = common.Scratch(spark, "vector-codes")
    schema = _STATE.format(id=rows.schema["id"].dataType.simpleString(), label=rows.schema["label"].dataType.simpleString())
    state = scratch.written(rows.mapInArrow(_first_states(dims, parts, scale), schema), "vectors")
    first = state.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()  # entries rows at most
    if not first:
        scratch.clear()
        return rows.limit(0).select(F.col("id").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    start = np.stack([np.frombuffer(r[0], np.int64) for r in first]).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    books = Codebooks(start[None], _grouped(start))
    for i in range(rounds + 1):
        whole = scratch.written(state.mapInArrow(_round(books, dims, i == rounds), f"{schema}, sums binary"), f"round{i}")
        state = whole.where("sums is null").drop("sums")
        if i < rounds:
            books = books._replace(history=np.concatenate([books.history, _next_book(whole.where("sums is not null").select("sums"), books.now)[None]]))
    digest = hashlib.sha256(",".join(map(str, books.now.ravel().tolist())).encode()).hexdigest()
    by_label = scratch.written(state.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    few = by_label.count() <= BROADCAST_LABELS
    coded = state.select(F.col("id").alias(id_col), "label", common.ordered_hex(F.col("code")).alias("code"), "error")
    joined = coded.join(F.broadcast(by_label) if few else by_label, coded["label"].eqNullSafe(by_label["label"]), "left")
    out = common.written(joined.select(id_col, "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), "vector-codes")
    scratch.clear()
    return out


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "embeddings"))
