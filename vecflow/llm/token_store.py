"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank in the corpus (most frequent first, ties by id), so common ids take one byte. Four
ranks share a control byte, two bits each for a length of one to four bytes; control bytes and data bytes are kept
in separate streams, and a reader finds lengths of four ranks with one look into a 256-row numpy table.

The files are Parquet tables of blocks. A block holds consecutive documents of one shard: their ids, their numbers
of tokens, the numbers of all tokens of it and of the shard before it, and the two streams. Shards are ranges of doc_id, so
(shard, block) ascending is doc_id ascending; documents of equal doc_id are in the order of their ids' bytes,
in each of the shards that an id of many documents takes (dealt by a hash of those bytes).

Stages: texts are encoded once where they are scanned; ids are dealt into ranges of doc_id (the one shuffle, of
compressed ids), packed into blocks and written; ranks come from counts of all ids (one row for each id of the
vocabulary reaches the driver); blocks are coded in a second pass over the first files, without a shuffle. Every
stage starts from files in the shared folder, so a lost executor costs its tasks only.

Null and empty texts give the end id alone. Documents without a doc_id come first. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecflow.llm import common, tokens

#: A block is closed once it holds so many ids.
BLOCK_IDS = 1 << 17

# the coding

_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(ranks, "<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    pad = np.zeros(-len(v) % 4, np.uint8)
    codes = np.concatenate((extra, pad)).reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    kept = np.arange(4, dtype=np.uint8)[None, :] <= extra[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of the two streams, by table lookup."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8)[None, :] < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


# the stages


def _range_bounds(docs: DataFrame, n: int) -> tuple[list[int], int]:
    """(bounds, more): bounds of n ranges of doc_id with about equal numbers of rows, an id as often as it is a bound,
    and how many further ranges rows without an id take."""
    if n < 2:
        return [], 0
    got = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n), F.count("*"), F.count("doc_id")).first()
    return sorted(got[0] or []), n * (got[1] - got[2]) // max(1, got[1])


def shards_of(ids: np.ndarray, none: np.ndarray, dealt: np.ndarray, bounds: list[int], more: int) -> np.ndarray:
    """Shards of documents, rising with the id, none first. An id that is a bound m times has m shards, and so have rows
    without an id more + 1, over which ``dealt``, evenly drawn 32-bit numbers, deal them."""
    edges = np.array(bounds, np.int64)
    lo, hi = np.searchsorted(edges, ids, "left"), np.searchsorted(edges, ids, "right")
    share = lambda m: (dealt.astype(np.uint64) * m.astype(np.uint64)) >> np.uint64(32)
    own = more + np.where(hi > lo, lo + 1 + share(hi - lo).astype(np.int64), hi)
    return np.where(none, share(np.full(len(ids), more + 1)).astype(np.int64), own).astype(np.int32)


def _tokenise(docs: DataFrame, tokenizer: str, end_id: int, bounds: list[int], more: int) -> DataFrame:
    """Rows (shard, doc_id, n, packed)."""
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("packed", pa.binary())])

    def run(batches):
        enc, z = tokens.encoder(tokenizer, added=True), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            n, packed = [], []
            for text in tokens.texts(batch.column(1)):
                ids = np.frombuffer(enc.encode_bytes(text) + end, "<u4")
                n.append(len(ids))
                packed.append(z.compress(ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\xff" + ids.tobytes()))
            doc_ids = batch.column(0)
            dealt = np.array([zlib.crc32(x) for x in packed], np.uint32)
            shard = shards_of(doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False), dealt, bounds, more)
            yield pa.RecordBatch.from_arrays([pa.array(shard), doc_ids, pa.array(n, pa.int64()), common.blobs(packed)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "shard int, doc_id long, n long, packed binary")


def _unpack(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw[1:], "<u4") if len(raw) & 1 else np.frombuffer(raw, "<u2").astype("<u4")


_BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("total", pa.int64()), ("doc_ids", pa.binary()), ("no_id", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())])
_BLOCK_SQL = "shard int, block int, before long, total long, doc_ids binary, no_id binary, counts binary, ids binary"


def _blocks(batches):
    """Blocks of rows (shard, doc_id, n, packed) that come sorted by shard and document."""
    z = zstandard.ZstdCompressor(level=1)
    shard, block, before, held, size = None, 0, 0, [], 0

    def close():
        ids = np.concatenate([_unpack(p) for _, _, p in held])
        raw = b"\0" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\xff" + ids.tobytes()
        doc_ids = np.array([0 if d is None else d for d, _, _ in held], "<i8").tobytes()
        values = [shard, block, before, size, doc_ids, np.array([d is None for d, _, _ in held]).tobytes(), np.array([n for _, n, _ in held], "<u4").tobytes(), z.compress(raw)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

    for batch in batches:
        for s, d, n, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (s != shard or size >= BLOCK_IDS):
                yield close()
                block, before = (block + 1, before + size) if s == shard else (0, 0)
                held, size = [], 0
            if s != shard:
                shard, block, before = s, 0, 0
            held.append((d, n, p))
            size += n
    if held:
        yield close()


def _block_ids(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw[1:], "<u4" if raw[0] else "<u2").astype("<u4")


def _counts(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            c = np.bincount(_block_ids(blob))
            if len(c) > len(total):
                c[: len(total)] += total
                total = c
            else:
                total[: len(c)] += c
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> np.ndarray:
    """Write docs(doc_id, text) under path: ``blocks`` (the coded ids) and ``ranks`` (the id of each rank)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    bounds, more = _range_bounds(docs.select(F.col("doc_id").cast("long").alias("doc_id")), min(4096, common.partitions(spark)))
    dealt = _tokenise(docs, tokenizer, end_id, bounds, more).repartition(len(bounds) + 1 + more, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "packed")
    plain = common.written(dealt.mapInArrow(_blocks, _BLOCK_SQL), "plain-ids")
    counts = plain.select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # one row for each id in use: bounded by the vocabulary
    got = sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))
    ids = np.array([r["id"] for r in got], np.int64)
    ranks = np.zeros(int(ids.max(initial=-1)) + 1, "<u4")
    ranks[ids] = np.arange(len(ids))

    def code(batches):
        for batch in batches:
            control, data = zip(*(encode_ranks(ranks[_block_ids(b)]) for b in batch.column("ids").to_pylist()), strict=True) if batch.num_rows else ((), ())
            head = [batch.column(c) for c in ("shard", "block", "before", "total", "doc_ids", "no_id", "counts")]
            yield pa.RecordBatch.from_arrays([*head, common.blobs(control), common.blobs(data)], ["shard", "block", "before", "total", "doc_ids", "no_id", "counts", "control", "data"])

    coded = plain.mapInArrow(code, "shard int, block int, before long, total long, doc_ids binary, no_id binary, counts binary, control binary, data binary")
    coded.write.option("compression", "zstd").parquet(f"{path}/blocks")
    spark.createDataFrame([(int(r), int(i)) for r, i in enumerate(ids)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    return ids


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (and ids, little-endian unsigned 32 bits)."""
    by_rank = np.array([r["id"] for r in sorted(spark.read.parquet(f"{path}/ranks").collect(), key=lambda r: r["rank"])], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if with_ids else [])])

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ids = by_rank[decode_ranks(row["control"], row["data"], int(n.sum()))]
                ends = np.cumsum(n)
                each = [ids[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)]
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=np.frombuffer(row["no_id"], bool))
                columns = [pa.array([row["shard"]] * len(n), pa.int32()), doc_ids, pa.array(ends - n + row["before"]), pa.array(n), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(each, pa.binary())] if with_ids else []), schema=schema)

    rows = blocks.mapInArrow(decode, "shard int, doc_id long, within long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
    # ids of all shards before: one row for each shard, of which there are 8,192 at most
    first = blocks.groupBy("shard").agg(F.sum("total").alias("n")).select("shard", (F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).cast("long").alias("first"))
    out = rows.join(F.broadcast(first), "shard").withColumn("start", F.col("first") + F.col("within"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    path = common.shared_path(spark, "token-files")
    write_tokens(common.table(spark, sf_dir, "documents"), common.tokenizer_path(), path)
    return read_tokens(spark, path)
