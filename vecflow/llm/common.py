"""What several training-data operators share: reading, shared folders, Arrow buffers, words and hashes."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch at most, so that a batch of long documents stays small in a Python worker.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_ROWS; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names none and runs on one machine (tests) a temporary folder is made and set; a cluster
    without such a folder is an error, as its machines don't share their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="vecflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The frame written as a table in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, in one new shared folder that clear() removes."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.path = spark, shared_path(spark, what)

    def written(self, df: DataFrame, what: str) -> DataFrame:
        path = f"{self.path}/{what}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file; TOKENIZER_DIR overrides the installed package's folder."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def ordered_hex(c: Column) -> Column:
    return F.lower(F.hex(c))


# Arrow buffers


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. Row i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blobs(parts: list) -> pa.Array:
    return pa.array([bytes(x) for x in parts], pa.binary())


# Words: maximal runs of digits, ASCII letters (lower-cased) and bytes of characters beyond ASCII

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Random values for bytes, and an odd base with its inverse: a rolling hash modulo 2**64.
_RNG = np.random.default_rng(0x5EED)
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends) of one text."""
    low = _LOWER[raw]
    edge = np.diff(np.concatenate(([False], _WORD[raw], [False])).astype(np.int8))
    return low, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Longest stretch of bytes that word_hashes() works on at once, by which its memory is bounded.
STRETCH = 1 << 20


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by prefix sums over the bytes of at most STRETCH bytes (or one word)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STRETCH, "right")))
        at, to = starts[i], ends[j - 1]
        piece = BYTE_VALUE[low[at:to]] * _powers(BASE, to - at)
        total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(piece)))
        s, e = starts[i:j] - at, ends[i:j] - at
        undo = _powers(INVERSE, to - at)
        out[i:j] = mix((total[e] - total[s]) * undo[s] + (e - s).astype(np.uint64))
        i = j
    return out


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words; the whole where there are fewer, but not none."""
    n = len(h)
    if not n:
        return h
    k = min(k, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = out * BASE + h[i : n - k + 1 + i]
    return mix(out + np.uint64(k))
