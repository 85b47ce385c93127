"""Packing by power-of-two decomposition.

A document's ids, closed by an end id, are cut into pieces whose lengths are powers of two of at most ``max_len``
(its length in binary, as many pieces of ``max_len`` as fit). Every piece is a sequence of its own in the bucket of
its length: no sequence crosses documents and none holds padding. Pieces are cut where documents are scanned and then
dealt by bucket, each bucket in SALTS parts by a hash of the piece, so that rows of one length lie together and no bucket
is one task's; in a part they are in order of document and place and numbered. A sequence's number follows from the
pieces alone, not from the splits of the scan. ``write`` lays buckets down as folders.

Null and empty texts give the end id alone (one piece of length 1). Repeated rows each give their own pieces. Other
columns of the input are left behind unless named in ``keep``. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecflow.llm import common, tokens

MAX_LEN = 2048
#: Parts of a bucket, and bits of a number within a part. Parts are many, so that one stays small at 100 TB (some 400,000
#: sequences of 2048 ids): tasks hold as many parts as they come to.
SALTS, NUMBER_BITS = 1 << 16, 40


def pieces_of(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of n ids, longest first."""
    out = [max_len] * (n // max_len)
    rest = n % max_len
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, max_len: int = MAX_LEN, with_ids: bool = True) -> DataFrame:
    """Pieces of docs(doc_id, text): doc_id, start, length, ids (binary, unless with_ids is False), ids_crc32,
    doc_tokens, bucket (log2 of the length), sequence_id, offset."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    common.bound_batches(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("bucket", pa.int32())]
    schema = pa.schema([f for f in fields if with_ids or f[0] != "ids"])

    def cut(batches):
        enc = tokens.encoder(tokenizer, added=True)
        for batch in batches:
            rows: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text in zip(batch.column(0).to_pylist(), tokens.texts(batch.column(1)), strict=True):
                raw = enc.encode_bytes(text) + end
                at, n = 0, len(raw) // 4
                for length in pieces_of(n, max_len):
                    ids = raw[4 * at : 4 * (at + length)]
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(at)
                    rows["length"].append(length)
                    if with_ids:
                        rows["ids"].append(ids)
                    rows["ids_crc32"].append(zlib.crc32(ids))
                    rows["doc_tokens"].append(n)
                    rows["bucket"].append(length.bit_length() - 1)
                    at += length
                if len(rows["doc_id"]) >= 20_000:
                    yield pa.RecordBatch.from_pydict(rows, schema)
                    rows = {f.name: [] for f in schema}
            yield pa.RecordBatch.from_pydict(rows, schema)

    kinds = {"doc_id": "long", "start": "long", "length": "long", "ids": "binary", "ids_crc32": "long", "doc_tokens": "long", "bucket": "int"}
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, ", ".join(f"{f.name} {kinds[f.name]}" for f in schema))
    # each piece is one sequence: numbered within its part of its bucket
    part = F.col("bucket").cast("long") * SALTS + F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS))
    order = Window.partitionBy("part").orderBy("doc_id", "start", "ids_crc32")
    numbered = out.withColumn("part", part).withColumn("sequence_id", F.shiftleft("part", NUMBER_BITS) + F.row_number().over(order) - 1)
    return numbered.drop("part").withColumn("offset", F.lit(0).cast("long"))


def write(pieces: DataFrame, path: str) -> None:
    """Pieces as Parquet files, a folder for each sequence length (``bucket=11`` holds sequences of 2048 ids)."""
    pieces.write.partitionBy("bucket").option("compression", "zstd").parquet(path)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), common.tokenizer_path(), with_ids=False)
