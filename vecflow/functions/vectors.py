"""Dense, byte-packed and sparse vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

#: Bytes of one vector by field type, as a function of its dimension: fixed values.
WIDTHS = {"BinaryVector": lambda d: -(-d // 8), "Int8Vector": lambda d: d, "Float16Vector": lambda d: 2 * d, "BFloat16Vector": lambda d: 2 * d}


def slice_vectors(flat: Column, dim: Column) -> Column:
    """A flat list as vectors of dim values: all of it where dim is 0; a partial one at the end is dropped."""
    n = F.floor(F.size(flat) / dim).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * dim + 1, dim))
    none = F.array_repeat(flat, 0)
    return F.when(dim <= 0, F.array(flat)).when(F.size(flat) < dim, none).otherwise(cut)


def slice_bytes(b: Column, width: Column) -> Column:
    """Bytes as vectors of ``width`` bytes; a partial one at the end is dropped."""
    n = F.floor(F.length(b) / width).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(b, i * width + 1, width))
    return F.when(F.length(b) < width, F.array_repeat(b, 0)).otherwise(cut)


def vector_width(kind: str, dim: int) -> int:
    return WIDTHS[kind](dim)


def _items(b: pa.Array, width: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(bytes, list offsets, mask of nulls) of the whole items of ``width`` bytes in a batch of packed values."""
    whole = pc.fill_null(b, b"").cast(pa.large_binary())
    size = pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    n = size // width
    _, off, data = whole.buffers()
    off = np.frombuffer(off, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(whole) else np.zeros(0, np.uint8)
    if (size % width).any():  # trailing bytes of some value: keep whole items only
        at = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        raw = raw[at < np.repeat(n * width, size)]
    return np.ascontiguousarray(raw), pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pc.is_null(b)


def _unpacked(b: pa.Array, width: int, floats) -> pa.Array:
    """Vectors of a batch of packed values, decoded in one pass over the joined bytes."""
    raw, offsets, none = _items(b, width)
    return pa.ListArray.from_arrays(offsets, pa.array(floats(raw), pa.float32()), mask=none)


@F.arrow_udf(ArrayType(FloatType()))
def unpack_f32(b: pa.Array) -> pa.Array:
    """Little-endian 32-bit floats."""
    return _unpacked(b, 4, lambda raw: raw.view("<f4"))


@F.arrow_udf(ArrayType(FloatType()))
def unpack_f16(b: pa.Array) -> pa.Array:
    """Little-endian 16-bit floats."""
    return _unpacked(b, 2, lambda raw: raw.view("<f2").astype("f4"))


@F.arrow_udf(ArrayType(FloatType()))
def unpack_bf16(b: pa.Array) -> pa.Array:
    """bfloat16: the upper halves of 32-bit floats."""
    return _unpacked(b, 2, lambda raw: (raw.view("<u2").astype("<u4") << 16).view("<f4"))


@F.arrow_udf(ArrayType(StructType([StructField("k", LongType()), StructField("v", FloatType())])))
def unpack_sparse(b: pa.Array) -> pa.Array:
    """Entries of an unsigned 32-bit index and a 32-bit float, little-endian; trailing bytes are ignored."""
    raw, offsets, none = _items(b, 8)
    e = raw.view([("k", "<u4"), ("v", "<f4")])
    entries = pa.StructArray.from_arrays([pa.array(e["k"].astype(np.int64)), pa.array(np.ascontiguousarray(e["v"]), pa.float32())], ["k", "v"])
    return pa.ListArray.from_arrays(offsets, entries, mask=none)


def sparse_to_map(b: Column) -> Column:
    return F.map_from_entries(unpack_sparse(b))


def sparse_to_json(entries: Column) -> Column:
    """{"index":value,...} of entries array<struct<k, v>>, in their order."""
    each = F.transform(entries, lambda e: F.concat(F.lit('"'), e["k"].cast("string"), F.lit('":'), e["v"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(each, ","), F.lit("}"))
