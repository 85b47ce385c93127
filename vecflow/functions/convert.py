"""Cell conversions. Null gives null; integers wrap where they are narrowed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def to_bool(c: Column, kind: str) -> Column:
    """kind is string, integer, floating or boolean. Text is true only as "true" in any case; numbers are true unless
    their integer part, in 32 bits, is 0."""
    if kind == "string":
        return F.lower(F.trim(c)) == "true"
    if kind == "integer":
        return c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)) != 0
    return F.abs(c) >= 1 if kind == "floating" else c


def _wrap(x: Column, bits: int) -> Column:
    half = 1 << (bits - 1)
    return x.bitwiseAND(F.lit(2 * half - 1)).bitwiseXOR(F.lit(half)) - F.lit(half)


def to_short(c: Column) -> Column:
    return _wrap(c.cast("bigint"), 16).cast("smallint")


def to_int(c: Column) -> Column:
    return _wrap(c.cast("bigint"), 32).cast("int")


def to_long(c: Column) -> Column:
    return c.cast("bigint")


def to_float(c: Column) -> Column:
    return c.cast("float")


def to_double(c: Column) -> Column:
    return c.cast("double")


def to_string(c: Column) -> Column:
    return c.cast("string")


def to_list(c: Column, is_list: bool = False) -> Column:
    return c if is_list else F.when(c.isNotNull(), F.array(c))


def to_bytes(c: Column, is_bytes: bool = False) -> Column:
    return c if is_bytes else F.encode(c, "UTF-8")


def to_float_vector(c: Column, is_bytes: bool = False) -> Column:
    from vecflow.functions.vectors import unpack_f32

    return unpack_f32(c) if is_bytes else c.cast("array<float>")


def converted(fields: Column, types: dict[str, str], converters: dict | None = None) -> dict[str, Column]:
    """Columns of a row's text values (map<string, string>) by field type: the usual conversion, or for the types named in
    ``converters`` (type -> function of a Column) that one."""
    usual = {"Bool": lambda c: to_bool(c, "string"), "Int8": to_short, "Int16": to_short, "Int32": to_int, "Int64": to_long, "Float": to_float, "Double": to_double}
    chosen = usual | (converters or {})
    return {name: chosen.get(kind, to_string)(fields[name]).alias(name) for name, kind in types.items()}


def convert_untyped(c: Column, kind: str, enum: dict[str, int] | None = None) -> Column:
    """A value without a field type: numbers, booleans, text and bytes pass, float lists become little-endian bytes, enum
    names their numbers, anything else its text."""
    if kind == "enum":
        out = F.lit(None).cast("int")
        for name, n in (enum or {}).items():
            out = F.when(c == name, n).otherwise(out)
        return out
    if kind == "floats":
        return pack_f32(c)
    return c if kind in ("integer", "floating", "boolean", "string", "bytes") else F.to_json(c)


@F.arrow_udf(BinaryType())
def pack_f32(v: pa.Array) -> pa.Array:
    """Little-endian 32-bit floats of lists without nulls: the batch's values are one buffer already."""
    lists = pc.fill_null(v, pa.scalar([], v.type)).cast(pa.list_(pa.float32()))
    raw = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<f4").tobytes()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)) * 4
    offsets = np.concatenate(([0], ends)).astype("<i4")
    packed = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
    return pc.if_else(pc.is_valid(v), packed, pa.scalar(None, pa.binary()))


def decimal_mode(c: Column, kind: str, mode: str) -> Column:
    """A Float or Double as double, decimal (7 or 15 places) or text."""
    if mode == "precise":
        return c.cast("decimal(38,7)" if kind == "Float" else "decimal(38,15)")
    return c.cast("string") if mode == "string" else c.cast("float" if kind == "Float" else "double")
