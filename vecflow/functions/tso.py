"""The 64-bit hybrid clock: physical milliseconds in the high 46 bits, a logical counter in the low 18."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 18
LOGICAL = (1 << SHIFT) - 1


def tso_physical_ms(tso: Column) -> Column:
    return F.shiftright(tso, SHIFT)


def tso_logical(tso: Column) -> Column:
    return tso.bitwiseAND(F.lit(LOGICAL).cast("long"))


def tso_compose(ms: Column, logical: Column) -> Column:
    return F.shiftleft(ms.cast("long"), SHIFT).bitwiseOR(logical.cast("long"))


def tso_to_timestamp(tso: Column) -> Column:
    return F.timestamp_millis(tso_physical_ms(tso))


def lag_ms(now_ms: Column, watermark: Column) -> Column:
    """Milliseconds by which a watermark is behind; 0 without a watermark, never below 0."""
    behind = F.greatest(F.lit(0).cast("long"), now_ms - tso_physical_ms(watermark))
    return F.when(watermark.isNull() | (watermark <= 0), F.lit(0).cast("long")).otherwise(behind)


def effective_tso(base: Column, row_tsos: Column) -> Column:
    """The message's timestamp unless it is 0, then that of its first row, else 0."""
    return F.coalesce(F.nullif(base, F.lit(0).cast("long")), F.get(row_tsos, F.lit(0)), base, F.lit(0).cast("long"))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def or_default(c: Column, default: Column) -> Column:
    """c, or the default where c is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), default)
