"""Which events and collections go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_collections(df: DataFrame, include: list[str] = (), exclude: list[str] = (), column: str = "collection") -> DataFrame:
    """Rows whose collection matches no excluded pattern and, if any are given, an included one. Patterns are regular
    expressions for the whole name; literal names are such."""
    c = F.col(column)
    out = df
    if exclude:
        out = out.where(~c.rlike(_any(exclude)))
    return out.where(c.rlike(_any(include))) if include else out


def _any(patterns: list[str]) -> str:
    return "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$"


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.where(F.trim(F.coalesce("collection", F.lit(""))) != "")


def drop_unknown(df: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, unknown) rows by known(collection)."""
    names = known.select("collection").distinct()
    return df.join(names, "collection", "left_semi"), df.join(names, "collection", "left_anti")


def split_ddl(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data changes, schema changes); ticks are in neither."""
    return df.where(F.col("kind").isin("Insert", "Delete")), df.where("kind = 'DDL'")


def all_rows_filter(df: DataFrame, pk: str) -> DataFrame:
    """All rows with a key: what the usual tautologies on a key select."""
    return df.where(F.col(pk).isNotNull())
