"""Snapshots: decision, reads, pages, counts, notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.operators.asof import number, ranges
from vecflow.operators.filters import all_rows_filter, filter_collections


def snapshot(df: DataFrame, collection: str, pk: str, columns: list[str], checkpoint_tso: int | None = None) -> DataFrame:
    """All rows with a key, as reads at the checkpoint's tso (null without one)."""
    d = all_rows_filter(df, pk).select(*columns)
    return d.withColumns({"kind": F.lit("Read"), "collection": F.lit(collection), "tso": F.lit(checkpoint_tso).cast("long")})


def snapshot_decision(mode: Column, has_offset: Column, completed: Column) -> Column:
    """Whether to take a snapshot: initial and when_needed without an offset or with an unfinished one, recovery without
    an offset, never not at all."""
    m = F.lower(F.trim(mode))
    return F.when(m.isin("initial", "when_needed"), ~has_offset | ~completed).when(m == "recovery", ~has_offset).when(m == "never", F.lit(False))


def page(df: DataFrame, key: str, size: int, width: int | None = None, parts: int = 1024) -> DataFrame:
    """df with page, from 0, of ``size`` rows (1000 if not above 0) in key order. Rows are numbered in ranges of keys: of
    ``width`` for dense whole numbers, else (text, sparse numbers) in ``parts`` ranges of about equally many keys."""
    size = size if size > 0 else 1000
    axis = F.floor(F.col(key) / F.lit(width)) if width else ranges(df, key, parts)
    d = number(df, [], axis, [F.col(key)], "__n")
    return d.withColumn("page", F.floor((F.col("__n") - 1) / F.lit(size)).cast("long")).drop("__n")


def snapshot_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows by all of ``by``, by its leading parts, and in all (nulls)."""
    return df.rollup(*by).agg(F.count("*").alias("n"))


def monitored_collections(collections: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    return filter_collections(collections, include, exclude, "name").select("name").distinct()


def snapshot_notifications(counts: DataFrame) -> DataFrame:
    """Two rows for each collection of counts(collection, n): in progress, and completed with its rows."""
    begun = counts.select("collection", F.lit("in_progress").alias("status"), F.lit(None).cast("long").alias("n"))
    return begun.unionByName(counts.select("collection", F.lit("completed").alias("status"), "n"))


def snapshot_metrics(counts: DataFrame, guarantee_tso: int | None) -> DataFrame:
    """One row: guarantee tso (0 without a checkpoint), collections, rows scanned, completed."""
    return counts.agg(F.lit(guarantee_tso or 0).cast("long").alias("guarantee_tso"), F.count("*").alias("collections"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_scanned"), F.lit(True).alias("completed"))
