"""What kind of payload topics hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECOGNISED = ("single", "batch")


def payload_profile(df: DataFrame) -> DataFrame:
    """(topic, format, n_unknown, first_unknown) of df(topic, offset, payload): the first recognisable message that is no
    tick decides; payload is tick, single, batch or unknown."""
    known = F.col("payload").isin(*RECOGNISED)
    unknown = F.col("payload") == "unknown"
    return df.groupBy("topic").agg(
        F.min_by(F.when(known, F.col("payload")), F.when(known, F.col("offset"))).alias("format"),
        F.count_if(unknown).alias("n_unknown"), F.min(F.when(unknown, F.col("offset"))).alias("first_unknown"),
    )


def reprobe(df: DataFrame, stored: DataFrame) -> DataFrame:
    """(topic, format, from_start, error): the profile from the stored offset on (df, stored: topic, stored); where it
    finds nothing, the profile of the whole topic. An error where only unknown payloads are found."""
    late = payload_profile(df.join(stored, "topic", "left").where("stored is null or offset >= stored").drop("stored"))
    whole = payload_profile(df).select("topic", F.col("format").alias("__f"), F.col("n_unknown").alias("__n"))
    d = whole.join(late.select("topic", "format"), "topic", "left")
    found = F.coalesce("format", "__f")
    return d.select("topic", found.alias("format"), (F.col("format").isNull() & F.col("__f").isNotNull()).alias("from_start"), (found.isNull() & (F.col("__n") > 0)).alias("error"))


def check_formats(profile: DataFrame, configured: str | None = None) -> DataFrame:
    """One row: n_formats, mixed, and clashes (topics that differ from the configured format)."""
    clash = F.col("format") != F.lit(configured) if configured else F.lit(False)
    return profile.agg(F.count_distinct("format").alias("n_formats"), (F.count_distinct("format") > 1).alias("mixed"), F.count_if(F.coalesce(clash, F.lit(False))).alias("clashes"))


def resolve_format(profile: DataFrame, configured: str | None = None) -> DataFrame:
    return profile.select("topic", F.coalesce("format", F.lit(configured), F.lit("batch")).alias("format"))
