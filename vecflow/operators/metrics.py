"""Sizes, limits, counters and gauges of ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from vecflow.functions.tso import lag_ms

OVERHEAD, OTHER = 256, 16


def value_bytes(c: Column, kind: str, compat: bool = False) -> Column:
    """Estimated bytes of one value: bytes and float vectors by length, text two for each character, others 16."""
    if kind == "string":
        n = 2 * F.length(c)
    elif kind == "binary":
        n = F.length(c)
    elif kind == "vector":
        n = (OTHER if compat else 4) * F.size(c)
    else:
        n = F.lit(OTHER)
    return F.when(c.isNull(), 0).otherwise(n).cast("long")


def event_bytes(df: DataFrame, values: dict[str, str], compat: bool = False) -> DataFrame:
    """df with bytes: a fixed overhead, and for inserts the values' sizes. compat counts vectors as boxed lists."""
    total = F.lit(0).cast("long")
    for c, kind in values.items():
        total = total + value_bytes(F.col(c), kind, compat)
    return df.withColumn("bytes", F.lit(OVERHEAD).cast("long") + F.when(F.col("kind") == "Insert", total).otherwise(0))


def running(df: DataFrame, within: list[str], key: str, values: dict[str, Column], width: int = 4096) -> DataFrame:
    """df with running sums in key order, put together from sums of key ranges, so that no window holds a whole channel."""
    d = df.withColumn("__b", F.floor(F.col(key) / F.lit(width)).cast("long"))
    sums = d.groupBy(*within, "__b").agg(*(F.sum(v).alias(f"__s_{n}") for n, v in values.items()))
    w = Window.partitionBy(*within).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*within, "__b", *(F.coalesce(F.sum(f"__s_{n}").over(w), F.lit(0)).alias(f"__p_{n}") for n in values))
    own = Window.partitionBy(*within, "__b").orderBy(key)
    d = d.withColumns({n: F.sum(v).over(own) for n, v in values.items()}).join(before, [*within, "__b"])
    return d.withColumns({n: (F.col(n) + F.col(f"__p_{n}")).cast("long") for n in values}).drop("__b", *(f"__p_{n}" for n in values))


def buffer_limits(df: DataFrame, max_events: int, max_bytes: int) -> DataFrame:
    """df(pchannel, p, bytes) with events and held (running), and over: the event that comes does not fit any more."""
    d = running(df, ["pchannel"], "p", {"events": F.lit(1), "held": F.col("bytes")})
    return d.withColumn("over", (F.col("events") > max_events) | (F.col("held") > max_bytes))


def pipeline_counters(ordered) -> DataFrame:
    """One row: late, released and pending events and ticks of a solution (operators.ordering.Ordered)."""
    e = ordered.released().agg(F.count("release_p").alias("released"), F.count_if(F.col("release_p").isNull()).alias("pending"))
    late = ordered.events.agg(F.count_if("late").alias("late"))
    ticks = ordered.ticks.agg(F.count("*").alias("ticks"))
    one = F.lit(1).alias("one")
    return late.select(one, "late").join(e.select(one, "released", "pending"), "one").join(ticks.select(one, "ticks"), "one").drop("one")


def observed(df: DataFrame, counters: dict[str, Column], name: str = "counters") -> tuple[DataFrame, Observation]:
    """df, and an observation of counters over its rows: known (``.get``) once df has been written or collected, by the
    job that does so."""
    seen = Observation(name)
    return df.observe(seen, *(c.alias(n) for n, c in counters.items())), seen


def event_counters() -> dict[str, Column]:
    """Events, late ones, deletes and the offsets they span, of the events of a solution (operators.ordering.Ordered)."""
    return {"events": F.count(F.lit(1)), "late": F.count_if("late"), "deletes": F.count_if(F.col("kind") == "Delete"), "first": F.min("p"), "last": F.max("p")}


def stream_metrics(marks: DataFrame, now_ms: int) -> DataFrame:
    """(pchannel, watermark, lag, position, resolved) after the last tick of each channel."""
    last = marks.groupBy("pchannel").agg(F.max("g").alias("watermark"), F.max("p").alias("position"))
    return last.select("pchannel", "watermark", lag_ms(F.lit(now_ms), F.col("watermark")).alias("lag"), "position", (F.col("watermark") > 0).alias("resolved"))
