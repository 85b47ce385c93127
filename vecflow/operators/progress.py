"""Offsets and ticks as key/value rows, and whether they move."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OFFSET, TICK, CHECKPOINT, DONE = "mq_offset_", "vchannel_timetick_", "checkpoint_ts", "snapshot_completed"


def progress_rows(log: DataFrame, checkpoint_ts: int | None = None, completed: bool | None = None) -> DataFrame:
    """(key, val) of a log: last offset of each physical channel, last tick of each virtual one, and the state given."""
    offsets = log.groupBy("pchannel").agg(F.max("p").alias("v")).select(F.concat(F.lit(OFFSET), "pchannel").alias("key"), F.col("v").cast("string").alias("val"))
    own = log.where("kind = 'TimeTick' and vchannel is not null").groupBy("vchannel").agg(F.max("tso").alias("v"))
    out = offsets.unionByName(own.select(F.concat(F.lit(TICK), "vchannel").alias("key"), F.col("v").cast("string").alias("val")))
    more = [(k, str(v).lower()) for k, v in ((CHECKPOINT, checkpoint_ts), (DONE, completed)) if v is not None]
    return out.unionByName(log.sparkSession.createDataFrame(more, "key string, val string")) if more else out


def load_progress(rows: DataFrame) -> DataFrame:
    """(kind, name, val) of key/value rows: offsets and ticks as numbers, null offsets and ticks of 0 where they are none."""
    number = F.col("val").try_cast("bigint")
    kind = F.when(F.col("key").startswith(OFFSET), "offset").when(F.col("key").startswith(TICK), "tick").when(F.col("key") == CHECKPOINT, "checkpoint").when(F.col("key") == DONE, "completed")
    name = F.when(kind == "offset", F.substr(F.col("key"), F.lit(len(OFFSET) + 1))).when(kind == "tick", F.substr(F.col("key"), F.lit(len(TICK) + 1))).otherwise("")
    value = F.when(kind == "tick", F.coalesce(number, F.lit(0))).when(kind == "completed", (F.lower("val") == "true").cast("bigint")).otherwise(number)
    return rows.select(kind.alias("kind"), name.alias("name"), value.alias("val")).where("kind is not null")


def stale_progress(history: DataFrame) -> DataFrame:
    """history(pchannel, checked_at, progress) with stale: there is progress, and it is what it was at the last check."""
    before = F.lag("progress").over(Window.partitionBy("pchannel").orderBy("checked_at"))
    return history.withColumn("stale", F.coalesce(F.col("progress").isNotNull() & (F.col("progress") == before), F.lit(False)))
