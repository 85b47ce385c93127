"""What an ordering stream holds, read from its checkpoint with Spark's state reader: as progress and as a start for another run.

progress_of() gives the key/value rows of operators.progress (last offset of each physical channel, last tick of each
virtual one), and stored_state() all that order_stream() needs to go on under a new checkpoint, behind those offsets:
ticks, channel-level ticks, watermarks, places in the order and pending events. Both read the state of the last committed
batch, or of ``batch``, by as many tasks as the stream has partitions; nothing of it passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.operators.progress import OFFSET, TICK
from vecflow.sources.log import starting_offsets

ENTRY = "entry string, pchannel string, vchannel string, tick long, watermark long, seq long, p long, row_pos long, kind string, tso long, payload string"


def _read(spark: SparkSession, checkpoint: str, variable: str, operator: int, batch: int | None) -> DataFrame:
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", variable)
    return (reader if batch is None else reader.option("batchId", batch)).load()


def _shaped(df: DataFrame, entry: str) -> DataFrame:
    named = [c.split() for c in ENTRY.split(", ")]
    return df.withColumn("entry", F.lit(entry)).select(*((F.col(n) if n in df.columns or n == "entry" else F.lit(None)).cast(t).alias(n) for n, t in named))


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Rows of ENTRY, for order_stream(initial_ticks=...): entry is tick (a virtual channel's), channel (the channel-level
    tick, watermark, seq, and p, the last offset read) or event (a pending one)."""
    ticks = _read(spark, checkpoint, "ticks", operator, batch).select("key.pchannel", F.col("user_map_key.vchannel"), F.col("user_map_value.tick"))
    meta = _read(spark, checkpoint, "meta", operator, batch).select("key.pchannel", F.col("value.channel_tick").alias("tick"), "value.watermark", "value.seq")
    place = _read(spark, checkpoint, "position", operator, batch).select("key.pchannel", "value.p")
    events = _read(spark, checkpoint, "pending", operator, batch).select("key.pchannel", F.explode("user_map_value.events").alias("e")).select("pchannel", "e.*")
    return _shaped(ticks, "tick").unionByName(_shaped(meta.join(place, "pchannel", "left"), "channel")).unionByName(_shaped(events, "event"))


def progress_of(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, val) of operators.progress: last offsets and ticks. Virtual channels that have no tick yet are left out."""
    place = _read(spark, checkpoint, "position", operator, batch)
    ticks = _read(spark, checkpoint, "ticks", operator, batch).where("user_map_value.tick is not null")
    return place.select(F.concat(F.lit(OFFSET), "key.pchannel").alias("key"), F.col("value.p").cast("string").alias("val")).unionByName(
        ticks.select(F.concat(F.lit(TICK), "user_map_key.vchannel").alias("key"), F.col("user_map_value.tick").cast("string").alias("val")))


def resume_offsets(spark: SparkSession, checkpoint: str, operator: int = 0) -> str:
    """startingOffsets JSON behind the last offsets read: a physical channel is partition 0 of the topic of its name."""
    place = _read(spark, checkpoint, "position", operator, None)
    return starting_offsets(place.select(F.col("key.pchannel").alias("topic"), F.lit(0).alias("partition"), (F.col("value.p") + 1).alias("start")))
