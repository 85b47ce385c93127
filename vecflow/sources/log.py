"""Message logs: reading, start positions, resume decisions and checkpoints.

A log has the columns of Spark's Kafka source: topic, partition, offset, key, value, timestamp.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp"


def read_log(spark: SparkSession, source: str, fmt: str = "parquet", streaming: bool = False, start: str = "earliest", **options) -> DataFrame:
    """Messages of a topic (fmt "kafka") or of files with the same columns. start is earliest, latest or offsets as JSON
    (as of starting_offsets): the first offset of each topic partition, -1 for none of those that are there. Partitions of
    files that the JSON doesn't name are read from their beginning; latest gives none of a batch's files."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        fixed = {"subscribe": source, "startingOffsets": start, "kafka.isolation.level": "read_committed", "failOnDataLoss": "true"}
        return reader.format("kafka").options(**fixed | options).load()
    rows = reader.format(fmt).schema(MESSAGE).options(**options).load(source)
    if start in ("earliest", "latest"):
        return rows if start == "earliest" or streaming else rows.where(F.lit(False))
    wanted = F.lit(True)
    for topic, partitions in json.loads(start).items():
        for partition, offset in partitions.items():
            other = (F.col("topic") != topic) | (F.col("partition") != int(partition))
            wanted = wanted & (other | (F.col("offset") >= offset if offset >= 0 else F.lit(False)))
    return rows.where(wanted)


def write_log(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Messages df(topic, offset, value, ...) as files that read_log reads; what else is missing is null or 0. Files are in
    order of topic, partition and offset, so that their statistics tell what they hold."""
    missing = {"partition": F.lit(0), "key": F.lit(None).cast("binary"), "timestamp": F.lit(None).cast("timestamp")}
    d = df.withColumns({c: v for c, v in missing.items() if c not in df.columns})
    d = d.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), F.col("key").cast("binary").alias("key"), "value", "timestamp")
    d.sortWithinPartitions("topic", "partition", "offset").write.mode(mode).parquet(path)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; on one machine without such a setting a
    temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="vecflow-")
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def starting_offsets(plan: DataFrame) -> str:
    """The startingOffsets JSON of (topic, partition, start): one row for each topic partition."""
    out: dict[str, dict[str, int]] = {}
    for r in plan.collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = -1 if r["start"] is None else r["start"]
    return json.dumps(out, sort_keys=True)


def start_offsets(channels: DataFrame, progress: DataFrame, checkpoints: DataFrame, mode: str) -> DataFrame:
    """(pchannel, start, missing): where to read from. progress(pchannel, stored), checkpoints(pchannel, offset).

    EARLIEST starts at 0; LATEST has no offset (null); STORED_OFFSET_PLUS_ONE and DEFAULT need a stored or a checkpoint
    offset, and report the channel as missing without one."""
    d = channels.join(progress, "pchannel", "left").join(checkpoints, "pchannel", "left")
    start = {
        "EARLIEST": F.lit(0).cast("long"), "LATEST": F.lit(None).cast("long"),
        "STORED_OFFSET_PLUS_ONE": F.col("stored") + 1, "DEFAULT": F.col("offset"),
    }[mode]
    return d.select("pchannel", start.alias("start"), (F.lit(mode in ("STORED_OFFSET_PLUS_ONE", "DEFAULT")) & start.isNull()).alias("missing"))


def resume_plan(channels: DataFrame, progress: DataFrame, checkpoints: DataFrame, inclusive: bool = False) -> DataFrame:
    """(pchannel, mode, start) from channels(pchannel, snapshot_completed), progress(pchannel, stored) and
    checkpoints(pchannel, offset): after the stored offset; else, with the snapshot not complete, at the checkpoint; else
    latest. inclusive reads the stored offset once more."""
    d = channels.join(progress, "pchannel", "left").join(checkpoints, "pchannel", "left")
    open_ = ~F.coalesce("snapshot_completed", F.lit(False))
    mode = F.when(F.col("stored").isNotNull(), "stored").when(open_ & F.col("offset").isNotNull(), "checkpoint").otherwise("latest")
    start = F.when(mode == "stored", F.col("stored") + (0 if inclusive else 1)).when(mode == "checkpoint", F.col("offset"))
    return d.select("pchannel", mode.alias("mode"), start.alias("start"))


def le_int64(b: Column) -> Column:
    """8 little-endian bytes as a signed integer."""
    hexed = F.hex(b)
    big = F.concat(*(F.substring(hexed, 15 - 2 * i, 2) for i in range(8)))
    unsigned = F.conv(big, 16, 10).cast("decimal(20,0)")
    top, all_ = F.lit(str(2**63)).cast("decimal(20,0)"), F.lit(str(2**64)).cast("decimal(20,0)")
    return F.when(unsigned >= top, unsigned - all_).otherwise(unsigned).cast("long")


def checkpoint_offset(msg_id: Column) -> Column:
    """Log offset of a message id: 8 bytes are a little-endian integer, others decimal text; null if neither."""
    text = F.decode(msg_id, "UTF-8")
    return F.when(F.length(msg_id) == 8, le_int64(msg_id)).when(F.length(msg_id) > 0, text.try_cast("bigint"))


def decode_checkpoint(df: DataFrame, strict: bool = False) -> DataFrame:
    """(pchannel, offset, tso, error) of (pchannel, msg_id, tso); strict fails on the first undecodable id."""
    d = df.select("pchannel", checkpoint_offset(F.col("msg_id")).alias("offset"), "tso")
    d = d.withColumn("error", F.when(F.col("offset").isNull(), "message id is neither 8 bytes nor decimal text"))
    return d.where(F.assert_true(F.col("error").isNull(), F.col("error")).isNull()) if strict else d


def checkpoint_key(root: Column, override: Column, pchannel: Column) -> Column:
    """Key of a channel's checkpoint: the override (a path with one %s) or the usual path below root; null without %s."""
    trimmed = F.regexp_replace(root, "/+$", "")
    path = F.coalesce(F.when(F.trim(override) != "", override), F.concat(trimmed, F.lit("/checkpoint/%s")))
    return F.when(F.locate("%s", path) > 0, F.replace(path, F.lit("%s"), pchannel))
