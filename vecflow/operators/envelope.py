"""Change records: envelope, source block, positions, keys, routing, serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.functions.tso import tso_physical_ms

VERSION, NAME = "1", "vecflow"


def operation(kind: Column) -> Column:
    return F.when(kind == "Insert", "c").when(kind == "Delete", "d").when(kind == "Read", "r")


def envelope(df: DataFrame, pk: str, columns: list[str]) -> DataFrame:
    """df(kind, columns...) with op, key, before and after. A delete has only its key before and nothing after; inserts
    and snapshot reads have nothing before."""
    gone = F.col("kind") == "Delete"
    typed = {f.name: f.dataType for f in df.schema.fields}
    key_only = F.struct(*((F.col(c) if c == pk else F.lit(None).cast(typed[c])).alias(c) for c in columns))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, operation(F.col("kind")).alias("op"), F.struct(pk).alias("key"), F.when(gone, key_only).alias("before"), F.when(~gone, F.struct(*columns)).alias("after"))


def source_block(df: DataFrame, db: str = "default", snapshot: str = "false") -> DataFrame:
    """df(collection, pchannel, vchannel, tso) with source."""
    t = tso_physical_ms(F.col("tso"))
    source = F.struct(
        F.lit(VERSION).alias("version"), F.lit(NAME).alias("connector"), F.lit(db).alias("name"), t.alias("ts_ms"), (t * 1000).alias("ts_us"), (t * 1000000).alias("ts_ns"),
        F.lit(snapshot).alias("snapshot"), F.lit(None).cast("string").alias("sequence"), F.lit(db).alias("db"), "collection", "pchannel", "vchannel", "tso",
    )
    return df.withColumn("source", source)


def event_position(df: DataFrame) -> DataFrame:
    """df(tso, pchannel, vchannel) with position (what is null is left out), event_time_ms and transaction (none)."""
    m = F.create_map(F.lit("tso"), F.col("tso").cast("string"), F.lit("pchannel"), F.col("pchannel"), F.lit("vchannel"), F.col("vchannel"))
    return df.withColumns({"position": F.map_filter(m, lambda k, v: v.isNotNull()), "event_time_ms": tso_physical_ms(F.col("tso")), "transaction": F.lit(None).cast("string")})


def with_key(df: DataFrame, pk: str) -> DataFrame:
    return df.withColumn("key", F.to_json(F.struct(pk)))


def route(df: DataFrame, prefix: str, db: str = "default", router=None) -> DataFrame:
    """df(collection, ...) with topic: prefix.db.collection, or whatever ``router(df)`` makes of the rows (it may rename,
    drop or multiply them, and must give a topic)."""
    if router is not None:
        routed = router(df)
        if "topic" not in routed.columns:
            raise ValueError("a router must give a topic")
        return routed
    return df.withColumn("topic", F.concat_ws(".", F.lit(prefix), F.lit(db), "collection"))


def serialize(df: DataFrame, columns: list[str], fmt: str = "json") -> DataFrame:
    """df with value: the columns as one JSON text (or Avro bytes, where the avro package is present)."""
    record = F.struct(*columns)
    if fmt == "json":
        return df.withColumn("value", F.to_json(record))
    from pyspark.sql.avro.functions import to_avro

    return df.withColumn("value", to_avro(record))


def write_changes(df: DataFrame, fmt: str, path: str | None = None, **options):
    """Writer of routed records: a Kafka writer by topic, or files in a folder for each topic. Streams and batches alike."""
    writer = df.writeStream if df.isStreaming else df.write
    writer = writer.format(fmt).options(**options)
    if fmt == "kafka":
        return writer
    return writer.partitionBy("topic").option("path", path)
