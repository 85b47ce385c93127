"""Keys and schemas of collections: resolution, registration, drift, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecflow.functions.types import KEY_TYPES


def resolve_pk(fields: DataFrame) -> DataFrame:
    """(collection, pk) of fields(collection, pos, name, type, metadata_pk): the key that metadata names if it is one of
    the fields; else the first named id, x_id or id_x of a key type; else the first of a key type; else the first."""
    name = F.lower("name")
    usable = F.col("type").isin(*KEY_TYPES)
    id_like = (name == "id") | name.endswith("_id") | name.startswith("id_")
    rank = F.when(F.col("name") == F.col("metadata_pk"), 0).when(id_like & usable, 1).when(usable, 2).otherwise(3)
    return fields.groupBy("collection").agg(F.min_by("name", F.struct(rank, "pos")).alias("pk"))


def first_schema(changes: DataFrame) -> DataFrame:
    """(collection, fields, seq) of the first insert of each collection in release order; later ones don't replace it."""
    return changes.where("kind = 'Insert'").groupBy("collection").agg(F.min_by("fields", "seq").alias("fields"), F.min("seq").alias("seq"))


def schema_source(first: DataFrame, metadata: DataFrame) -> DataFrame:
    """(collection, fields, source): metadata where there is any, else the first insert."""
    m = metadata.select("collection", F.col("fields").alias("__m"))
    d = first.select("collection", "fields").join(m, "collection", "full_outer")
    return d.select("collection", F.coalesce("__m", "fields").alias("fields"), F.when(F.col("__m").isNotNull(), "metadata").otherwise("insert").alias("source"))


def _drift(sets: DataFrame) -> DataFrame:
    """(collection, extra, missing, n) of (collection, fields, __registered, n) where the two differ."""
    d = sets.select("collection", F.array_sort(F.array_except("fields", "__registered")).alias("extra"), F.array_sort(F.array_except("__registered", "fields")).alias("missing"), "n")
    return d.where((F.size("extra") > 0) | (F.size("missing") > 0)).groupBy("collection", "extra", "missing").agg(F.sum("n").alias("n"))


def schema_drift(changes: DataFrame, schemas: DataFrame) -> DataFrame:
    """(collection, extra, missing, n) of inserts whose fields differ from the registered ones."""
    s = schemas.select("collection", F.col("fields").alias("__registered"))
    return _drift(changes.where("kind = 'Insert'").groupBy("collection", "fields").agg(F.count("*").alias("n")).join(s, "collection"))


def drift_from_first(changes: DataFrame) -> DataFrame:
    """schema_drift() against first_schema() of the same changes, which are gone through once. seq may be anything that is
    ordered as they are."""
    sets = changes.where("kind = 'Insert'").groupBy("collection", "fields").agg(F.min("seq").alias("seq"), F.count("*").alias("n"))
    return _drift(sets.withColumn("__registered", F.min_by("fields", "seq").over(Window.partitionBy("collection"))))


def with_schema(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """Events with the columns and key of their collection, null where it isn't registered."""
    return df.join(schemas, "collection", "left")


def resolve_vchannel(df: DataFrame, channels: DataFrame, pchannel: str) -> DataFrame:
    """Collections with a vchannel: the first on the physical channel, else the first, else null."""
    place = F.struct(F.when(F.col("pchannel") == pchannel, 0).otherwise(1), "pos")
    first = channels.groupBy("collection").agg(F.min_by("vchannel", place).alias("vchannel"))
    return df.join(first, "collection", "left")
