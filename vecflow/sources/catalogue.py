"""Collections, their schemas and their channels, from the metadata tables of a database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collections(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per name of (names, ids, created): id and created are 0 where their lists run out."""
    zero = F.lit(0).cast("long")
    return df.select(*keep, F.posexplode("names").alias("pos", "name"), "ids", "created").select(
        *keep, F.col("pos").cast("long").alias("pos"), "name",
        F.coalesce(F.get("ids", F.col("pos")), zero).alias("id"), F.coalesce(F.get("created", F.col("pos")), zero).alias("created"),
    )


def collection_schema(df: DataFrame, default_db: str = "default") -> DataFrame:
    """(collection, db, n_fields, pk) of (collection, db, fields): the last field flagged primary is the key, a blank
    database is the configured one."""
    primary = F.filter("fields", lambda f: f["is_primary"])
    db = F.when(F.trim(F.coalesce("db", F.lit(""))) == "", F.lit(default_db)).otherwise(F.col("db"))
    return df.select("collection", db.alias("db"), F.size("fields").cast("long").alias("n_fields"), F.try_element_at(primary, F.lit(-1))["name"].alias("pk"))


def field_dimension(params: Column) -> Column:
    """The first ``dim`` parameter as a number; 0 if it is missing or no number."""
    first = F.get(F.filter(params, lambda p: p["key"] == "dim"), F.lit(0))
    return F.coalesce(first["value"].try_cast("int"), F.lit(0))


def channel_map(df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pos, vchannel, pchannel) of (virtual, physical): the i-th with the i-th, the last physical one beyond."""
    physical = F.try_element_at("physical", F.least(F.col("pos") + 1, F.size("physical")))
    return df.select(*keep, F.posexplode("virtual").alias("pos", "vchannel"), "physical").select(*keep, F.col("pos").cast("long").alias("pos"), "vchannel", F.when(F.size("physical") > 0, physical).alias("pchannel"))


def find_collection(df: DataFrame, name: str | Column) -> DataFrame:
    return df.where(F.col("name") == name).limit(1)


def database_exists(databases: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(databases, name), F.lit(False))
