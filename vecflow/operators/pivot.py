"""Columnar messages to rows, and rows to registered columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def pivot_rows(df: DataFrame, fields: str = "fields", rows: str = "num_rows") -> DataFrame:
    """One row for each row of a message: row_pos and row, a map from field name to value. Order is kept; messages
    without fields or rows give none."""
    rest = [c for c in df.columns if c not in (fields, rows)]
    good = df.where((F.size(fields) > 0) & (F.col(rows) > 0))
    made = F.transform(F.sequence(F.lit(0), F.col(rows) - 1), lambda i: _row(fields, i))
    return good.select(*rest, F.posexplode(made).alias("row_pos", "row"))


def _row(fields: str, i: Column) -> Column:
    """Row i of a message as a map from field name to value."""
    return F.map_from_entries(F.transform(fields, lambda f: F.struct(f["name"], F.get(f["vals"], i))))


def take_apart(df: DataFrame, fields: str = "fields", rows: str = "num_rows", keys: str = "keys") -> DataFrame:
    """Inserts and deletes in one pass: one row for each row of an insert, as of pivot_rows(), and each key of a delete:
    row_pos, row (null of a key) and key (null of a row). Events of other kinds give none."""
    rest = [c for c in df.columns if c not in (fields, rows, keys)]
    kind, n = F.col("kind"), F.col(rows)
    inserted = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(_row(fields, i).alias("row"), F.lit(None).cast("string").alias("key")))
    deleted = F.transform(keys, lambda k: F.struct(F.lit(None).cast("map<string, string>").alias("row"), k.alias("key")))
    made = F.when((kind == "Insert") & (F.size(fields) > 0) & (n > 0), inserted).when(kind == "Delete", deleted)
    return df.select(*rest, F.posexplode(made).alias("row_pos", "__x")).select(*rest, "row_pos", "__x.row", "__x.key")


def pivot_known(df: DataFrame, schema: StructType, fields: str = "fields") -> DataFrame:
    """The same for a known schema, as typed columns: arrays are zipped, no map is built."""
    rest = [c for c in df.columns if c not in (fields, "num_rows")]
    d = df
    for f in schema.fields:
        d = d.withColumn(f"__{f.name}", _values(fields, f.name))
    zipped = F.arrays_zip(*(F.col(f"__{f.name}") for f in schema.fields))
    out = d.select(*rest, F.posexplode(zipped).alias("row_pos", "__r"))
    return out.select(*rest, "row_pos", *(F.col("__r")[f"__{f.name}"].try_cast(f.dataType).alias(f.name) for f in schema.fields))


def _values(fields: str, name: str):
    return F.get(F.filter(fields, lambda x: x["name"] == name), F.lit(0))["vals"]


def align(df: DataFrame, columns: StructType) -> DataFrame:
    """df with exactly the registered columns, by name: others are dropped, missing ones are null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in columns.fields))
