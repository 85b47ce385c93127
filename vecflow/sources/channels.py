"""Physical and virtual channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def partitions(df: DataFrame) -> DataFrame:
    """(pchannel, n): the physical channels, each once, numbered by name. One row per channel reaches the last step."""
    return df.select("pchannel").distinct().withColumn("n", F.row_number().over(Window.orderBy("pchannel")).cast("long"))
