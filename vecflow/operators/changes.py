"""Change sets: upsert correlation, hand-off between snapshot and stream, de-duplication, current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.operators.envelope import operation
from vecflow.operators.ordering import op_rank


def correlate_upserts(df: DataFrame, values: list[str]) -> DataFrame:
    """df(collection, pk, tso, kind, p, values...): a delete and an insert of one key at one tso are one update.

    Per (collection, pk, tso): op (u, c or d), p of its last part, and the values after it (null after a delete)."""
    is_insert, is_delete = F.col("kind") == "Insert", F.col("kind") == "Delete"
    g = df.groupBy("collection", "pk", "tso").agg(
        F.count_if(is_insert).alias("__i"), F.count_if(is_delete).alias("__d"), F.max("p").alias("p"),
        *(F.max_by(F.when(is_insert, F.struct(v)), F.when(is_insert, F.col("p")))[v].alias(v) for v in values),
    )
    op = F.when((F.col("__i") > 0) & (F.col("__d") > 0), "u").when(F.col("__i") > 0, "c").otherwise("d")
    return g.select("collection", "pk", "tso", op.alias("op"), "p", *values)


def handoff_union(snapshot: DataFrame, stream: DataFrame) -> DataFrame:
    """Snapshot reads and streamed inserts as one set of changes, with op and phase (0 snapshot, 1 stream)."""
    snap = snapshot.withColumns({"op": F.lit("r"), "phase": F.lit(0)})
    return snap.unionByName(stream.withColumns({"op": F.lit("c"), "phase": F.lit(1)}), allowMissingColumns=True)


def handoff(snapshot: DataFrame, stream: DataFrame, checkpoints: DataFrame, inclusive: bool = False) -> DataFrame:
    """Snapshot reads followed by the stream from its checkpoints on, as one set of changes with op and phase.

    stream(pchannel, p, kind, ...) gives each channel's rows behind (inclusive: from) the offset of
    checkpoints(pchannel, offset, tso); a channel without a checkpoint gives all of its rows. Reads carry the least tso of
    the checkpoints, at which the snapshot holds everything of every channel (null without checkpoints)."""
    start = checkpoints.groupBy("pchannel").agg(F.min("offset").alias("__start"))
    rest = stream.join(start, "pchannel", "left")
    behind = F.col("p") >= F.col("__start") if inclusive else F.col("p") > F.col("__start")
    rest = rest.where(F.coalesce(behind, F.lit(True))).drop("__start")
    reads = snapshot.crossJoin(F.broadcast(checkpoints.agg(F.min("tso").alias("tso"))))
    rest = rest.withColumns({"op": operation(F.col("kind")), "phase": F.lit(1)})
    return reads.withColumns({"op": F.lit("r"), "phase": F.lit(0)}).unionByName(rest, allowMissingColumns=True)


def handoff_overlap(snapshot: DataFrame, stream: DataFrame, pk: list[str]) -> DataFrame:
    """Keys with the phase that holds them: snapshot, stream or both."""
    d = snapshot.select(*pk).distinct().withColumn("__a", F.lit(True)).join(stream.select(*pk).distinct().withColumn("__b", F.lit(True)), pk, "full_outer")
    return d.select(*pk, F.when(F.col("__a").isNull(), "stream").when(F.col("__b").isNull(), "snapshot").otherwise("both").alias("phase"))


def dedupe(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """One row per key, the first in order: an aggregate, so that copies are combined before the shuffle."""
    place = F.struct(*order)
    row = F.min_by(F.struct(*values), place)
    return df.groupBy(*keys).agg(row.alias("__r")).select(*keys, *(F.col("__r")[v].alias(v) for v in values))


def current_state(df: DataFrame, values: list[str]) -> DataFrame:
    """Rows that are left after df(collection, pk, tso, kind, p, values...) is applied: the last change of each key by
    tso, deletes first within a tso, then offset; keys whose last change is a delete are gone."""
    place = F.struct("tso", op_rank(F.col("kind")), "p")
    last = df.groupBy("collection", "pk").agg(F.max_by(F.struct("kind", "tso", *values), place).alias("__r"))
    return last.where("__r.kind <> 'Delete'").select("collection", "pk", F.col("__r.tso").alias("tso"), *(F.col("__r")[v].alias(v) for v in values))
