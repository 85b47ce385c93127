"""Sinks of a stream by foreachBatch: all topics of a batch in one pass, each target once a batch.

A batch is written to each of its targets (folders of files by topic, Kafka, or any function of frame and batch id), and
then noted in the target's ledger, a folder with one small file a batch. A batch that Spark repeats, after
a failure anywhere, skips targets that are noted and does the others anew. Files of a batch lie in a folder of its own,
which a repetition replaces, and readers take the folders that are noted: so no row of a files target is lost or doubled,
whatever is cut off when. Kafka takes part as well as it can: a topic's rows may be there twice if a send was cut off
(at least once), and the record's headers name batch and target, by which readers can tell.

Counters come with the writes: they are observed in the job that writes the first target, not counted by jobs of their own.
A batch with more than one target is kept (on disk, if need be) while they are written, so that it is computed once.
Ledgers must lie where driver and readers see them; a new checkpoint needs a new ledger, as batch ids start again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Target = Callable[[DataFrame, int], None]


class Folder:
    """Small files below a path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, jvm = path.rstrip("/"), spark._jvm
        self._at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def put(self, name: str, text: str) -> None:
        """Whole or not at all: written aside, then renamed."""
        aside = self._at(f"_{name}.new")
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._fs.delete(self._at(name), False)
        self._fs.rename(aside, self._at(name))

    def names(self) -> list[str]:
        if not self._fs.exists(self._at("")):
            return []
        return sorted(n for s in self._fs.listStatus(self._at("")) if not (n := s.getPath().getName()).startswith(("_", ".")))


@dataclass
class Ledger:
    """Which batches of which targets are done."""

    spark: SparkSession
    path: str
    folders: dict = field(default_factory=dict)

    def of(self, target: str) -> Folder:
        if target not in self.folders:
            self.folders[target] = Folder(self.spark, f"{self.path}/{target}")
        return self.folders[target]

    def done(self, target: str, batch_id: int) -> bool:
        return self.of(target).has(f"{batch_id:012d}.json")

    def note(self, target: str, batch_id: int, what: dict) -> None:
        self.of(target).put(f"{batch_id:012d}.json", json.dumps({"target": target, "batch": batch_id} | what))

    def batches(self, target: str) -> list[int]:
        return [int(n.split(".")[0]) for n in self.of(target).names()]


def files_target(path: str, fmt: str = "parquet", **options) -> Target:
    """A folder for each batch, in it one for each topic."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format(fmt).options(**options).mode("overwrite").partitionBy("topic").save(f"{path}/batch={batch_id}")

    return write


def kafka_target(name: str, **options) -> Target:
    """Rows (topic, key, value) to Kafka, with headers that name target and batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        header = lambda k, v: F.struct(F.lit(k).alias("key"), F.encode(F.lit(v), "UTF-8").alias("value"))
        df.withColumn("headers", F.array(header("target", name), header("batch", str(batch_id)))).write.format("kafka").option("includeHeaders", "true").options(**options).save()

    return write


def read_target(spark: SparkSession, path: str, ledger: Ledger, target: str, fmt: str = "parquet", schema=None) -> DataFrame | None:
    """The rows of a files target's noted batches; None while there are none. Batches without rows have no files."""
    done = [p for b in ledger.batches(target) if Folder(spark, p := f"{path}/batch={b}").names()]
    if not done:
        return None
    reader = spark.read.format(fmt).option("basePath", path)
    return (reader.schema(schema) if schema is not None else reader).load(done)


def route_counters() -> dict[str, Column]:
    """Late, released and forced events, bytes of payload, and the highest watermark and offset of a batch."""
    is_ = lambda r: F.count_if(F.col("route") == r)
    return {
        "rows": F.count(F.lit(1)), "late": is_("late"), "released": is_("change"), "forced": is_("forced"),
        "bytes": F.coalesce(F.sum(F.length("payload")), F.lit(0)), "watermark": F.max("watermark"), "position": F.max("p"),
    }


def batch_writer(targets: dict[str, Target], ledger: Ledger, counters: dict[str, Column] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch. The frame needs a topic for files and Kafka targets."""
    counters = counters or {"rows": F.count(F.lit(1))}

    def write(df: DataFrame, batch_id: int) -> None:
        todo = [t for t in targets if not ledger.done(t, batch_id)]
        if not todo:
            return
        kept = df.persist(StorageLevel.MEMORY_AND_DISK) if len(todo) > 1 else df
        counts: dict | None = None
        try:
            for t in todo:
                if counts is None:
                    seen = Observation(f"{t}-{batch_id}")
                    targets[t](kept.observe(seen, *(c.alias(n) for n, c in counters.items())), batch_id)
                    counts = dict(seen.get)
                else:
                    targets[t](kept, batch_id)
                ledger.note(t, batch_id, counts)
        finally:
            if kept is not df:
                kept.unpersist()

    return write


def start(df: DataFrame, targets: dict[str, Target], ledger: Ledger, checkpoint: str, counters: dict[str, Column] | None = None, **trigger):
    """Start a query that writes df's batches to the targets; trigger as of DataStreamWriter.trigger."""
    w = df.writeStream.foreachBatch(batch_writer(targets, ledger, counters)).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def read_counters(ledger: Ledger, target: str) -> DataFrame:
    """The ledger's rows: target, batch and the counters of each batch."""
    return ledger.spark.read.json(f"{ledger.path}/{target}/*.json")
