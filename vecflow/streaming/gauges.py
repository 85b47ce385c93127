"""Gauges of running streams, one row a batch, kept beyond the hundred that a query remembers.

gauged() lets a stream's own rows carry its gauges: they are observed while the rows are written, by no job of their own. A
GaugeListener hears of each batch's progress and appends a row to a table of JSON files: query, batch, time, rows and
milliseconds of the batch, watermark, lag, position, resolved, late and forced events, and rows and bytes of state. A batch
without rows (or without observed ones) repeats the last watermark and position of its query, with the lag
of its own time. Rows wait in the driver for ``every`` batches at most, and are written when the query ends. What can't be
written stays for the next time; a listener never ends a query.
"""

from __future__ import annotations

import json
import logging
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vecflow.functions.tso import SHIFT
from vecflow.streaming.sink import Folder

SCHEMA = "query string, run string, batch long, at_ms long, rows long, ms long, watermark long, lag_ms long, position long, resolved boolean, late long, forced long, state_rows long, state_bytes long"
NAME = "vecflow_gauges"


def gauged(ordered: DataFrame) -> DataFrame:
    """order_stream()'s rows (route, watermark, p), observed. With heartbeats each channel's state is seen in each batch
    that it takes part in. Several channels are one gauge: the highest watermark and offset of them."""
    return ordered.observe(
        NAME, F.max("watermark").alias("watermark"), F.max("p").alias("position"),
        F.count_if(F.col("route") == "late").alias("late"), F.count_if(F.col("route") == "forced").alias("forced"),
    )


class GaugeListener(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.folder, self.every = Folder(spark, path), every
        self.last: dict[str, tuple[int, int]] = {}
        self.rows: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(self.row(event.progress))
        if len(self.rows) >= self.every:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()

    def row(self, p) -> dict:
        """The gauges of one batch's progress."""
        query = str(p.id)
        seen = p.observedMetrics.get(NAME)
        seen = seen.asDict() if seen is not None else {}
        mark, position = self.last.get(query, (0, None))
        mark = max(mark, seen.get("watermark") or 0)
        position = position if seen.get("position") is None else max(position or 0, seen["position"])
        self.last[query] = mark, position
        at = int(datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
        return {
            "query": query, "run": str(p.runId), "batch": p.batchId, "at_ms": at, "rows": p.numInputRows, "ms": p.durationMs.get("triggerExecution", 0),
            "watermark": mark, "lag_ms": at - (mark >> SHIFT) if mark else None, "position": position, "resolved": mark > 0,
            "late": seen.get("late") or 0, "forced": seen.get("forced") or 0,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators),
        }

    def _write(self) -> None:
        if not self.rows:
            return
        first = self.rows[0]
        try:
            self.folder.put(f"{first['run']}-{first['batch']:09d}-{time.time_ns()}.json", "\n".join(map(json.dumps, self.rows)))
            self.rows = []
        except Exception:  # the rows stay
            logging.getLogger(__name__).exception("gauges were not written")


def read_gauges(spark: SparkSession, path: str) -> DataFrame:
    """Rows of SCHEMA, one for each batch; of a batch that was repeated, the last."""
    rows = spark.read.schema(SCHEMA).json(path)
    own = [f.name for f in rows.schema if f.name not in ("query", "batch")]
    return rows.groupBy("query", "batch").agg(F.max_by(F.struct(*own), "at_ms").alias("r")).select("query", "batch", "r.*")
