"""Upsert pairs in a stream: a delete and an insert of one key at one tso come out as one update.

A stateful operator by (collection, pk), to stand behind order_stream() in the same query. A group is what the key has at
one tso; it is open until the key's rows carry a watermark at or above that tso, as rows of order_stream() do when they
are released. Then it comes out once, as correlate_upserts() has it: op (u, c or d), p of its last part, payload of its last
insert. Groups above the watermark (input that is in no order yet) are held, with a timer: after ``hold_ms``
without news of the key they come out as they are. State holds open groups only, so keys at rest take no room; a part
that is delivered again after its group went out comes out again, alone: at least once, as the input is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "collection string, pk string, tso long, op string, p long, payload string"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


def merge(group: tuple | None, kind: str, p: int, payload: str | None) -> tuple:
    """A group (inserts, deletes, last p, p of the last insert, its payload) with one more row."""
    n_in, n_out, last, at, text = group or (0, 0, None, None, None)
    last = p if last is None else max(last, p)
    if kind == "Delete":
        return n_in, n_out + 1, last, at, text
    return (n_in + 1, n_out, last, p, payload) if at is None or p >= at else (n_in + 1, n_out, last, at, text)


def operation(group: tuple) -> str:
    return "u" if group[0] and group[1] else "c" if group[0] else "d"


class Pairs(StatefulProcessor):
    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "tso long", "inserts long, deletes long, p long, insert_p long, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        groups, held, mark = {}, {k[0]: tuple(v) for k, v in self.open.iterator()}, 0
        groups.update(held)
        for part in rows:
            for r in part.itertuples(index=False):
                groups[int(r.tso)] = merge(groups.get(int(r.tso)), r.kind, int(r.p), None if pd.isna(r.payload) else r.payload)
                mark = max(mark, 0 if pd.isna(r.watermark) else int(r.watermark))
        due = {t: g for t, g in groups.items() if t <= mark}
        for t in due:
            if t in held:
                self.open.removeKey((t,))
        for t, g in groups.items():
            if t > mark and g != held.get(t):
                self.open.updateValue((t,), g)
        self._wake(timerValues.getCurrentProcessingTimeInMs() if len(due) < len(groups) else None)
        yield self._out(key, due)

    def _wake(self, now: int | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if now is not None:
            self.handle.registerTimer(now + self.hold_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = {k[0]: tuple(v) for k, v in self.open.iterator()}
        self.open.clear()
        yield self._out(key, held)

    @staticmethod
    def _out(key, groups: dict) -> pd.DataFrame:
        rows = [(key[0], key[1], t, operation(g), g[2], g[4]) for t, g in sorted(groups.items())]
        return pd.DataFrame(rows, columns=_NAMES).astype({"tso": "Int64", "p": "Int64"})

    def close(self) -> None:
        pass


def correlate_stream(df: DataFrame, hold_ms: int = 60_000) -> DataFrame:
    """A stream of df(collection, pk, tso, kind, p, payload, watermark), Insert and Delete rows, as OUTPUT."""
    rows = df.select("collection", F.col("pk").cast("string").alias("pk"), "tso", "kind", "p", "payload", "watermark")
    return rows.groupBy("collection", "pk").transformWithStateInPandas(statefulProcessor=Pairs(hold_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")


def from_ordered(ordered: DataFrame, collection: str = "$.collection", pk: str = "$.pk") -> DataFrame:
    """Released changes of order_stream() with the collection and key of their JSON payload, as correlate_stream() reads them."""
    text = F.col("payload")
    return ordered.where("route in ('change', 'forced')").select(F.get_json_object(text, collection).alias("collection"), F.get_json_object(text, pk).alias("pk"), "tso", "kind", "p", "payload", "watermark")
