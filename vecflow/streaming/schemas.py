"""First schemas and drift in a stream: the fields of each collection's first insert, in release order, and what differs later.

Rows of released inserts are put together by (collection, fields) in each task before they are shuffled, with their number
and first place, so that a collection that a third of all rows belong to sends a few rows a batch. A stateful operator by
collection keeps the fields of the first insert, which later ones never replace, and gives a row of kind "schema" when it
learns them, and rows of kind "drift" for inserts with other fields: added up, they are schema_drift()'s rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "kind string, collection string, fields array<string>, seq long, extra array<string>, missing array<string>, n long"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
#: Distinct (collection, fields) that a task holds before it sends them on.
HELD = 50_000


def _together(batches):
    held: dict = {}

    def rows():
        keys = list(held)
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([list(k[1]) for k in keys], pa.list_(pa.string())),
            pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1] for k in keys], pa.int64()),
        ], ["collection", "fields", "seq", "n"])

    for batch in batches:
        for c, fields, seq in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            key = c, tuple(fields or ())
            was = held.get(key)
            held[key] = (seq, 1) if was is None else (min(was[0], seq), was[1] + 1)
        if len(held) > HELD:
            yield rows()
            held.clear()
    yield rows()


class FirstSchema(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "fields array<string>, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = sorted(((int(r.seq), tuple(r.fields), int(r.n)) for part in rows for r in part.itertuples(index=False)), key=lambda r: r[:2])
        out: list[tuple] = []
        if self.first.exists():
            own = tuple(self.first.get()[0])
        else:
            seq, own, _ = found[0]
            self.first.update((list(own), seq))
            out.append(("schema", key[0], list(own), seq, None, None, None))
        for seq, fields, n in found:
            extra, missing = sorted(set(fields) - set(own)), sorted(set(own) - set(fields))
            if extra or missing:
                out.append(("drift", key[0], None, seq, extra, missing, n))
        yield pd.DataFrame(out, columns=_NAMES).astype({"seq": "Int64", "n": "Int64"})

    def close(self) -> None:
        pass


def schema_stream(inserts: DataFrame) -> DataFrame:
    """A stream of inserts(collection, fields array<string>, seq), seq rising in release order, as OUTPUT."""
    few = inserts.select("collection", "fields", F.col("seq").cast("long").alias("seq")).mapInArrow(_together, "collection string, fields array<string>, seq long, n long")
    return few.groupBy("collection").transformWithStateInPandas(statefulProcessor=FirstSchema(), outputStructType=OUTPUT, outputMode="Append", timeMode="None")


def split_schemas(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first schemas, drift) of schema_stream()'s rows, the second a row for each batch."""
    return df.where("kind = 'schema'").select("collection", "fields", "seq"), df.where("kind = 'drift'").select("collection", "extra", "missing", "n")
