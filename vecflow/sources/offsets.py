"""A Spark data source, "vecflow_log", over message logs in Parquet files, in batches and streams, by offset ranges.

Files have the columns of sources.log (topic, partition, offset, key, value, timestamp); row groups whose statistics
name one topic partition are told apart without being read, others have their three leading columns read once (write
logs in order of topic, partition and offset, as sources.log.write_log does, and there are few of those).

A batch reads the row groups that its filters leave: comparisons of topic, partition and offset are held against the
statistics (spark.sql.python.filterPushdown.enabled), and Spark applies them to the rows as well.

A stream has two phases. The first, if a ``snapshot`` folder is given, reads its Parquet files row group by row group; the
second reads the log from ``start`` on (JSON as of sources.log.starting_offsets; partitions that it doesn't name are read
from their beginning, -1 means from what is there at first). No row of the second phase is planned before all batches of
the first have been committed: a batch is planned only when the one before it has been. Offsets, in the query's
checkpoint, are the row groups of the snapshot that are done and the next offset of each topic partition; so a query that
is killed in either phase goes on where it was, with the batch that was cut off repeated: at least once. ``state`` names
a file for the last planned offset, which a restarted query reads, as Spark doesn't tell a Python source where it stands.

Options: path; snapshot, snapshotSchema (JSON); start; state; maxGroups (row groups of the snapshot in one batch);
maxOffsets (of each topic partition in one batch); rowsPerTask. Rows of a snapshot are in ``row``, a struct, with phase 0; messages
have phase 1. Files must stay as they are; new ones may come. A folder without files gives no rows.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

MESSAGE = StructType().add("topic", "string").add("partition", "integer").add("offset", "long").add("key", "binary").add("value", "binary").add("timestamp", "timestamp")
KEY = ("topic", "partition", "offset")


def _place(path: str) -> tuple[pf.FileSystem, str]:
    return pf.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pf.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    fs, at = _place(path)
    found = fs.get_file_info(pf.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))


class Group(NamedTuple):
    """A row group's part of one topic partition: offsets from lo to hi."""

    file: str
    group: int
    topic: str
    partition: int
    lo: int
    hi: int


class Index:
    """Row groups of a log's files by topic partition; files are looked into once."""

    def __init__(self, path: str):
        self.path, self.seen, self.groups = path, set(), []

    def refresh(self) -> list[Group]:
        fs, _ = _place(self.path)
        for file in _files(self.path):
            if file in self.seen:
                continue
            f = pq.ParquetFile(file, filesystem=fs)
            for g in range(f.metadata.num_row_groups):
                self.groups += self._of(f, file, g)
            self.seen.add(file)
        return self.groups

    @staticmethod
    def _of(f: pq.ParquetFile, file: str, g: int) -> list[Group]:
        meta = f.metadata.row_group(g)
        if not meta.num_rows:
            return []
        stats = {meta.column(c).path_in_schema: meta.column(c).statistics for c in range(meta.num_columns)}
        bounds = [(s.min, s.max) if (s := stats.get(k)) is not None and s.has_min_max and not s.null_count else None for k in KEY]
        if None not in bounds and all(lo == hi for lo, hi in bounds[:2]):
            (topic, _), (partition, _), (lo, hi) = bounds
            return [Group(file, g, topic, partition, lo, hi)]
        t = f.read_row_group(g, columns=list(KEY))
        t = t.filter(pc.and_(pc.is_valid(t["topic"]), pc.and_(pc.is_valid(t["partition"]), pc.is_valid(t["offset"]))))
        by = t.group_by(list(KEY[:2])).aggregate([("offset", "min"), ("offset", "max")])
        return [Group(file, g, r["topic"], r["partition"], r["offset_min"], r["offset_max"]) for r in by.to_pylist()]


class Rows(InputPartition):
    """Rows of row groups: of a log, those of some offset ranges; of a snapshot, all of them."""

    def __init__(self, path: str, groups: list[tuple[str, int]], ranges: dict | None = None, phase: int = 1):
        self.path, self.groups, self.ranges, self.phase = path, groups, ranges, phase


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _messages(table: pa.Table, ranges: dict | None) -> pa.Table:
    if ranges is None:
        return table
    wanted = None
    for (topic, partition), (lo, hi) in ranges.items():
        o = table["offset"]
        mine = pc.and_(pc.and_(pc.equal(table["topic"], topic), pc.equal(table["partition"], partition)), pc.and_(pc.greater_equal(o, lo), pc.less(o, hi)))
        wanted = mine if wanted is None else pc.or_(wanted, mine)
    return table.filter(wanted)


def _read(p: Rows, schema: pa.Schema):
    fs, _ = _place(p.path)
    for file, g in p.groups:
        table = pq.ParquetFile(file, filesystem=fs).read_row_group(g)
        if p.phase:
            table = _messages(table, p.ranges)
        n = table.num_rows
        columns = []
        for f in schema:
            if f.name == "phase":
                columns.append(pa.array([p.phase] * n, f.type))
            elif f.name == "row" and not p.phase:
                own = [table[c.name].combine_chunks().cast(c.type) if c.name in table.column_names else pa.nulls(n, c.type) for c in f.type]
                columns.append(pa.StructArray.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in own], fields=list(f.type)))
            elif p.phase and f.name in table.column_names:
                columns.append(table[f.name].cast(f.type))
            else:
                columns.append(pa.nulls(n, f.type))
        yield from pa.table(columns, schema=schema).to_batches(max_chunksize=10_000)


class LogReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.tests = schema, options["path"], []

    def pushFilters(self, filters):
        for f in filters:
            if len(getattr(f, "attribute", ())) == 1 and f.attribute[0] in KEY and isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                self.tests.append(f)
            yield f  # rows are told apart by Spark

    def _may_hold(self, g: Group) -> bool:
        for f in self.tests:
            lo, hi = (g.topic, g.topic) if f.attribute[0] == "topic" else (g.partition, g.partition) if f.attribute[0] == "partition" else (g.lo, g.hi)
            values = f.value if isinstance(f, In) else (f.value,)
            ok = {
                EqualTo: lambda v: lo <= v <= hi, In: lambda v: lo <= v <= hi, GreaterThan: lambda v: hi > v,  # noqa: B023
                GreaterThanOrEqual: lambda v: hi >= v, LessThan: lambda v: lo < v, LessThanOrEqual: lambda v: lo <= v,  # noqa: B023
            }[type(f)]
            if not any(ok(v) for v in values):
                return False
        return True

    def partitions(self):
        wanted = dict.fromkeys((g.file, g.group) for g in Index(self.path).refresh() if self._may_hold(g))
        return [Rows(self.path, [g]) for g in wanted] or [Rows(self.path, [])]

    def read(self, partition):
        return _read(partition, _arrow(self.schema))


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.state = schema, options["path"], options["state"]
        self.snapshot, self.index = options.get("snapshot"), Index(options["path"])
        self.start = {(t, int(p)): o for t, ps in json.loads(options.get("start") or "{}").items() for p, o in ps.items()}
        self.max_groups, self.max_offsets = (int(options.get(k) or 2**62) for k in ("maxGroups", "maxOffsets"))
        self.rows_per_task = int(options.get("rowsPerTask") or 1_000_000)
        self.reads = self._snapshot_groups()
        self.known, self.first = None, None

    def _snapshot_groups(self) -> list[tuple[str, int]]:
        if not self.snapshot:
            return []
        fs, _ = _place(self.snapshot)
        return [(f, g) for f in _files(self.snapshot) for g in range(pq.ParquetFile(f, filesystem=fs).metadata.num_row_groups)]

    def _ends(self) -> dict:
        """The next offset of each topic partition."""
        out: dict = {}
        for g in self.index.refresh():
            out[g.topic, g.partition] = max(out.get((g.topic, g.partition), 0), g.hi + 1)
        return out

    def _save(self, offset: dict) -> None:
        fs, at = _place(self.state)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(at + ".new") as f:
            f.write(json.dumps(offset).encode())
        fs.move(at + ".new", at)

    def _first(self) -> dict:
        there = self._ends() if -1 in self.start.values() else {}
        log: dict = {}
        for (topic, partition), o in self.start.items():
            log.setdefault(topic, {})[str(partition)] = there.get((topic, partition), 0) if o == -1 else o
        return {"snapshot": 0, "log": log}

    def initialOffset(self) -> dict:
        """Asked for by a query that has no checkpoint yet, after its first latestOffset()."""
        return self.first or self._first()

    def latestOffset(self) -> dict:
        if self.known is None:
            fs, at = _place(self.state)
            if fs.get_file_info(at).is_file:
                with fs.open_input_stream(at) as f:
                    self.known = json.loads(f.read())
            else:
                self.known = self.first = self._first()
        done = self.known["snapshot"]
        if done < len(self.reads):
            return {"snapshot": min(len(self.reads), done + self.max_groups), "log": self.known["log"]}
        log = {t: dict(ps) for t, ps in self.known["log"].items()}
        for (topic, partition), end in self._ends().items():
            at = log.setdefault(topic, {}).get(str(partition), 0)
            log[topic][str(partition)] = max(at, min(end, at + self.max_offsets))
        return {"snapshot": done, "log": log}

    def partitions(self, start: dict, end: dict):
        self._save(end)
        self.known = end
        out = [Rows(self.snapshot, [g], phase=0) for g in self.reads[start["snapshot"] : end["snapshot"]]]
        ranges = {}
        for topic, ps in end["log"].items():
            for partition, hi in ps.items():
                lo = start["log"].get(topic, {}).get(partition, 0)
                if lo < hi:
                    ranges[topic, int(partition)] = (lo, hi)
        groups: dict = {}
        for g in self.index.refresh():
            if (r := ranges.get((g.topic, g.partition))) and g.lo < r[1] and g.hi >= r[0]:
                groups.setdefault((g.file, g.group), {})[g.topic, g.partition] = r
        return out + [Rows(self.path, [at], own) for at, own in groups.items()] or [Rows(self.path, [])]

    def read(self, partition):
        return _read(partition, _arrow(self.schema))


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vecflow_log"

    def schema(self) -> StructType:
        out = StructType(list(MESSAGE))
        if self.options.get("snapshot"):
            out = out.add("phase", "integer").add("row", StructType.fromJson(json.loads(self.options["snapshotSchema"])))
        return out

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(schema, self.options)

    def streamReader(self, schema: StructType) -> LogStreamReader:
        return LogStreamReader(schema, self.options)


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """A log's messages as a batch; filters on topic, partition and offset leave row groups unread."""
    spark.dataSource.register(LogSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("vecflow_log").option("path", path).load()


def stream_log(spark: SparkSession, path: str, state: str, start: str = "{}", max_offsets: int | None = None) -> DataFrame:
    """A log's messages as a stream from ``start`` on. state: see the module."""
    return _stream(spark, path, state, start, {"maxOffsets": max_offsets})


def stream_handoff(spark: SparkSession, snapshot: str, snapshot_schema: StructType, path: str, state: str, start: str = "{}", max_groups: int | None = None, max_offsets: int | None = None) -> DataFrame:
    """One stream of a snapshot's rows (phase 0, in ``row``), and then of a log's messages (phase 1) from ``start`` on,
    which is where the log stood when the snapshot was taken (sources.log.resume_plan and starting_offsets)."""
    return _stream(spark, path, state, start, {"snapshot": snapshot, "snapshotSchema": snapshot_schema.json(), "maxGroups": max_groups, "maxOffsets": max_offsets})


def _stream(spark: SparkSession, path: str, state: str, start: str, options: dict) -> DataFrame:
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format("vecflow_log").option("path", path).option("state", state).option("start", start)
    for k, v in options.items():
        if v is not None:
            reader = reader.option(k, v)
    return reader.load()
