"""The data source over logs: batches by ranges, streams by offsets, and the hand-off from a snapshot in one query."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecflow.sources import log as L
from vecflow.sources import offsets


def messages(spark, rows):
    return spark.createDataFrame([(t, p, o, f"{t}{p}-{o}".encode()) for t, p, o in rows], "topic string, partition int, offset long, value binary")


def write(spark, path, rows, mode="append"):
    L.write_log(messages(spark, rows).coalesce(1), str(path), mode)


def run_until(df, sink, checkpoint, done, timeout=90):
    """Run a query until done(); whatever it wrote stays."""
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", str(checkpoint)).trigger(processingTime="200 milliseconds").start()
    try:
        end = time.time() + timeout
        while time.time() < end and not done():
            if q.exception() is not None:
                raise q.exception()
            time.sleep(0.2)
        assert done()
    finally:
        q.stop()


def test_batch_reads_the_groups_that_filters_leave(spark, tmp_path):
    for k in range(5):
        write(spark, tmp_path / "log", [("a", p, o) for p in (0, 1) for o in range(k * 10, k * 10 + 10)])
    df = offsets.read_offsets(spark, str(tmp_path / "log"))
    assert df.count() == 100
    some = df.where("topic = 'a' and partition = 1 and offset >= 35 and offset < 42")
    assert sorted((r.partition, r.offset, bytes(r.value)) for r in some.collect()) == [(1, o, f"a1-{o}".encode()) for o in range(35, 42)]
    assert some.rdd.getNumPartitions() == 2  # of five files
    assert df.where("topic = 'b'").count() == 0 and df.where("offset in (3, 47)").count() == 4


def test_empty_folder(spark, tmp_path):
    (tmp_path / "log").mkdir()
    assert offsets.read_offsets(spark, str(tmp_path / "log")).count() == 0


def test_stream_starts_at_offsets_and_resumes(spark, tmp_path):
    write(spark, tmp_path / "log", [("a", p, o) for p in (0, 1) for o in range(20)])
    got: list = []

    def sink(df, batch_id):
        got.extend((r.partition, r.offset) for r in df.collect())

    def stream():
        return offsets.stream_log(spark, str(tmp_path / "log"), str(tmp_path / "state/offset"), json.dumps({"a": {"0": 15, "1": -1}}), max_offsets=3)

    run_until(stream(), sink, tmp_path / "ck", lambda: len(got) >= 5)
    assert Counter(got) == Counter((0, o) for o in range(15, 20))
    write(spark, tmp_path / "log", [("a", 1, o) for o in range(20, 24)] + [("b", 0, 0)])
    got.clear()
    run_until(stream(), sink, tmp_path / "ck", lambda: len(got) >= 5)
    assert Counter(got) == Counter([(1, o) for o in range(20, 24)] + [(0, 0)])


class Killed(Exception):
    pass


@pytest.mark.parametrize("cut", [[1], [4], [1, 3, 6]])
def test_handoff_in_one_query_survives_kills(spark, tmp_path, cut):
    """Killed in batches of either phase, after their rows were written and before they were committed."""
    ids = spark.range(50).select("id", F.concat(F.lit("t"), F.col("id")).alias("title"))
    ids.repartition(4, "id").write.parquet(str(tmp_path / "snap"))
    write(spark, tmp_path / "log", [("a", 0, o) for o in range(30)])
    schema = StructType.fromDDL("id long, title string")
    got: list = []
    left = list(cut)

    def sink(df, batch_id):
        got.extend((batch_id, r.phase, r.offset if r.phase else r.row.id, r.row and r.row.title) for r in df.collect())
        if left and batch_id == left[0]:
            left.pop(0)
            raise Killed

    while True:
        df = offsets.stream_handoff(spark, str(tmp_path / "snap"), schema, str(tmp_path / "log"), str(tmp_path / "state/offset"), json.dumps({"a": {"0": 10}}), max_groups=1, max_offsets=8)
        try:
            run_until(df, sink, tmp_path / "ck", lambda: (1, 29) in {x[1:3] for x in got} and not left)
            break
        except AssertionError:
            raise
        except Exception as e:
            assert "Killed" in str(e)
    once = {x[1:] for x in got}
    assert once == {(0, i, f"t{i}") for i in range(50)} | {(1, o, None) for o in range(10, 30)}
    batches = {}
    for batch, *rest in got:
        batches.setdefault(batch, Counter())[tuple(rest)] += 1
    assert all(len(set(b.values())) == 1 for b in batches.values()) and sum(len(b) for b in batches.values()) == len(once)  # repeated batches hold the same rows
    assert max(b for b, phase, *_ in got if phase == 0) < min(b for b, phase, *_ in got if phase == 1)
