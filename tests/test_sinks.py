"""Upsert pairs, sinks with a ledger and gauges of streams."""

import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vecflow.operators.changes import correlate_upserts
from vecflow.streaming import gauges, pairs, sink
from vecflow.streaming import order as S

FILE = "p long, kind string, pchannel string, vchannel string, tso long, payload string"
ROWS = "collection string, pk string, tso long, kind string, p long, payload string, watermark long"


class Killed(Exception):
    pass


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))


def run(df, out, checkpoint, rows, seconds=90):
    q = df.writeStream.format("json").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(processingTime="200 milliseconds").start()
    try:
        end = time.time() + seconds
        while sum(b["rows"] for b in S.heartbeats(q)) < rows and time.time() < end:
            assert q.exception() is None
            time.sleep(0.2)
        assert sum(b["rows"] for b in S.heartbeats(q)) >= rows
    finally:
        q.stop()


def upsert_log(seed, n=90):
    """Deletes and inserts of few keys, alone and in pairs, in and out of order, with ticks."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        tso, pk = ((i * 10 + rng.randint(-15, 15)) << 18) + 1, rng.randint(0, 5)
        kinds = rng.choice([["Insert"], ["Delete"], ["Insert", "Delete"], ["Delete", "Insert"], ["Insert", "Insert", "Delete"]])
        rows += [(k, f"v{pk % 2}", max(1, tso), json.dumps({"collection": "c", "pk": pk, "v": rng.randint(0, 99)})) for k in kinds]
        if i % 6 == 5:
            rows += [("TimeTick", v, max(1, (i * 10 - 30) << 18), None) for v in ("v0", "v1")]
    rows += [("TimeTick", v, (n * 100) << 18, None) for v in ("v0", "v1")]
    return [(p, k, "ch", v, t, x) for p, (k, v, t, x) in enumerate(rows)]


def test_pairs_behind_the_orderer_equal_the_batch(spark, tmp_path):
    """Two stateful operators in one query, stopped and started again in between."""
    rows = upsert_log(7)
    half = len(rows) // 2
    while rows[half][1] != "TimeTick":
        half += 1

    def query():
        src = spark.readStream.schema(FILE).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        return pairs.correlate_stream(pairs.from_ordered(S.order_stream(src, S.Options(10**9))), hold_ms=10**9)

    put(spark, tmp_path / "in", rows[:half], FILE)
    run(query(), tmp_path / "out", tmp_path / "ck", half)
    put(spark, tmp_path / "in", rows[half:], FILE)
    run(query(), tmp_path / "out", tmp_path / "ck", len(rows) - half)
    got = spark.read.schema(pairs.OUTPUT).json(str(tmp_path / "out"))
    out = S.order_stream(spark.createDataFrame(rows, FILE), S.Options(10**9))
    changes = pairs.from_ordered(out).drop("watermark")
    want = correlate_upserts(changes, ["payload"])
    key = lambda d: Counter((r.collection, r.pk, r.tso, r.op, r.p, r.payload) for r in d.collect())
    assert key(got) == key(want) and {r[3] for r in key(want)} == {"c", "d", "u"}


def test_halves_wait_for_the_watermark_across_batches_and_restarts(spark, tmp_path):
    def query(hold):
        return pairs.correlate_stream(spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), hold)

    def rows():
        return sorted(((r.pk, r.tso, r.op, r.p, r.payload) for r in spark.read.schema(pairs.OUTPUT).json(str(tmp_path / "out")).collect()), key=str)

    put(spark, tmp_path / "in", [("c", "1", 100, "Delete", 0, None, 50), ("c", "2", 100, "Insert", 1, "b", None), ("c", "3", 40, "Insert", 2, "early", 50)], ROWS)
    run(query(10**9), tmp_path / "out", tmp_path / "ck", 3)
    assert rows() == [("3", 40, "c", 2, "early")]
    put(spark, tmp_path / "in", [("c", "1", 100, "Insert", 3, "a", 60), ("c", "1", 200, "Delete", 4, None, 60), ("c", None, 10, "Insert", 5, "no key", 60)], ROWS)
    run(query(10**9), tmp_path / "out", tmp_path / "ck", 3)
    put(spark, tmp_path / "in", [("c", "1", 300, "Insert", 6, "z", 150)], ROWS)
    run(query(10**9), tmp_path / "out", tmp_path / "ck", 1)
    assert sorted(rows(), key=str) == sorted([("3", 40, "c", 2, "early"), (None, 10, "c", 5, "no key"), ("1", 100, "u", 3, "a")], key=str)


def test_held_groups_come_out_by_timer(spark, tmp_path):
    put(spark, tmp_path / "in", [("c", "1", 100, "Delete", 0, None, 50), ("c", "1", 100, "Insert", 1, "a", 50), ("c", "2", 90, "Delete", 2, None, 0)], ROWS)
    df = pairs.correlate_stream(spark.readStream.schema(ROWS).json(str(tmp_path / "in")), 1000)
    q = df.writeStream.format("json").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="300 milliseconds").start()
    try:
        end = time.time() + 60
        while time.time() < end:
            time.sleep(0.5)
            got = sorted((r.pk, r.tso, r.op, r.p, r.payload) for r in spark.read.schema(pairs.OUTPUT).json(str(tmp_path / "out")).collect()) if (tmp_path / "out").exists() else []
            if len(got) == 2:
                break
        assert got == [("1", 100, "u", 1, "a"), ("2", 90, "d", 2, None)]
    finally:
        q.stop()


@pytest.mark.parametrize("fault", ["between targets", "within a target", "before the note"])
def test_sink_loses_and_doubles_nothing(spark, tmp_path, fault):
    """Killed while a batch is half written; a new query on the old checkpoint repeats it."""
    schema = "topic string, key string, value string"
    for k in range(4):
        put(spark, tmp_path / "in", [(f"t{i % 3}", str(k), f"{k}-{i}") for i in range(30)], schema)
    ledger = sink.Ledger(spark, str(tmp_path / "ledger"))
    first, second = sink.files_target(str(tmp_path / "a")), sink.files_target(str(tmp_path / "b"), "json")
    left = [1]

    def broken(df, batch_id):
        if batch_id == 2 and left:
            left.pop()
            if fault == "within a target":
                df.where("topic = 't0'").write.mode("overwrite").partitionBy("topic").json(str(tmp_path / f"b/batch={batch_id}"))
            elif fault == "before the note":
                second(df, batch_id)
            raise Killed
        second(df, batch_id)

    def go():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        q = sink.start(src, {"a": first, "b": broken}, ledger, str(tmp_path / "ck"), availableNow=True)
        q.awaitTermination()

    with pytest.raises(Exception, match="Killed"):
        go()
    assert ledger.batches("a") == [0, 1, 2] and ledger.batches("b") == [0, 1]
    go()
    want = sorted(f"{k}-{i}" for k in range(4) for i in range(30))
    for target, path, fmt in (("a", "a", "parquet"), ("b", "b", "json")):
        rows = sink.read_target(spark, str(tmp_path / path), ledger, target, fmt).collect()
        assert sorted(r.value for r in rows) == want and {r.topic for r in rows} == {"t0", "t1", "t2"}
    assert sorted((r.batch, r.rows) for r in sink.read_counters(ledger, "b").collect()) == [(k, 30) for k in range(4)]
    assert len(list((tmp_path / "a/batch=0").glob("topic=*"))) == 3


def test_batches_without_rows(spark, tmp_path):
    ledger, df = sink.Ledger(spark, str(tmp_path / "ledger")), spark.createDataFrame([("t", "v")], "topic string, value string")
    write = sink.batch_writer({"a": sink.files_target(str(tmp_path / "a"))}, ledger)
    assert sink.read_target(spark, str(tmp_path / "a"), ledger, "a") is None
    write(df.where("false"), 0)
    assert sink.read_target(spark, str(tmp_path / "a"), ledger, "a") is None and ledger.batches("a") == [0]
    write(df, 1)
    write(df, 1)
    assert [r.value for r in sink.read_target(spark, str(tmp_path / "a"), ledger, "a").collect()] == ["v"]


def test_counters_come_with_the_write(spark, tmp_path):
    """The counters of pipeline_counters, seen by the job that writes the rows."""
    rows = [(p, k, "c", v, t, "x") for p, (k, v, t) in enumerate([("Insert", "v0", 10), ("Insert", "v1", 30), ("TimeTick", "v0", 20), ("TimeTick", "v1", 20), ("Insert", "v0", 15), ("Delete", "v0", 25), ("TimeTick", None, 26)])]
    put(spark, tmp_path / "in", rows, FILE)
    ledger = sink.Ledger(spark, str(tmp_path / "ledger"))
    ordered = S.order_stream(spark.readStream.schema(FILE).json(str(tmp_path / "in")), S.Options(10**9)).withColumn("topic", F.col("route"))
    q = sink.start(ordered, {"out": sink.files_target(str(tmp_path / "out"))}, ledger, str(tmp_path / "ck"), sink.route_counters(), processingTime="200 milliseconds")
    try:
        end = time.time() + 60
        while not ledger.batches("out") and time.time() < end:
            time.sleep(0.2)
    finally:
        q.stop()
    r = sink.read_counters(ledger, "out").where("batch = 0").first()
    assert (r.rows, r.late, r.released, r.forced, r.watermark, r.position) == (3, 1, 2, 0, 26, 5)


def test_gauges_of_more_batches_than_a_query_remembers(spark, tmp_path):
    n = 130
    for k in range(n):
        (tmp_path / "in").mkdir(exist_ok=True)
        row = {"pchannel": "c", "p": k, "watermark": (k // 2) << 18, "route": ["change", "late", "forced"][k % 3]}
        (tmp_path / f"in/{k:04d}.json").write_text(json.dumps(row) + "\n")
        os.utime(tmp_path / f"in/{k:04d}.json", (10**9 + k, 10**9 + k))  # files are taken by age
    listener = gauges.GaugeListener(spark, str(tmp_path / "gauges"), every=20)
    spark.streams.addListener(listener)
    try:
        src = spark.readStream.schema("pchannel string, p long, watermark long, route string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        q = gauges.gauged(src).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert len(q.recentProgress) <= 100
        end = time.time() + 30
        while time.time() < end and (not (tmp_path / "gauges").exists() or gauges.read_gauges(spark, str(tmp_path / "gauges")).count() < n):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = {r.batch: r for r in gauges.read_gauges(spark, str(tmp_path / "gauges")).collect()}
    assert sorted(got) == list(range(n))
    marks = [got[b].watermark for b in range(n)]
    assert marks == sorted(marks) and marks[-1] == ((n - 1) // 2) << 18
    assert sorted(got[b].position for b in range(n)) == list(range(n)) and not got[0].resolved and got[n - 1].resolved
    assert sum(got[b].late for b in range(n)) == sum(k % 3 == 1 for k in range(n)) and got[n - 1].lag_ms == got[n - 1].at_ms - (n - 1) // 2


def test_gauges_of_the_orderer(spark, tmp_path):
    """Watermark, position and state of an ordering stream with heartbeats, also in batches that release nothing."""
    listener = gauges.GaugeListener(spark, str(tmp_path / "gauges"))
    spark.streams.addListener(listener)
    try:
        for k, rows in enumerate([[(0, "Insert", "c", "v0", 10 << 18, "x")], [(1, "TimeTick", "c", "v0", 20 << 18, None), (2, "Insert", "c", "v0", 15 << 18, "y")]]):
            put(spark, tmp_path / "in", rows, FILE)
            src = gauges.gauged(S.order_stream(spark.readStream.schema(FILE).json(str(tmp_path / "in")), S.Options(10**9, heartbeats=True)))
            run(src, tmp_path / "out", tmp_path / "ck", len(rows))
    finally:
        spark.streams.removeListener(listener)
    end = time.time() + 20
    rows = []
    while time.time() < end and len([r for r in rows if r.rows]) < 2:
        time.sleep(0.5)
        rows = sorted(gauges.read_gauges(spark, str(tmp_path / "gauges")).collect(), key=lambda r: r.batch)
    busy = [r for r in rows if r.rows]
    assert [(r.watermark, r.position, r.resolved, r.late) for r in busy] == [(0, 0, False, 0), (20 << 18, 2, True, 1)]
    assert busy[0].state_rows > 0 and busy[0].state_bytes > 0
