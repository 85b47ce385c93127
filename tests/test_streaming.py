"""The streaming orderer against a sequential model, the batch form, restarts and timers."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from vecflow.operators import ordering as O
from vecflow.streaming import order as S
from vecflow.streaming import state

FILE = "p long, kind string, pchannel string, vchannel string, tso long, payload string"


def model(rows):
    """(released p in order, late p) of one channel's rows (p, kind, vchannel, tso), one by one."""
    ticks, channel_tick, mark, pending, done, late = {}, 0, 0, [], [], []
    for p, kind, v, tso in rows:
        if kind != "TimeTick":
            if mark > 0 and tso <= mark:
                late.append(p)
                continue
            if v is not None and v not in ticks:
                ticks[v] = channel_tick
            pending.append((tso, kind != "Delete", p))
            continue
        if v is None:
            channel_tick = max(channel_tick, tso)
            ticks = {k: max(t, tso) for k, t in ticks.items()}
        else:
            ticks[v] = max(ticks.get(v, 0), tso)
        mark = max(mark, min(ticks.values(), default=channel_tick))
        out = sorted(x for x in pending if x[0] <= mark)
        pending = [x for x in pending if x[0] > mark]
        done += [p for _, _, p in out]
    return done, late


def random_log(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for p in range(n):
        kind = rng.choice(["Insert", "Insert", "Delete", "TimeTick"])
        v = rng.choice(["v0", "v1", "v2"]) if kind != "TimeTick" or rng.random() < 0.8 else None
        tso = (p * 10 + rng.randint(-40, 60) - (30 if kind == "TimeTick" else 0)) << 18 | rng.randint(0, 3)
        rows.append((p, kind, v, max(1, tso)))
    return rows


def drain(spark, path, out, checkpoint, rows, options=None, ticks=None):
    """Run a query until it has read ``rows`` rows: timers keep such a query going, so it never ends by itself."""
    src = spark.readStream.schema(FILE).option("maxFilesPerTrigger", 1).json(str(path))
    q = S.order_stream(src, options, ticks).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(processingTime="200 milliseconds").start()
    try:
        until = time.time() + 60
        while sum(b["rows"] for b in S.heartbeats(q)) < rows and time.time() < until:
            assert q.exception() is None
            time.sleep(0.3)
        return S.heartbeats(q)
    finally:
        q.stop()


def put(spark, path, rows, name):
    spark.createDataFrame([(p, k, "c", v, t, f"x{p}") for p, k, v, t in rows], FILE).coalesce(1).write.mode("append").json(str(path))


def test_stream_is_the_model_and_survives_a_restart(spark, tmp_path):
    rows = random_log(3)
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    options = S.Options(stall_timeout_ms=10**9)
    put(spark, src, rows[:50], "a")
    drain(spark, src, out, ck, 50, options)
    put(spark, src, rows[50:], "b")
    beats = drain(spark, src, out, ck, len(rows) - 50, options)  # a new query on the old checkpoint
    assert sum(h["rows"] for h in beats) == len(rows) - 50
    done, late = model(rows)
    got = spark.read.parquet(str(out))
    changes, dropped = S.split(got)
    assert [r.p for r in changes.orderBy("seq").collect()] == done
    assert sorted(r.p for r in dropped.collect()) == sorted(late)


@pytest.mark.parametrize("walk", [O.WALK, 0])
def test_batch_form_is_the_model(spark, monkeypatch, walk):
    monkeypatch.setattr(O, "WALK", walk)
    logs = {f"c{i}": random_log(i, 60) for i in range(12)}
    df = spark.createDataFrame([(p, k, c, v and f"{c}_{v}", t) for c, rows in logs.items() for p, k, v, t in rows], "p long, kind string, pchannel string, vchannel string, tso long")
    o = O.Ordered(df)
    done = O.in_order(o.released(width=50 << 18).where("release_p is not null")).orderBy("seq").collect()
    late = o.events.where("late").collect()
    for c, rows in logs.items():
        want = model(rows)
        # the total order by tso; the model releases tick by tick, which is the same order
        assert [r.p for r in done if r.pchannel == c] == want[0]
        assert sorted(r.p for r in late if r.pchannel == c) == sorted(want[1])


def test_stalled_channel_is_released(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    put(spark, src, [(0, "Insert", "v0", 150), (1, "Insert", "v1", 100)], "a")
    s = spark.readStream.schema(FILE).json(str(src))
    q = S.order_stream(s, S.Options(stall_timeout_ms=1500)).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(ck)).trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(60):
            time.sleep(1)
            got = spark.read.schema(S.OUTPUT).parquet(str(out)).collect() if out.exists() else []
            if len(got) == 2:
                break
        assert [(r.p, r.route, r.watermark) for r in sorted(got, key=lambda r: r.seq)] == [(1, "forced", 150), (0, "forced", 150)]
    finally:
        q.stop()


def test_full_buffer_makes_nothing_late_and_stored_ticks_count(spark, tmp_path):
    """A full channel that isn't stalled waits for its watermark: later events on time stay on time."""
    src, options = tmp_path / "in", S.Options(10**9, max_events=4, heartbeats=True)
    put(spark, src, [(i, "Insert", "v0", 1000 + i) for i in range(10)] + [(10, "Insert", "v0", 50), (11, "Insert", "v0", 990)], "a")
    ticks = spark.createDataFrame([("c", "v0", 60), ("c", "v1", 60), ("c", None, 70)], "pchannel string, vchannel string, tick long")
    drain(spark, src, tmp_path / "out", tmp_path / "ck", 12, options, ticks)
    # v2 takes over the stored channel-level tick of 70
    put(spark, src, [(12, "Insert", "v2", 995), (13, "TimeTick", "v0", 5000), (14, "TimeTick", "v1", 1004)], "b")
    drain(spark, src, tmp_path / "out", tmp_path / "ck", 3, options)
    put(spark, src, [(15, "TimeTick", "v2", 1004)], "c")
    drain(spark, src, tmp_path / "out", tmp_path / "ck", 1, options)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    changes = sorted((r for r in got if r.route in ("change", "forced")), key=lambda r: r.seq)
    assert [r.p for r in changes] == [11, 12, 0, 1, 2, 3, 4] and {r.route for r in changes} == {"change"}
    assert [r.p for r in got if r.route == "late"] == [10]  # below the stored ticks
    assert sorted((r.p, r.watermark) for r in got if r.route == "heartbeat") == [(11, 60), (14, 70), (15, 1004)]


def test_full_and_stalled_channel_is_released(spark, tmp_path):
    put(spark, tmp_path / "in", [(i, "Insert", "v0", 1000 - i) for i in range(5)], "a")
    drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "ck", 5, S.Options(0, max_events=4))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()
    assert [(r.p, r.route, r.watermark) for r in got] == [(4 - i, "forced", 1000) for i in range(5)]


def test_rows_of_one_message_all_come_out(spark, tmp_path):
    rows = [(0, i, "Insert", "c", "v0", 100, f"row{i}") for i in (2, 0, 1)] + [(1, i, "Delete", "c", "v0", 100, f"key{i}") for i in (1, 0)]
    want = ["key0", "key1", "row0", "row1", "row2"]
    tick = (2, 0, "TimeTick", "c", "v0", 200, None)
    for at, names in enumerate((S.INPUT.split(", "), [c for c in S.INPUT.split(", ") if c.split()[0] != "row_pos"])):
        src, out, ck = (tmp_path / f"{name}{at}" for name in ("in", "out", "ck"))
        spark.createDataFrame([*rows, tick], "p long, row_pos long, kind string, pchannel string, vchannel string, tso long, payload string").coalesce(1).write.json(str(src))
        s = spark.readStream.schema(", ".join(names)).json(str(src))
        q = S.order_stream(s, S.Options(10**9)).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(ck)).trigger(processingTime="200 milliseconds").start()
        try:
            until = time.time() + 60
            while sum(b["rows"] for b in S.heartbeats(q)) < 6 and time.time() < until:
                time.sleep(0.3)
        finally:
            q.stop()
        got = spark.read.parquet(str(out)).orderBy("seq").collect()
        assert [r.seq for r in got] == [1, 2, 3, 4, 5]
        assert [r.payload for r in got] == want if at == 0 else sorted(r.payload for r in got) == want


def test_reference_cases():
    c = S.Channel({"v0": None, "v1": None}, 0, 0)
    assert not c.tick("v0", 105) and c.tick("v1", 100) and c.watermark == 100
    assert c.is_late(100) and not c.is_late(101)
    c = S.Channel({"v0": 100, "v1": 80}, 0, 80)
    assert c.tick(None, 120) and c.ticks == {"v0": 120, "v1": 120}
    c = S.Channel({"v0": 200, "v1": 80}, 0, 80)
    c.tick(None, 150)
    assert c.ticks == {"v0": 200, "v1": 150} and c.watermark == 150
    c = S.Channel({}, 0, 0)
    c.tick(None, 100)
    c.track("late")
    assert c.ticks == {"late": 100} and c.tick(None, 160) and c.watermark == 160
    keys = [S.sort_key(5, "Insert", 0), S.sort_key(5, "Delete", 1), S.sort_key(5, "Insert", 2), S.sort_key(5, "Delete", 3), S.sort_key(4, "Insert", 9)]
    assert sorted(range(5), key=lambda i: keys[i]) == [4, 1, 3, 0, 2]


def test_state_of_a_run_starts_another(spark, tmp_path):
    """A new run, on a new checkpoint, from the state that the former one's checkpoint holds: as if unbroken."""
    rows, half, options = random_log(9), 70, S.Options(10**9)
    put(spark, tmp_path / "a", rows[:half], "a")
    drain(spark, tmp_path / "a", tmp_path / "out", tmp_path / "ck1", half, options)
    start = state.stored_state(spark, str(tmp_path / "ck1"))
    assert start.where("entry = 'event'").count() > 0
    start.write.parquet(str(tmp_path / "start"))
    kept = {r.key: r.val for r in state.progress_of(spark, str(tmp_path / "ck1")).collect()}
    assert kept["mq_offset_c"] == str(half - 1) and json.loads(state.resume_offsets(spark, str(tmp_path / "ck1"))) == {"c": {"0": half}}
    own = {v: max(t for _, k, w, t in rows[:half] if k == "TimeTick" and w == v) for v in ("v0", "v1", "v2")}
    assert all(int(kept[f"vchannel_timetick_{v}"]) >= t for v, t in own.items())
    put(spark, tmp_path / "b", rows[half:], "b")
    drain(spark, tmp_path / "b", tmp_path / "out2", tmp_path / "ck2", len(rows) - half, options, spark.read.parquet(str(tmp_path / "start")))
    done, late = model(rows)
    changes, dropped = S.split(spark.read.parquet(str(tmp_path / "out"), str(tmp_path / "out2")))
    assert [r.p for r in changes.orderBy("seq").collect()] == done and [r.seq for r in changes.orderBy("seq").collect()] == list(range(1, len(done) + 1))
    assert sorted(r.p for r in dropped.collect()) == sorted(late)


def test_repeated_changes_within_the_delay(spark, tmp_path):
    rows = [("c", 1, 5, "c", "2024-01-01 00:00:00"), ("c", 1, 5, "c", "2024-01-01 00:00:30"), ("c", 2, 5, "c", "2024-01-01 00:00:10")]
    schema = "collection string, pk long, tso long, op string, at timestamp"
    spark.createDataFrame(rows, "collection string, pk long, tso long, op string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.json(str(tmp_path / "in"))
    q = S.drop_repetitions(spark.readStream.schema(schema).json(str(tmp_path / "in")), "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.pk for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
