"""Operators on the cases that their rules name."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecflow.functions import convert as V
from vecflow.functions import types as Y
from vecflow.functions import vectors as W
from vecflow.functions.tso import effective_tso, or_default
from vecflow.operators import asof, changes, decode, envelope, metrics, pivot, schema, snapshot
from vecflow.operators import ordering as O
from vecflow.sources import log as L

LOG = "p long, kind string, pchannel string, vchannel string, tso long"


def log(spark, rows):
    return spark.createDataFrame([(p, k, "c", v, t) for p, (k, v, t) in enumerate(rows)], LOG)


def released(spark, rows):
    return [(r.tso, r.kind) for r in O.ordered_changes(log(spark, rows)).orderBy("seq").collect()]


def test_least_tick_gates_release(spark):
    rows = [("Insert", "v0", 100), ("Insert", "v1", 85), ("Insert", "v0", 92), ("Insert", "v1", 110), ("TimeTick", "v0", 105), ("TimeTick", "v1", 100)]
    assert [t for t, _ in released(spark, rows)] == [85, 92, 100]
    assert [t for t, _ in released(spark, rows[:-1])] == []


def test_deletes_go_first_within_a_tso(spark):
    rows = [("Insert", "v0", 100), ("Delete", "v0", 100), ("Insert", "v0", 90), ("Delete", "v0", 100), ("TimeTick", "v0", 100)]
    assert released(spark, rows) == [(90, "Insert"), (100, "Delete"), (100, "Delete"), (100, "Insert")]


def test_an_event_at_the_watermark_is_late(spark):
    o = O.Ordered(log(spark, [("TimeTick", "v0", 100), ("Insert", "v0", 100), ("Insert", "v0", 101)]))
    assert [r.tso for r in o.events.where("late").collect()] == [100]


def test_late_discovery_takes_over_channel_ticks(spark):
    rows = [("TimeTick", None, 100), ("Insert", "v9", 150), ("TimeTick", None, 160)]
    assert [t for t, _ in released(spark, rows)] == [150]


def test_a_long_chain_of_late_discovery(spark, monkeypatch):
    """Each virtual channel's own event decides on the next one's: one link a pass, however many."""
    n, rows = 60, []
    for i in range(n):
        # v_i is first seen by an event that is late exactly if v_{i-1} was not tracked before
        rows += [("Insert", f"v{i:02d}", 10 * i + 5), ("TimeTick", None, 10 * i + 10), ("Insert", f"v{i:02d}", 10 * i + 12)]
    rows.append(("TimeTick", None, 10_000))
    ticks, channel_tick, mark, late = {}, 0, 0, []
    for p, (kind, v, tso) in enumerate(rows):
        if kind == "TimeTick":
            channel_tick = max(channel_tick, tso)
            ticks = {k: max(t, tso) for k, t in ticks.items()}
            mark = max(mark, min(ticks.values(), default=channel_tick))
        elif mark > 0 and tso <= mark:
            late.append(p)
        else:
            ticks.setdefault(v, channel_tick)
    for walk in (O.WALK, 0):  # one by one, and by repetition
        monkeypatch.setattr(O, "WALK", walk)
        assert sorted(r.p for r in O.Ordered(log(spark, rows[: 3 * n if walk else 18])).events.where("late").collect()) == [p for p in late if p < (3 * n if walk else 18)]


def test_running_values(spark):
    d = spark.createDataFrame([("c", k, v) for k, v in ((0, None), (1, 3), (9, 2), (10, 5), (25, None), (31, 4))], "c string, k long, v long")
    got = asof.running(d, ["c"], "k", "v", "m", 10, "was").orderBy("k").collect()
    assert [(r.m, r.was) for r in got] == [(None, None), (3, None), (3, 3), (5, 3), (5, 5), (5, 5)]


def test_message_ids(spark):
    ids = [bytes.fromhex("3930000000000000"), b"67890", b"abc", b"", None, bytes.fromhex("ffffffffffffffff")]
    got = L.decode_checkpoint(spark.createDataFrame([(str(i), b, i) for i, b in enumerate(ids)], "pchannel string, msg_id binary, tso long")).orderBy("tso").collect()
    assert [r.offset for r in got] == [12345, 67890, None, None, None, -1]
    assert [r.error is None for r in got] == [True, True, False, False, False, True]


def test_effective_tso_and_shard(spark):
    d = spark.createDataFrame([(0, [777, 888]), (123, [999]), (0, []), (None, None)], "base long, ts array<long>")
    assert [r[0] for r in d.select(effective_tso(F.col("base"), F.col("ts"))).collect()] == [777, 123, 0, 0]
    assert spark.range(1).select(or_default(F.lit(""), F.lit("p"))).first()[0] == "p"


def test_single_message_pivots_in_order(spark):
    value = '{"base":{"msgType":"Insert","timestamp":123},"collectionName":"books","shardName":"books_v0","numRows":0,"fieldsData":[{"name":"id","vals":["1","2"]},{"name":"title","vals":["a",null]}]}'
    d = decode.decode_single(spark.createDataFrame([("t", 0, value.encode())], "topic string, offset long, value binary"))
    rows = pivot.pivot_rows(d).orderBy("row_pos").collect()
    assert [(r.row["id"], r.row["title"], r.tso, r.vchannel) for r in rows] == [("1", "a", 123, "books_v0"), ("2", None, 123, "books_v0")]


def test_unknown_types_by_policy(spark):
    d = spark.createDataFrame([("Insert",), ("Flush",), ("CreatePartition",)], "msg_type string")
    assert decode.route_messages(d).count() == 2 and decode.route_messages(d, "skip").count() == 1
    with pytest.raises(Exception, match="unknown message type Flush"):
        decode.route_messages(d, "error").collect()


def test_strict_quarantine_carries_coordinates(spark):
    bad = spark.createDataFrame([("t", 1, 42)], "topic string, partition int, offset long")
    with pytest.raises(Exception, match="expected x detected y at t 1 42 why"):
        decode.quarantine(bad, "x", F.lit("y"), F.lit("why"), strict=True).collect()


def test_slices_drop_what_is_left_over(spark):
    d = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0], 2), ([1.0], 2), ([1.0, 2.0], 0)], "v array<float>, dim int")
    assert [r[0] for r in d.select(W.slice_vectors(F.col("v"), F.col("dim"))).collect()] == [[[1, 2], [3, 4]], [], [[1, 2]]]
    assert W.vector_width("BinaryVector", 9) == 2 and W.vector_width("Float16Vector", 3) == 6


def test_packed_vectors(spark):
    import numpy as np

    x = np.array([1.5, -2.0, 0.25], "f4")
    sparse = np.array([(1, 0.5), (42, 1.0)], [("k", "<u4"), ("v", "<f4")]).tobytes() + b"\0\0"
    d = spark.createDataFrame([(x.tobytes(), x.astype("<f2").tobytes(), (x.view("<u4") >> 16).astype("<u2").tobytes(), sparse)], "a binary, b binary, c binary, s binary")
    r = d.select(W.unpack_f32("a").alias("a"), W.unpack_f16("b").alias("b"), W.unpack_bf16("c").alias("c"), W.sparse_to_json(W.unpack_sparse("s")).alias("s"), W.sparse_to_map(F.col("s")).alias("m")).first()
    assert r.a == r.b == r.c == [1.5, -2.0, 0.25] and r.s == '{"1":0.5,"42":1.0}' and r.m == {1: 0.5, 42: 1.0}


def test_packed_batches(spark):
    """Nulls, empty values and bytes left over keep their places in a batch."""
    import numpy as np

    f = lambda *x: np.array(x, "f4").tobytes()
    rows = [(0, f(1, 2), [1.0]), (1, None, None), (2, b"", []), (3, f(3) + b"abc", [2.0, 3.0]), (4, b"ab", None), (5, f(4, 5, 6), [4.5])]
    d = spark.createDataFrame(rows, "i int, b binary, v array<float>").coalesce(1)
    got = d.select("i", W.unpack_f32("b").alias("a"), V.pack_f32("v").alias("p")).orderBy("i").collect()
    assert [r.a for r in got] == [[1, 2], None, [], [3], [], [4, 5, 6]]
    assert [None if r.p is None else bytes(r.p) for r in got] == [None if v is None else f(*v) for _, _, v in rows]
    assert d.limit(0).select(W.unpack_f16("b").alias("a")).collect() == []


def test_avro_output(spark):
    """Avro where its package is present; without it the call fails at once, and JSON works."""
    d = spark.createDataFrame([("c", 1)], "op string, id long")
    assert envelope.serialize(d, ["op", "id"]).first().value == '{"op":"c","id":1}'
    try:
        got = envelope.serialize(d, ["op", "id"], "avro").first().value
    except Exception as e:
        assert "avro" in str(e).lower()
    else:
        assert bytes(got) == b"\x00\x02c\x00\x02"


def test_pages_of_text_and_sparse_keys(spark):
    d = spark.createDataFrame([(f"k{i * i % 977:03d}", i * 10**15) for i in range(300)], "t string, n long").distinct()
    for key in ("t", "n"):
        keys = sorted(r[0] for r in d.select(key).collect())
        got = snapshot.page(d.select(key).dropDuplicates(), key, 7, parts=9).collect()
        assert {r[key]: r.page for r in got} == {k: i // 7 for i, k in enumerate(sorted(set(keys)))}


def test_log_from_stored_offsets(spark, tmp_path):
    L.write_log(spark.createDataFrame([("t", i % 2, i, b"x") for i in range(10)] + [("u", 0, 1, b"y")], "topic string, partition int, offset long, value binary"), str(tmp_path / "log"))
    read = lambda start: sorted((r.topic, r.offset) for r in L.read_log(spark, str(tmp_path / "log"), start=start).collect())
    assert read('{"t": {"0": 6, "1": -1}}') == [("t", 6), ("t", 8), ("u", 1)]
    assert read("latest") == [] and len(read("earliest")) == 11


def test_message_table_function(spark):
    from vecflow.functions.udtf import register

    register(spark)
    texts = ['{"base":{"msgType":"Insert"},"fieldsData":[{"name":"a","vals":["1",null]},{"name":"b","vals":["x"]}]}', '{"base":{"msgType":"Delete"},"int64PrimaryKeys":[7,8]}', '{"base":{"msgType":"TimeTick"}}', "no json", "[]", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").createOrReplaceTempView("messages_of_test")
    got = spark.sql("SELECT i, m.* FROM messages_of_test, LATERAL explode_message(t) m ORDER BY i, row_pos").collect()
    assert [(r.i, r.row_pos, r.kind, r.key, r.row) for r in got] == [(0, 0, "Insert", None, '{"a": "1", "b": "x"}'), (0, 1, "Insert", None, '{"a": null, "b": null}'), (1, 0, "Delete", "7", None), (1, 1, "Delete", "8", None)]


def test_malformed_messages_of_the_table_function(spark):
    """None of them ends the query; the message that fits still gives its rows."""
    from vecflow.functions.udtf import register

    register(spark)
    texts = ['{"base":"x"}', '{"base":{"msgType":"Insert"},"numRows":"2","fieldsData":[{"name":"a","vals":["1"]}]}', '{"base":{"msgType":"Insert"},"numRows":2,"fieldsData":[1]}', '{"base":{"msgType":"Insert"},"fieldsData":{"a":1}}', '{"base":{"msgType":7}}', '{"base":{"msgType":"Delete"},"primaryKeys":[1]}',
             '{"base":{"msgType":"Delete"},"primaryKeys":{"ints":null,"strs":["é\\"",{"a":1},null]}}', '{"base":{"msgType":"Insert"},"numRows":2000000000,"fieldsData":[3,{"name":"a","vals":[1,{"b":"c"}]},{"vals":[true]}]}', '{"base":{"msgType":"Insert"},"numRows":-1,"fieldsData":[{"name":"a","vals":[1]}]}', ""]
    got = spark.sql("SELECT i, m.* FROM {t}, LATERAL explode_message(t) m ORDER BY i, row_pos", t=spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")).collect()
    assert [(r.i, r.row_pos, r.key, r.row) for r in got] == [(1, 0, None, '{"a": "1"}'), (6, 0, 'é"', None), (6, 1, '{"a":1}', None), (6, 2, None, None), (7, 0, None, '{"a": 1, null: true}'), (7, 1, None, '{"a": {"b":"c"}, null: null}')]


def test_batches_keep_what_fits(spark):
    texts = ['{"msgType":"x","pchannel":"p","messages":[1,{"msgType":"Insert","ts":5}]}', '{"messages":["a",null,{"ts":7}]}', '{"messages":[{"ts":"9"},{"timestamp":9223372036854775808},{"numRows":3000000000,"ts":1}]}', "{", "[1]", '{"pchannel":3,"messages":[{"ts":1}]}', '{"pchannel":"q"}', '{"messages":null}', None, '{"messages":[{"ts":3,"fieldsData":[{"name":"a","vals":[1.50,true,[1,2],null]},null]}]}']
    df = spark.createDataFrame([("t", 0, i, t) for i, t in enumerate(texts)], "topic string, partition int, offset long, value string")
    got = sorted(decode.decode_batch(df).collect(), key=lambda r: r.offset)
    assert [(r.offset, r.i, r.pchannel, r.tso, r.num_rows) for r in got] == [(0, 1, "p", 5, 0), (1, 2, "t", 7, 0), (9, 0, "t", 3, 4)]
    assert got[2].fields[0].vals == ["1.5", "true", "[1,2]", None] and len(got[2].fields) == 1
    bad = sorted(((r.offset, r.element, r.detected, r.detail) for r in decode.batch_quarantine(df).collect()), key=repr)
    assert [x[:3] for x in bad] == [(2, 0, "ts: STRING"), (2, 1, "timestamp: DECIMAL"), (2, 2, "numRows: BIGINT"), (3, None, "malformed JSON"), (4, None, "message: ARRAY"), (5, None, "pchannel: BIGINT"), (8, None, "malformed JSON")]
    assert bad[0][3] == '{"ts":"9"}' and bad[3][3] == "{"
    with pytest.raises(Exception, match="expected a batch of typed message maps detected"):
        decode.batch_quarantine(df, strict=True).collect()


def test_sparse_entries_of_odd_values(spark):
    e = np.array([(2**32 - 1, -2.0), (0, float("inf"))], [("k", "<u4"), ("v", "<f4")]).tobytes()
    d = spark.createDataFrame([(0, e), (1, None), (2, b""), (3, b"1234567"), (4, e[:8] + b"x")], "i int, s binary").coalesce(1)
    got = {r.i: r.m and [(x.k, x.v) for x in r.m] for r in d.select("i", W.unpack_sparse("s").alias("m")).collect()}
    assert got == {0: [(2**32 - 1, -2.0), (0, float("inf"))], 1: None, 2: [], 3: [], 4: [(2**32 - 1, -2.0)]}


def test_counters_of_the_job_that_writes(spark, tmp_path):
    """One job: the counters are there when the rows are."""
    o = O.Ordered(log(spark, [("Insert", "v", 5), ("TimeTick", "v", 9), ("Insert", "v", 4), ("Delete", "v", 12)]))
    df, seen = metrics.observed(o.events, metrics.event_counters())
    df.write.parquet(str(tmp_path / "events"))
    assert seen.get == {"events": 3, "late": 1, "deletes": 1, "first": 0, "last": 3}


def test_handoff_resumes_behind_the_checkpoint(spark):
    stream = spark.createDataFrame([("a", 1, "Insert", 5), ("a", 2, "Insert", 6), ("a", 3, "Delete", 7), ("b", 1, "Insert", 8)], "pchannel string, p long, kind string, tso long")
    ck = spark.createDataFrame([("a", 2, 100)], "pchannel string, offset long, tso long")
    snap = spark.createDataFrame([(1,)], "id long")
    say = lambda d: sorted((r.phase, r.op, r.p or 0, r.tso) for r in d.collect())
    assert say(changes.handoff(snap, stream, ck)) == [(0, "r", 0, 100), (1, "c", 1, 8), (1, "d", 3, 7)]
    assert len(say(changes.handoff(snap, stream, ck, inclusive=True))) == 4
    assert len(say(changes.handoff(snap, stream, ck.limit(0)))) == 5


def test_narrowing_wraps(spark):
    d = spark.createDataFrame([(40000,), (-32769,), (2**40 + 7,), (None,)], "x long")
    assert [r[0] for r in d.select(V.to_short(F.col("x"))).collect()] == [-25536, 32767, 7, None]
    assert [r[0] for r in d.select(V.to_int(F.col("x") * 65536)).collect()] == [-1673527296, 2147418112, 458752, None]


def test_columns_of_a_collection(spark):
    s = Y.collection_struct([{"name": "id", "type": "Int64", "primary": True}, {"name": "v", "type": "FloatVector", "dim": 4}, {"name": "p", "type": "Float"}], "precise")
    assert not s["id"].nullable and s["v"].metadata == {"logical": "float_vector", "dim": 4} and s["p"].dataType.simpleString() == "decimal(38,7)"


def test_envelope_of_a_delete(spark):
    r = envelope.envelope(spark.createDataFrame([("Delete", 1, "x")], "kind string, id long, name string"), "id", ["id", "name"]).first()
    assert (r.op, r.before.id, r.before.name, r.after) == ("d", 1, None, None)


def test_alignment_by_name(spark):
    d = pivot.align(spark.createDataFrame([(1, 2)], "b long, extra long"), StructType.fromDDL("a string, b int"))
    assert d.columns == ["a", "b"] and tuple(d.first()) == (None, 1)


def test_key_resolution(spark):
    rows = [("a", 0, "vec", "FloatVector", None), ("a", 1, "user_id", "VarChar", None), ("b", 0, "x", "Bool", "x"), ("c", 0, "f", "Float", None), ("c", 1, "n", "Int64", None), ("d", 0, "only", "Bool", "gone")]
    got = schema.resolve_pk(spark.createDataFrame(rows, "collection string, pos int, name string, type string, metadata_pk string")).collect()
    assert {r.collection: r.pk for r in got} == {"a": "user_id", "b": "x", "c": "n", "d": "only"}


def test_asof_in_both_directions(spark):
    left = spark.createDataFrame([("c", k) for k in (0, 5, 10, 11, 5000, 99999)], "c string, k long")
    right = spark.createDataFrame([("c", p, p * 10) for p in (5, 10, 7000)], "c string, p long, v long")
    back = asof.asof(left, right, ["c"], "k", "p", "v", width=8).orderBy("k").collect()
    assert [r.v for r in back] == [None, None, 50, 100, 100, 70000]
    ahead = asof.asof(left, right, ["c"], "k", "p", "v", forward=True, strict=False, width=8).orderBy("k").collect()
    assert [r.v for r in ahead] == [50, 50, 100, 70000, 70000, None]


def test_pages_of_a_thousand_by_default(spark):
    d = snapshot.page(spark.range(2500).toDF("k"), "k", -1, width=300)
    assert {r.page: r["count"] for r in d.groupBy("page").count().collect()} == {0: 1000, 1: 1000, 2: 500}


def test_starting_offsets_json(spark):
    d = spark.createDataFrame([("t", 0, 5), ("t", 1, None)], "topic string, partition int, start long")
    assert L.starting_offsets(d) == '{"t": {"0": 5, "1": -1}}'


def test_file_log_has_the_message_columns(spark, tmp_path):
    spark.createDataFrame([("t", 0, 1, None, b"x", None)], L.MESSAGE).write.parquet(str(tmp_path / "log"))
    assert L.read_log(spark, str(tmp_path / "log")).first().value == b"x"
    assert L.read_log(spark, str(tmp_path / "log"), streaming=True).isStreaming


def test_routed_files(spark, tmp_path):
    d = envelope.route(spark.createDataFrame([("a", 1), ("b", 2)], "collection string, id long"), "cdc")
    envelope.write_changes(d, "json", str(tmp_path / "out")).save()
    assert sorted(p.name for p in (tmp_path / "out").glob("topic=*")) == ["topic=cdc.default.a", "topic=cdc.default.b"]


def test_entry_imports_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; print(len(e.queries()) > 100, len(e.oracle_sql()) > 100)"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr
