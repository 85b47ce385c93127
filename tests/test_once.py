"""A log is gone through once, a message decoded once, and few change points are sent to the log."""

import bisect
import json
import random

import pytest
from pyspark.sql import functions as F

from vecflow.operators import asof, decode, pivot
from vecflow.operators import ordering as O


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def message(kind, tso, **more):
    return ("t", tso, json.dumps({"base": {"msgType": kind, "timestamp": tso}, "collectionName": "c", "shardName": "v", **more}).encode())


def test_filters_do_not_decode_a_message_again(spark):
    rows = [message(k, i + 1) for i, k in enumerate(["Insert", "Delete", "TimeTick", "CreatePartition", "Other"])] + [("t", 6, None), ("t", 7, b"{")]
    d = decode.decode_single(spark.createDataFrame(rows, "topic string, offset long, value binary"))
    kept = d.where("kind <> 'TimeTick'").where("tso >= 2 or tso = 0").where("vchannel is not null")
    assert plan(kept).count("from_json(") == 1
    assert sorted((r.offset, r.kind, r.tso, r.vchannel) for r in kept.collect()) == [(2, "Delete", 2, "v"), (5, "unknown", 5, "v"), (6, "unknown", 0, "t"), (7, "unknown", 0, "t")]


def test_places_in_sorted_points(spark):
    for n in (0, 1, 2, 3, 4, 7, 8, 9, 31, 32, 33, 100):
        points = [2 * i for i in range(n)]
        d = spark.createDataFrame([(points, k) for k in range(-1, 2 * n + 2)] + [(points, None), (None, 3)], "a array<bigint>, k bigint")
        a = F.transform("a", lambda x: F.struct(x.alias("k")))
        got = d.select("a", "k", asof._up_to(a, F.col("k"), True).alias("e"), asof._up_to(a, F.col("k"), False).alias("s")).collect()
        at = lambda f, r: 0 if r.a is None or r.k is None else f(r.a, r.k)
        assert all((r.e, r.s) == (at(bisect.bisect_right, r), at(bisect.bisect_left, r)) for r in got)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_few_points_are_sent(spark, forward, strict):
    rng = random.Random(7)
    left = spark.createDataFrame([(i, c, rng.randint(0, 120)) for i in range(300) for c in "abc"] + [(-1, "a", None), (-2, None, 5)], "i long, c string, k long")
    right = spark.createDataFrame([(c, p, rng.randint(0, 9)) for c in "ab" for p in rng.sample(range(120), 20)], "c string, p long, v long")
    sent = asof.asof(left, right, ["c"], "k", "p", "v", forward=forward, strict=strict, width=8, points=40)
    met = asof.asof(left, right, ["c"], "k", "p", "v", forward=forward, strict=strict, width=8)
    assert sent.columns == met.columns and plan(sent).count("LogicalRDD") == 2
    assert sorted(map(str, sent.collect())) == sorted(map(str, met.collect()))


def drawn(seed):
    rng, rows = random.Random(seed), []
    for p in range(400):
        kind = "TimeTick" if p % 40 == 39 else rng.choice(["Insert", "Delete"])
        rows.append((p, kind, rng.choice("ab"), rng.choice(["v0", "v1"]) if kind != "TimeTick" or p % 3 else None, max(1, p * 10 + rng.randint(-400, 100)), "x" * p))
    return rows


def test_payload_is_gone_through_once(spark, monkeypatch):
    """What events are numbered by comes from the index; the same numbers where change points are met in buckets."""
    monkeypatch.setattr(O, "PART", 50)
    log = spark.createDataFrame(drawn(3), "p long, kind string, pchannel string, vchannel string, tso long, body string")
    got = O.ordered_changes(log)
    leaves = got._jdf.queryExecution().optimizedPlan().collectLeaves()
    names = [leaves.apply(i).nodeName() for i in range(leaves.size())]
    # the log, and the index (kept in storage); the few change points besides
    assert names.count("InMemoryRelation") == 1 and sum("body" in leaves.apply(i).output().mkString() for i in range(len(names))) == 1
    columns = ["pchannel", "seq", "p", "release_p", "body"]
    rows = sorted(map(tuple, got.select(columns).collect()))
    monkeypatch.setattr(O, "FEW", -1)
    monkeypatch.setattr(asof, "FEW", -1)
    assert len(rows) > 100 and rows == sorted(map(tuple, O.ordered_changes(log).select(columns).collect()))


def test_rows_and_keys_in_one_pass(spark):
    rows = [
        message("Insert", 1, numRows=0, fieldsData=[{"name": "id", "vals": ["1", "2"]}, {"name": "n", "vals": ["a", None]}]), message("Insert", 2, numRows=3, fieldsData=[{"name": "id", "vals": ["3"]}]),
        message("Insert", 3, numRows=0, fieldsData=[]), message("Insert", 4, primaryKeys={"ints": [9]}), message("Delete", 5, primaryKeys={"ints": [7, 8]}), message("Delete", 6, primaryKeys={"strs": []}), message("Delete", 7),
        message("Delete", 8, int64PrimaryKeys=[4], fieldsData=[{"name": "id", "vals": ["5"]}]), message("TimeTick", 9), message("CreateCollection", 10, fieldsData=[{"name": "id", "vals": ["6"]}]),
    ]
    d = decode.decode_single(spark.createDataFrame(rows, "topic string, offset long, value binary"))
    made = pivot.take_apart(d)
    apart = [(r.offset, r.row_pos, r.row, None) for r in pivot.pivot_rows(d.where("kind = 'Insert'")).collect()]
    apart += [(r.offset, r.key_pos, None, r.key) for r in decode.explode_deletes(d.where("kind = 'Delete'")).collect()]
    assert sorted(((r.offset, r.row_pos, r.row, r.key) for r in made.collect()), key=str) == sorted(apart, key=str) and len(apart) == 8
    assert plan(made).count("from_json(") == 1
