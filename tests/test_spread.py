"""Tasks of the orderer hold bounded parts of a log, wherever its rows lie."""

from pyspark.sql import functions as F

from vecflow.operators import asof
from vecflow.operators import ordering as O
from vecflow.operators.schema import drift_from_first, first_schema, schema_drift

LOG = "p long, kind string, pchannel string, vchannel string, tso long"


def test_numbering_is_spread_over_close_and_equal_tso(spark, monkeypatch):
    """All tso within a minute, and half of the rows of one tso: many ranges, the same numbers."""
    monkeypatch.setattr(O, "PART", 100)
    monkeypatch.setattr(asof, "DEALT", 100)
    rows = [(p, "Delete" if p % 3 else "Insert", "c", "v", 500 if p % 2 else p * 7919 % 1000) for p in range(2000)]
    d = spark.createDataFrame(rows, LOG)
    order = [F.col("tso"), O.op_rank(F.col("kind")), F.col("p")]
    sizes = [r["count"] for r in d.groupBy(O.Spread(d).range(order)).count().collect()]
    assert len(sizes) == 21 and max(sizes) < 200
    got = [r.p for r in O.in_order(d).orderBy("seq").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[4], r[1] != "Delete", r[0]))]


def test_grid_of_ticks_is_dealt_by_its_rows(spark, monkeypatch):
    ticks = spark.createDataFrame([("c", p, None if p % 3 else f"v{p % 2}", p * 10) for p in range(400)], "pchannel string, p long, vchannel string, tso long")
    seen = spark.createDataFrame([("c", "v0", 0, False), ("c", "v1", 3, False)], "pchannel string, vchannel string, p0 long, by_event boolean")
    whole = sorted(map(tuple, O.tick_grid(ticks, seen).collect()))
    monkeypatch.setattr(asof, "DEALT", 50)
    monkeypatch.setattr(O, "RANGE", 16)
    dealt = O.tick_grid(ticks, seen)
    assert "__r#" in (plan := dealt._jdf.queryExecution().optimizedPlan().toString()) and "], 16" in plan
    assert sorted(map(tuple, dealt.collect())) == whole


def test_drift_from_first_goes_through_the_changes_once(spark):
    sets = [["id", "a"], ["id", "a", "b"], ["id"], [], None]
    changes = spark.createDataFrame([("Insert" if i % 7 else "Delete", f"c{i % 4}", sets[i * i % 5], (i * 37) % 101) for i in range(100)], "kind string, collection string, fields array<string>, seq long")
    got, want = drift_from_first(changes), schema_drift(changes, first_schema(changes))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count()
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
