"""First schemas and drift in a stream against the batch operators."""

import random
from collections import Counter

from pyspark.sql import functions as F

from vecflow.operators.schema import first_schema, schema_drift
from vecflow.streaming import schemas

SCHEMA = "collection string, fields array<string>, seq long"


def test_stream_is_the_batch(spark, tmp_path):
    rng = random.Random(2)
    sets = [["id", "a"], ["id", "a", "b"], ["id"], ["b", "id"], []]
    rows = [(rng.choice(["hot"] * 5 + ["c1", "c2", "c3"]), rng.choice(sets), seq) for seq in range(300)]

    def go():
        src = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
        q = schemas.schema_stream(src).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()

    for part in (rows[:120], rows[120:130], rows[130:]):  # a new query each time, on the old checkpoint
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").json(str(tmp_path / "in"))
        go()
    first, drift = schemas.split_schemas(spark.read.schema(schemas.OUTPUT).parquet(str(tmp_path / "out")))
    changes = spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.lit("Insert"))
    want = first_schema(changes)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, want.collect()))
    added = Counter()
    for r in drift.collect():
        added[r.collection, tuple(r.extra), tuple(r.missing)] += r.n
    assert added == {(r.collection, tuple(r.extra), tuple(r.missing)): r.n for r in schema_drift(changes, want).collect()}
