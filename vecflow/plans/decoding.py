"""Queries of sources, decoding, pivots and vectors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from vecflow import fixtures
from vecflow.functions import tso as T
from vecflow.functions import vectors as V
from vecflow.operators import decode as D
from vecflow.operators import envelope as E
from vecflow.operators import ordering as O
from vecflow.operators import pivot as P
from vecflow.plans.registry import query
from vecflow.plans.sql import on
from vecflow.sources import catalogue as C
from vecflow.sources import log as L

_t = fixtures.table

# messages: inserts of the batches, deletes, ticks and other types of the events


def _base(kind, at):
    return F.struct(kind.alias("msgType"), at.alias("timestamp"))


def insert_messages(spark, sf_dir):
    """Batches as single messages; every third states no row count, every fifth no base timestamp, every fourth no shard."""
    b = fixtures.batches(spark, sf_dir)
    m = F.col("msg_id")
    payload = F.struct(
        _base(F.lit("Insert"), F.when(m % 5 == 0, 0).otherwise(m * 1000)).alias("base"), F.lit("orders").alias("collectionName"),
        F.when(m % 4 == 0, "").otherwise("dml_0_v1").alias("shardName"), F.array(m * 1000 + 7).alias("timestamps"),
        F.when(m % 3 == 0, 0).otherwise(F.col("num_rows")).alias("numRows"), F.col("fields").alias("fieldsData"),
    )
    return b.select(F.lit("dml_0").alias("topic"), (m * 4).alias("offset"), F.encode(F.to_json(payload), "UTF-8").alias("value"))


def delete_messages(spark, sf_dir):
    d = fixtures.deletes(spark, sf_dir)
    keys = F.when(F.col("int_keys").isNotNull() | F.col("str_keys").isNotNull(), F.struct(F.col("int_keys").alias("ints"), F.col("str_keys").alias("strs")))
    payload = F.struct(_base(F.lit("Delete"), F.col("msg_id")).alias("base"), F.lit("lineitem").alias("collectionName"), F.lit("dml_0_v0").alias("shardName"), keys.alias("primaryKeys"), F.col("legacy_keys").alias("int64PrimaryKeys"))
    return d.select(F.lit("dml_0").alias("topic"), (F.col("msg_id") * 4 + 1).alias("offset"), F.encode(F.to_json(payload), "UTF-8").alias("value"))


@query("log_scan", "SELECT 'dml_' || (user_id % 3) AS topic, 0 AS \"partition\", event_id AS \"offset\", event_type AS value FROM events WHERE event_id >= 100")
def log_scan(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.concat(F.lit("dml_"), (F.col("user_id") % 3).cast("string")).alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.encode("event_type", "UTF-8").alias("value"))
    path = L.shared_folder(spark, "log")
    L.write_log(e, path)
    plan = e.select("topic", "partition").distinct().withColumn("start", F.lit(100))
    return L.read_log(spark, path, start=L.starting_offsets(plan)).select("topic", "partition", "offset", F.decode("value", "UTF-8").alias("value"))


def tick_messages(spark):
    """One tick above everything for each virtual channel of the messages."""
    ticks = spark.range(3).select((F.col("id") + 2**40).alias("offset"), F.element_at(F.array(F.lit("dml_0"), F.lit("dml_0_v0"), F.lit("dml_0_v1")), (F.col("id") + 1).cast("int")).alias("shard"))
    payload = F.struct(_base(F.lit("TimeTick"), F.lit(2**60)).alias("base"), F.col("shard").alias("shardName"))
    return ticks.select(F.lit("dml_0").alias("topic"), "offset", F.encode(F.to_json(payload), "UTF-8").alias("value"))


@query("log_to_changes", """WITH m AS (
  SELECT (o_orderkey // 16) * 4 AS p, 'c' AS op, 1 AS r, (o_orderkey // 16) * 1000 + CASE WHEN (o_orderkey // 16) % 5 = 0 THEN 7 ELSE 0 END AS tso, CAST(o_orderkey AS VARCHAR) AS id,
         row_number() OVER (PARTITION BY o_orderkey // 16 ORDER BY o_orderkey) - 1 AS row_pos FROM orders
  UNION ALL SELECT l_orderkey * 4 + 1, 'd', 0, l_orderkey, CAST(l_linenumber AS VARCHAR), row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 FROM lineitem WHERE l_returnflag = 'R'
) SELECT 'cdc.default.' || CASE op WHEN 'c' THEN 'orders' ELSE 'lineitem' END AS topic, op, dense_rank() OVER (ORDER BY tso, r, p) AS seq, row_pos, id, tso FROM m""")
def log_to_changes(spark, sf_dir):
    """Messages in files, read as a log, decoded, put in order, taken apart into rows, enveloped and routed."""
    path = L.shared_folder(spark, "log")
    messages = insert_messages(spark, sf_dir).unionByName(delete_messages(spark, sf_dir)).unionByName(tick_messages(spark))
    # short and long messages are mixed, as tasks are dealt files by their bytes
    L.write_log(messages.repartition("topic", "offset"), path)
    log = D.decode_single(L.read_log(spark, path)).withColumnRenamed("offset", "p")
    rows = P.take_apart(O.ordered_changes(log)).withColumn("id", F.coalesce(F.col("row")["o_orderkey"], "key")).drop("row", "key")
    changes = E.envelope(rows, "id", ["id"])
    return E.route(changes, "cdc").select("topic", "op", "seq", F.col("row_pos").cast("long").alias("row_pos"), F.coalesce("after.id", "before.id").alias("id"), "tso")


@query("router_hook", on(fixtures.LOG) + " SELECT p, CASE WHEN kind = 'Delete' THEN 'gone' ELSE 'live.' || event_type END AS topic FROM log WHERE kind <> 'TimeTick'")
def router_hook(spark, sf_dir):
    d = fixtures.log(spark, sf_dir).where("kind <> 'TimeTick'")
    own = lambda df: df.withColumn("topic", F.when(F.col("kind") == "Delete", "gone").otherwise(F.concat(F.lit("live."), "event_type")))
    return E.route(d, "cdc", router=own).select("p", "topic")


@query("converter_override", "SELECT o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus AS status FROM orders")
def converter_override(spark, sf_dir):
    from vecflow.functions.convert import converted

    rows = P.pivot_rows(fixtures.batches(spark, sf_dir))
    own = {"Double": lambda c: F.round(c.cast("double") * 100).cast("bigint")}
    c = converted(F.col("row"), {"o_orderkey": "Int64", "o_totalprice": "Double", "o_orderstatus": "VarChar"}, own)
    return rows.select(c["o_orderkey"].alias("id"), c["o_totalprice"].alias("cents"), c["o_orderstatus"].alias("status"))


@query("explode_message_udtf", """SELECT (o_orderkey // 16) * 4 AS "offset", row_number() OVER (PARTITION BY o_orderkey // 16 ORDER BY o_orderkey) - 1 AS row_pos, 'Insert' AS kind, o_orderstatus AS val FROM orders
 UNION ALL SELECT l_orderkey * 4 + 1, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1, 'Delete', CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R'""")
def explode_message_udtf(spark, sf_dir):
    from vecflow.functions.udtf import register

    register(spark)
    messages = insert_messages(spark, sf_dir).unionByName(delete_messages(spark, sf_dir))
    return spark.sql("SELECT offset, CAST(row_pos AS BIGINT) AS row_pos, kind, CASE kind WHEN 'Insert' THEN get_json_object(row, '$.o_orderstatus') ELSE key END AS val FROM {messages}, LATERAL explode_message(CAST(value AS STRING))", messages=messages)


@query("unpack_half_vectors", "SELECT vec_id, CAST(label AS FLOAT) AS f16, CAST(-label - 1 AS FLOAT) AS bf16, 2 * label AS k, CAST(0.5 AS FLOAT) AS v FROM embeddings")
def unpack_half_vectors(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").select("vec_id", "label", *(pack_halves("label", F.lit(kind)).alias(kind) for kind in ("f16", "bf16")), pack_sparse("label").alias("s"))
    d = e.select("vec_id", "label", F.element_at(V.unpack_f16("f16"), -1).alias("f16"), F.element_at(V.unpack_bf16("bf16"), -1).alias("bf16"), V.sparse_to_map(F.col("s")).alias("m"))
    return d.select("vec_id", "f16", "bf16", F.element_at(F.map_keys("m"), 1).cast("int").alias("k"), F.element_at(F.map_values("m"), 1).alias("v"))


_POS = fixtures.LOG_MULTI + """,
pr AS (SELECT pchannel, max(p) AS stored FROM log_multi WHERE pchannel <> 'dml_2' GROUP BY 1),
ck AS (SELECT pchannel, min(p) AS "offset" FROM log_multi WHERE pchannel <> 'dml_0' GROUP BY 1),
ch AS (SELECT DISTINCT pchannel FROM log_multi)"""


def _positions(spark, sf_dir):
    d = fixtures.log_multi(spark, sf_dir)
    return d.select("pchannel").distinct(), d.where("pchannel <> 'dml_2'").groupBy("pchannel").agg(F.max("p").alias("stored")), d.where("pchannel <> 'dml_0'").groupBy("pchannel").agg(F.min("p").alias("offset"))


@query("start_position", on(_POS) + """ SELECT m AS mode, ch.pchannel,
 CASE m WHEN 'EARLIEST' THEN 0 WHEN 'STORED_OFFSET_PLUS_ONE' THEN stored + 1 WHEN 'DEFAULT' THEN "offset" END AS start,
 (m = 'STORED_OFFSET_PLUS_ONE' AND stored IS NULL) OR (m = 'DEFAULT' AND "offset" IS NULL) AS missing
 FROM ch LEFT JOIN pr USING (pchannel) LEFT JOIN ck USING (pchannel), (VALUES ('EARLIEST'), ('LATEST'), ('STORED_OFFSET_PLUS_ONE'), ('DEFAULT')) v(m)""")
def start_position(spark, sf_dir):
    ch, pr, ck = _positions(spark, sf_dir)
    out = None
    for mode in ("EARLIEST", "LATEST", "STORED_OFFSET_PLUS_ONE", "DEFAULT"):
        d = L.start_offsets(ch, pr, ck, mode).select(F.lit(mode).alias("mode"), "pchannel", "start", "missing")
        out = d if out is None else out.unionByName(d)
    return out


@query("resume_plan", on(_POS) + """ SELECT pchannel, CASE WHEN stored IS NOT NULL THEN 'stored' WHEN pchannel <> 'dml_1' AND "offset" IS NOT NULL THEN 'checkpoint' ELSE 'latest' END AS mode,
 CASE WHEN stored IS NOT NULL THEN stored + 1 WHEN pchannel <> 'dml_1' AND "offset" IS NOT NULL THEN "offset" END AS start FROM ch LEFT JOIN pr USING (pchannel) LEFT JOIN ck USING (pchannel)""")
def resume_plan(spark, sf_dir):
    ch, pr, ck = _positions(spark, sf_dir)
    return L.resume_plan(ch.withColumn("snapshot_completed", F.col("pchannel") == "dml_1"), pr, ck)


@query("checkpoint_decode", on(fixtures.CHECKPOINTS) + " SELECT pchannel, CASE WHEN NOT bad THEN off END AS \"offset\", tso, bad AS undecodable FROM checkpoints")
def checkpoint_decode(spark, sf_dir):
    return L.decode_checkpoint(fixtures.checkpoints(spark, sf_dir)).select("pchannel", "offset", "tso", F.col("error").isNotNull().alias("undecodable"))


@query("checkpoint_key", "SELECT c_name AS pchannel, CASE c_custkey % 3 WHEN 0 THEN 'by-dev/meta/checkpoint/' || c_name WHEN 1 THEN 'own/' || c_name || '/cp' END AS key FROM customer")
def checkpoint_key(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    override = F.when(F.col("c_custkey") % 3 == 1, "own/%s/cp").when(F.col("c_custkey") % 3 == 2, "own/no-placeholder")
    return c.select(F.col("c_name").alias("pchannel"), L.checkpoint_key(F.lit("by-dev/meta/"), override, F.col("c_name")).alias("key"))


@query("collections_list", """SELECT c_nationkey AS region, pos, c_name AS name, CASE WHEN pos < 3 THEN c_custkey ELSE 0 END AS id, CASE WHEN pos < 2 THEN c_custkey * 1000 ELSE 0 END AS created
 FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer)""")
def collections_list(spark, sf_dir):
    n = _t(spark, sf_dir, "customer").withColumn("c_custkey", F.col("c_custkey").cast("long"))
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name")))
    g = n.groupBy(F.col("c_nationkey").alias("region")).agg(rows.alias("r"))
    g = g.select("region", F.transform("r", lambda x: x["c_name"]).alias("names"), F.transform(F.slice("r", 1, 3), lambda x: x["c_custkey"]).alias("ids"), F.transform(F.slice("r", 1, 2), lambda x: x["c_custkey"] * 1000).alias("created"))
    return C.collections(g, ["region"])


@query("collection_schema", "SELECT CAST(c_nationkey AS VARCHAR) AS collection, CASE WHEN c_nationkey % 2 = 0 THEN 'default' ELSE 'db1' END AS db, count(*) AS n_fields, arg_max(c_name, c_custkey) FILTER (c_custkey % 3 = 0) AS pk FROM customer GROUP BY c_nationkey")
def collection_schema(spark, sf_dir):
    n = _t(spark, sf_dir, "customer")
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", F.col("c_name").alias("name"), (F.col("c_custkey") % 3 == 0).alias("is_primary"))))
    g = n.groupBy("c_nationkey").agg(rows.alias("fields"))
    return C.collection_schema(g.select(F.col("c_nationkey").cast("string").alias("collection"), F.when(F.col("c_nationkey") % 2 == 0, " ").otherwise("db1").alias("db"), "fields"))


@query("field_dimension", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 3 THEN p_size ELSE 0 END AS dim FROM part")
def field_dimension(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    kv = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    params = F.when(k == 0, F.array(kv("dim", size))).when(k == 1, F.array(kv("max_length", size))).when(k == 2, F.array(kv("dim", F.lit("x")), kv("dim", size))).otherwise(F.array(kv("dim", size), kv("dim", F.lit(7))))
    return p.select("p_partkey", C.field_dimension(params).alias("dim"))


@query("channel_map", """SELECT c_nationkey AS nation, pos, c_name AS vchannel, CASE WHEN c_nationkey % 5 > 0 THEN 'p' || least(pos, c_nationkey % 5 - 1) END AS pchannel
 FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer)""")
def channel_map(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda x: x["c_name"]).alias("virtual"))
    physical = F.slice(F.array(*(F.lit(f"p{i}") for i in range(5))), 1, F.col("nation") % 5)
    return C.channel_map(c.withColumn("physical", physical), ["nation"])


@query("find_collection", "SELECT c_custkey AS id, c_name AS name, list_contains((SELECT list(c_mktsegment) FROM customer), 'default') AS database_exists FROM customer WHERE c_name = (SELECT max(c_name) FROM customer) LIMIT 1")
def find_collection(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    known = c.agg(F.max("name").alias("wanted"), F.collect_set("c_mktsegment").alias("dbs"))  # one row: segments are few
    found = C.find_collection(c.crossJoin(F.broadcast(known)), F.col("wanted"))
    return found.select("id", "name", C.database_exists(F.col("dbs"), "default").alias("database_exists"))


_TYPES = ["Insert", "Delete", "CreateCollection", "DropCollection", "TimeTick", "CreatePartition", "DropPartition", "Flush"]


@query("route_messages", "SELECT event_id, t AS msg_type, CASE WHEN t IN ('CreateCollection', 'DropCollection') THEN 'DDL' WHEN t = 'Flush' THEN 'unknown' ELSE t END AS kind FROM (SELECT event_id, (" + repr(_TYPES) + ")[event_id % 8 + 1] AS t FROM events) WHERE t NOT IN ('CreatePartition', 'DropPartition')")
def route_messages(spark, sf_dir):
    kinds = F.array(*map(F.lit, _TYPES))
    e = _t(spark, sf_dir, "events").select("event_id", F.element_at(kinds, (F.col("event_id") % 8 + 1).cast("int")).alias("msg_type"))
    return D.route_messages(e).select("event_id", "msg_type", "kind")


_SINGLE = on(fixtures.BATCHES, fixtures.DELETES) + """
, ins AS (SELECT msg_id * 4 AS "offset", 'Insert' AS kind, 'orders' AS collection, CASE WHEN msg_id % 4 = 0 THEN 'dml_0' ELSE 'dml_0_v1' END AS vchannel,
 CASE WHEN msg_id % 5 = 0 THEN msg_id * 1000 + 7 ELSE msg_id * 1000 END AS tso, num_rows, CAST(NULL AS BIGINT) AS n_keys FROM batches),
del AS (SELECT msg_id * 4 + 1 AS "offset", 'Delete' AS kind, 'lineitem' AS collection, 'dml_0_v0' AS vchannel, msg_id AS tso, 0 AS num_rows, coalesce(len(int_keys), len(legacy_keys), len(str_keys)) AS n_keys FROM deletes)
"""


@query("decode_single", _SINGLE + " SELECT * FROM ins UNION ALL SELECT * FROM del")
def decode_single(spark, sf_dir):
    d = D.decode_single(insert_messages(spark, sf_dir).unionByName(delete_messages(spark, sf_dir)))
    return d.select("offset", "kind", "collection", "vchannel", "tso", F.col("num_rows").cast("long").alias("num_rows"), F.when(F.col("keys").isNotNull(), F.size("keys")).cast("long").alias("n_keys"))


@query("effective_tso", _SINGLE + ' SELECT "offset", tso FROM ins')
def effective_tso(spark, sf_dir):
    return D.decode_single(insert_messages(spark, sf_dir)).select("offset", "tso")


@query("vchannel_default", _SINGLE + ' SELECT "offset", vchannel FROM ins')
def vchannel_default(spark, sf_dir):
    return D.decode_single(insert_messages(spark, sf_dir)).select("offset", "vchannel")


@query("infer_num_rows", _SINGLE + ' SELECT "offset", num_rows FROM ins')
def infer_num_rows(spark, sf_dir):
    return D.decode_single(insert_messages(spark, sf_dir)).select("offset", "num_rows")


def batch_messages(spark, sf_dir):
    """Four batches and one delete as one batch message; defaults are needed here and there."""
    b = fixtures.batches(spark, sf_dir).withColumn("g", F.expr("msg_id div 4"))
    m = F.col("msg_id")
    null = F.lit(None)
    inner = F.struct(
        F.when(m % 9 != 0, "Insert").alias("msgType"), F.lit("orders").alias("collectionName"), F.when(m % 3 != 0, "dml_0_v1").otherwise(" ").alias("vchannel"),
        F.when(m % 2 == 0, m * 10).alias("ts"), F.when(m % 4 != 3, m * 10 + 1).alias("timestamp"), F.col("num_rows").alias("numRows"), F.col("fields").alias("fieldsData"), null.cast("array<string>").alias("primaryKeys"),
    )
    g = b.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("msg_id", inner.alias("m")))).alias("x")).select("g", F.transform("x", lambda y: y["m"]).alias("x"))
    gone = F.struct(F.lit("Delete").alias("msgType"), F.lit("orders").alias("collectionName"), F.lit("dml_0_v0").alias("vchannel"), F.col("g").alias("ts"), null.cast("bigint").alias("timestamp"), null.cast("int").alias("numRows"), null.cast(f"array<{D.FIELD}>").alias("fieldsData"), F.array(F.col("g").cast("string"), F.lit("k")).alias("primaryKeys"))
    skip = F.struct(F.lit("CreatePartition").alias("msgType"), *(null.cast(t).alias(n) for n, t in (("collectionName", "string"), ("vchannel", "string"), ("ts", "bigint"), ("timestamp", "bigint"), ("numRows", "int"), ("fieldsData", f"array<{D.FIELD}>"), ("primaryKeys", "array<string>"))))
    kind = f"array<{D.INNER}>"
    all_ = F.concat(F.from_json(F.to_json("x"), kind), F.from_json(F.to_json(F.array(gone, skip)), kind))
    payload = F.struct(F.lit("Insert").alias("msgType"), F.when(F.col("g") % 2 == 0, "dml_9").alias("pchannel"), all_.alias("messages"))
    return g.select(F.lit("dml_0").alias("topic"), F.col("g").alias("offset"), F.encode(F.to_json(payload), "UTF-8").alias("value"))


_BATCH = on(fixtures.BATCHES) + """
, bm AS (
  SELECT msg_id // 4 AS "offset", row_number() OVER (PARTITION BY msg_id // 4 ORDER BY msg_id) - 1 AS i, CASE WHEN msg_id % 9 <> 0 THEN 'Insert' ELSE 'TimeTick' END AS kind,
         CASE WHEN msg_id // 4 % 2 = 0 THEN 'dml_9' ELSE 'dml_0' END AS pchannel, CASE WHEN msg_id % 3 <> 0 THEN 'dml_0_v1' END AS vc,
         coalesce(CASE WHEN msg_id % 2 = 0 THEN msg_id * 10 END, CASE WHEN msg_id % 4 <> 3 THEN msg_id * 10 + 1 END, 0) AS tso, num_rows, CAST(NULL AS BIGINT) AS n_keys FROM batches
  UNION ALL
  SELECT g, n, 'Delete', CASE WHEN g % 2 = 0 THEN 'dml_9' ELSE 'dml_0' END, 'dml_0_v0', g, 0, 2 FROM (SELECT msg_id // 4 AS g, count(*) AS n FROM batches GROUP BY 1)
)"""


@query("decode_batch", _BATCH + ' SELECT "offset", i, kind, pchannel, num_rows, n_keys FROM bm')
def decode_batch(spark, sf_dir):
    d = D.decode_batch(batch_messages(spark, sf_dir))
    return d.select("offset", F.col("i").cast("long").alias("i"), "kind", "pchannel", F.col("num_rows").cast("long").alias("num_rows"), F.when(F.col("keys").isNotNull(), F.size("keys")).cast("long").alias("n_keys"))


@query("batch_defaults", _BATCH + ' SELECT "offset", i, coalesce(vc, pchannel) AS vchannel, tso, kind FROM bm')
def batch_defaults(spark, sf_dir):
    return D.decode_batch(batch_messages(spark, sf_dir)).select("offset", F.col("i").cast("long").alias("i"), "vchannel", "tso", "kind")


#: Put at the front of every fifth batch: elements that are no maps, maps with wrong types, and a map that fits.
_FOREIGN = ['1', '"a"', 'null', '[2]', '{"msgType":"Insert","ts":"9"}', '{"ts":5,"numRows":null,"fieldsData":[7,{"name":"x","vals":["1",2,null,{"a":1}]}]}', '{"ts":6.5,"vchannel":3,"fieldsData":[{"vals":"x","dim":5000000000}]}', '{"msgType":"Delete","ts":8,"primaryKeys":["k",4,null]}']


def foreign_batches(spark, sf_dir):
    """batch_messages with foreign elements in every fifth, and every eleventh (from 3 and 4) not readable as a whole."""
    b, g = batch_messages(spark, sf_dir), F.col("offset")
    text = F.col("value").cast("string")
    text = F.when(g % 5 == 0, F.replace(text, F.lit('"messages":['), F.lit('"messages":[' + ",".join(_FOREIGN) + ","))).otherwise(text)
    text = F.when(g % 11 == 3, "no json").when(g % 11 == 4, F.lit('{"messages":{"a":1}}')).otherwise(text)
    return b.select("topic", F.lit(0).alias("partition"), "offset", F.encode(text, "UTF-8").alias("value"))


_FOREIGN_BATCH = _BATCH + """
, g AS (SELECT DISTINCT "offset" AS o FROM bm)
, fb AS (
  SELECT "offset", i + CASE WHEN "offset" % 5 = 0 THEN 8 ELSE 0 END AS i, kind, pchannel, tso, num_rows, n_keys FROM bm
  UNION ALL SELECT o, 5, 'TimeTick', CASE WHEN o % 2 = 0 THEN 'dml_9' ELSE 'dml_0' END, 5, 4, NULL FROM g WHERE o % 5 = 0
  UNION ALL SELECT o, 7, 'Delete', CASE WHEN o % 2 = 0 THEN 'dml_9' ELSE 'dml_0' END, 8, 0, 3 FROM g WHERE o % 5 = 0
)"""


@query("decode_batch_foreign", _FOREIGN_BATCH + ' SELECT "offset", i, kind, pchannel, tso, num_rows, n_keys FROM fb WHERE "offset" % 11 NOT IN (3, 4)')
def decode_batch_foreign(spark, sf_dir):
    d = D.decode_batch(foreign_batches(spark, sf_dir))
    return d.select("offset", F.col("i").cast("long").alias("i"), "kind", "pchannel", "tso", F.col("num_rows").cast("long").alias("num_rows"), F.when(F.col("keys").isNotNull(), F.size("keys")).cast("long").alias("n_keys"))


@query("batch_quarantine", _FOREIGN_BATCH + """ SELECT 'dml_0' AS topic, 0 AS "partition", o AS "offset", element, 'a batch of typed message maps' AS expected, detected FROM (
 SELECT o, 4 AS element, 'ts: STRING' AS detected FROM g WHERE o % 5 = 0 AND o % 11 NOT IN (3, 4)
 UNION ALL SELECT o, 6, 'vchannel: BIGINT, ts: DECIMAL, fieldsData[0].dim: BIGINT, fieldsData[0].vals: STRING' FROM g WHERE o % 5 = 0 AND o % 11 NOT IN (3, 4)
 UNION ALL SELECT o, NULL, CASE o % 11 WHEN 3 THEN 'malformed JSON' ELSE 'messages: OBJECT' END FROM g WHERE o % 11 IN (3, 4))""")
def batch_quarantine(spark, sf_dir):
    return D.batch_quarantine(foreign_batches(spark, sf_dir)).drop("detail")


_ROWS = on(fixtures.BATCHES)


@query("columnar_pivot", "SELECT o_orderkey // 16 AS msg_id, row_number() OVER (PARTITION BY o_orderkey // 16 ORDER BY o_orderkey) - 1 AS row_pos, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def columnar_pivot(spark, sf_dir):
    d = P.pivot_rows(fixtures.batches(spark, sf_dir))
    return d.select("msg_id", F.col("row_pos").cast("long").alias("row_pos"), *(F.col("row")[c].alias(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")))


@query("columnar_pivot_typed", "SELECT o_orderkey // 16 AS msg_id, o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def columnar_pivot_typed(spark, sf_dir):
    schema = StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string")
    return P.pivot_known(fixtures.batches(spark, sf_dir), schema).drop("row_pos")


def bad_batches(spark, sf_dir):
    """Batches; of every fiftieth the second column has lost its last value."""
    b = fixtures.batches(spark, sf_dir)
    cut = F.transform("fields", lambda f, i: F.struct(f["name"].alias("name"), f["type"].alias("type"), F.when(i == 1, F.slice(f["vals"], F.lit(1), F.size(f["vals"]) - 1)).otherwise(f["vals"]).alias("vals")))
    return b.withColumn("fields", F.when(F.col("msg_id") % 50 == 0, cut).otherwise(F.col("fields")))


@query("length_mismatch", _ROWS + " SELECT msg_id, num_rows, msg_id % 50 <> 0 AS good, CASE WHEN msg_id % 50 = 0 THEN 'o_custkey' ELSE '' END AS bad_fields FROM batches")
def length_mismatch(spark, sf_dir):
    good, bad = D.validate_lengths(bad_batches(spark, sf_dir))
    return good.select("msg_id", "num_rows", F.lit(True).alias("good"), F.lit("").alias("bad_fields")).unionByName(bad.select("msg_id", "num_rows", F.lit(False).alias("good"), F.array_join("bad_fields", ",").alias("bad_fields")))


@query("quarantine", _ROWS + " SELECT 'dml_0' AS topic, 0 AS \"partition\", msg_id AS \"offset\", 'equal column lengths' AS expected, 'o_custkey' AS detected, 'rows ' || num_rows AS detail FROM batches WHERE msg_id % 50 = 0")
def quarantine(spark, sf_dir):
    _, bad = D.validate_lengths(bad_batches(spark, sf_dir))
    bad = bad.select(F.lit("dml_0").alias("topic"), F.lit(0).alias("partition"), F.col("msg_id").alias("offset"), "bad_fields", "num_rows")
    return D.quarantine(bad, "equal column lengths", F.array_join("bad_fields", ","), F.concat(F.lit("rows "), F.col("num_rows").cast("string")))


@query("bad_payload", "SELECT event_id AS \"offset\", event_id % 11 IN (0, 1) AS bad FROM events")
def bad_payload(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    e = e.select(F.col("event_id").alias("offset"), F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 11 == 1, F.encode(F.lit(""), "UTF-8")).otherwise(F.encode("props", "UTF-8")).alias("value"))
    good, bad = D.reject_empty(e)
    return good.select("offset", F.lit(False).alias("bad")).unionByName(bad.select("offset", F.lit(True).alias("bad")))


@query("field_name_default", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_name END AS name FROM part")
def field_name_default(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 6 == 0, " ").when(F.col("p_partkey") % 3 != 0, F.col("p_name"))
    return p.select("p_partkey", D.field_name(name, F.col("p_partkey")).alias("name"))


_KEYS = on(fixtures.DELETES)


def _delete_rows(spark, sf_dir):
    d = fixtures.deletes(spark, sf_dir)
    return d.select("msg_id", D.delete_keys(F.col("int_keys"), F.col("str_keys"), F.col("legacy_keys")).alias("keys"))


@query("delete_keys", _KEYS + " SELECT msg_id, array_to_string(coalesce(list_transform(int_keys, lambda x: CAST(x AS VARCHAR)), str_keys, list_transform(legacy_keys, lambda x: CAST(x AS VARCHAR))), ',') AS keys FROM deletes")
def delete_keys(spark, sf_dir):
    return _delete_rows(spark, sf_dir).select("msg_id", F.array_join("keys", ",").alias("keys"))


@query("delete_fanout", "SELECT l_orderkey AS msg_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS key_pos, CAST(l_linenumber AS VARCHAR) AS key FROM lineitem WHERE l_returnflag = 'R'")
def delete_fanout(spark, sf_dir):
    return D.explode_deletes(_delete_rows(spark, sf_dir)).select("msg_id", F.col("key_pos").cast("long").alias("key_pos"), "key")


@query("delete_first_key", "SELECT l_orderkey AS msg_id, CAST(min(l_linenumber) AS VARCHAR) AS key FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def delete_first_key(spark, sf_dir):
    return D.explode_deletes(_delete_rows(spark, sf_dir), compat_first_key=True).select("msg_id", "key")


def flat_vectors(spark, sf_dir):
    """Eight vectors in a row, flat; of every fifth message the last three values are missing, every seventh has dim 0."""
    e = _t(spark, sf_dir, "embeddings").groupBy(F.expr("vec_id div 8").alias("msg_id")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("r"))
    flat = F.flatten(F.transform("r", lambda x: x["embedding"]))
    e = e.select("msg_id", flat.alias("flat"))
    return e.select("msg_id", F.when(F.col("msg_id") % 5 == 0, F.slice("flat", F.lit(1), F.size("flat") - 3)).otherwise(F.col("flat")).alias("flat"), F.when(F.col("msg_id") % 7 == 0, 0).otherwise(64).alias("dim"))


@query("slice_float_vectors", """WITH f AS (SELECT vec_id // 8 AS msg_id, flatten(list(embedding ORDER BY vec_id)) AS a FROM embeddings GROUP BY 1),
 g AS (SELECT msg_id, CASE WHEN msg_id % 5 = 0 THEN a[1:len(a) - 3] ELSE a END AS a, CASE WHEN msg_id % 7 = 0 THEN 0 ELSE 64 END AS dim FROM f),
 h AS (SELECT msg_id, unnest(CASE WHEN dim = 0 THEN [a] ELSE list_transform(range(0, len(a) // 64), lambda i: a[i * 64 + 1:i * 64 + 64]) END) AS v, unnest(range(0, CASE WHEN dim = 0 THEN 1 ELSE len(a) // 64 END)) AS pos FROM g)
 SELECT msg_id, pos, CAST(len(v) AS BIGINT) AS n, v[1] AS first, v[len(v)] AS last FROM h""")
def slice_float_vectors(spark, sf_dir):
    d = flat_vectors(spark, sf_dir).select("msg_id", F.posexplode(V.slice_vectors(F.col("flat"), F.col("dim"))).alias("pos", "v"))
    return d.select("msg_id", F.col("pos").cast("long").alias("pos"), F.size("v").cast("long").alias("n"), F.element_at("v", 1).alias("first"), F.element_at("v", -1).alias("last"))


@query("slice_byte_vectors", """WITH b AS (SELECT vec_id, [printf('%02X', CAST(vec_id % 256 AS INTEGER)), printf('%02X', CAST((vec_id * 7) % 256 AS INTEGER)), printf('%02X', CAST((vec_id * 13 + label) % 256 AS INTEGER)), printf('%02X', CAST((vec_id * 31) % 256 AS INTEGER)), '05'] AS h FROM embeddings),
 k AS (SELECT * FROM b, (VALUES ('BinaryVector', 1), ('Int8Vector', 2), ('Float16Vector', 4)) t(kind, w))
 SELECT vec_id, kind, array_to_string(list_transform(range(0, 5 // w), lambda i: array_to_string(h[i * w + 1:i * w + w], '')), ',') AS vectors FROM k""")
def slice_byte_vectors(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    byte = lambda c: F.lpad(F.hex(c % 256), 2, "0")
    i = F.col("vec_id")
    raw = F.unhex(F.concat(byte(i), byte(i * 7), byte(i * 13 + F.col("label")), byte(i * 31), F.lit("05")))
    e = e.select("vec_id", raw.alias("b"))
    out = None
    for kind in ("BinaryVector", "Int8Vector", "Float16Vector"):  # two dimensions each
        d = e.select("vec_id", F.lit(kind).alias("kind"), F.array_join(F.transform(V.slice_bytes(F.col("b"), F.lit(V.vector_width(kind, 2))), F.hex), ",").alias("vectors"))
        out = d if out is None else out.unionByName(d)
    return out


def sparse_bytes(spark, sf_dir):
    """Components above 0.2 in whole eighths, as packed (index, float) entries and three more bytes."""
    e = _t(spark, sf_dir, "embeddings")
    entries = F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("k"), F.floor(x * 8).cast("int").alias("e"))), lambda s: F.abs(s["e"]) > 1)
    return e.select("vec_id", entries.alias("entries"))


@query("sparse_vector_json", """WITH p AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
 SELECT vec_id, '{' || coalesce(string_agg('"' || i || '":' || CAST(CAST(floor(CAST(x * 8 AS DOUBLE)) AS INTEGER) AS VARCHAR), ',' ORDER BY i) FILTER (abs(CAST(floor(CAST(x * 8 AS DOUBLE)) AS INTEGER)) > 1), '') || '}' AS json FROM p GROUP BY vec_id""")
def sparse_vector_json(spark, sf_dir):
    d = sparse_bytes(spark, sf_dir)
    return d.select("vec_id", V.sparse_to_json(F.transform("entries", lambda s: F.struct(s["k"].alias("k"), s["e"].alias("v")))).alias("json"))


@query("unpack_vectors", "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, embedding[1] AS first, embedding[64] AS last, 2 * label AS sparse_key FROM embeddings")
def unpack_vectors(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    packed = e.select("vec_id", pack_f32("embedding").alias("b"), pack_sparse("label").alias("s"))
    d = packed.select("vec_id", V.unpack_f32("b").alias("v"), V.unpack_sparse("s").alias("s"))
    return d.select("vec_id", F.size("v").cast("long").alias("n"), F.element_at("v", 1).alias("first"), F.element_at("v", -1).alias("last"), F.element_at("s", 1)["k"].cast("int").alias("sparse_key"))


@F.pandas_udf(BinaryType())
def pack_f32(v: pd.Series) -> pd.Series:
    return v.map(lambda x: x.astype("<f4").tobytes())


@F.pandas_udf(BinaryType())
def pack_halves(label: pd.Series, kind: pd.Series) -> pd.Series:
    """[0, label] as 16-bit floats, or [-1, -label - 1] as bfloat16."""
    import numpy as np

    x = np.stack((np.zeros(len(label), "f4"), label.to_numpy("f4")), axis=1)
    raw = x.astype("<f2") if kind.iloc[:1].eq("f16").all() else ((-x - 1).view("<u4") >> 16).astype("<u2")
    return pd.Series([r.tobytes() for r in raw])


@F.pandas_udf(BinaryType())
def pack_sparse(label: pd.Series) -> pd.Series:
    import struct

    return label.map(lambda x: struct.pack("<If", 2 * int(x), 0.5) + b"\0\0\0")


@query("scalar_extract", "SELECT event_id, t AS kind, CASE t WHEN 'Int64' THEN CAST(user_id AS VARCHAR) WHEN 'VarChar' THEN event_type WHEN 'Bool' THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 'JSON' THEN props ELSE '' END AS vals FROM (SELECT *, (['Int64', 'VarChar', 'Bool', 'JSON', 'None'])[event_id % 5 + 1] AS t FROM events)")
def scalar_extract(spark, sf_dir):
    kinds = F.array(*map(F.lit, ["Int64", "VarChar", "Bool", "JSON", "None"]))
    e = _t(spark, sf_dir, "events").withColumn("kind", F.element_at(kinds, (F.col("event_id") % 5 + 1).cast("int")))
    typed = {"Int64": F.array("user_id"), "VarChar": F.array("event_type"), "Bool": F.array(F.col("user_id") % 2 == 0), "JSON": F.array(F.decode(F.encode("props", "UTF-8"), "UTF-8"))}
    return e.select("event_id", "kind", F.array_join(D.scalar_values(F.col("kind"), typed), ",").alias("vals"))


@query("array_field", "SELECT o_orderkey // 16 AS msg_id, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS vals FROM orders GROUP BY 1")
def array_field(spark, sf_dir):
    b = fixtures.batches(spark, sf_dir)
    return b.select("msg_id", F.array_join(D.array_field(F.get("fields", F.lit(2))["vals"]), ",").alias("vals"))


@query("array_first", "SELECT o_orderkey // 16 AS msg_id, arg_min(o_orderstatus, o_orderkey) AS val FROM orders GROUP BY 1")
def array_first(spark, sf_dir):
    b = fixtures.batches(spark, sf_dir)
    return b.select("msg_id", D.array_field(F.get("fields", F.lit(2))["vals"], compat_first_elem=True).alias("val"))


@query("batch_scalar", "SELECT event_id, kind, CASE kind WHEN 'Int32' THEN CAST(event_id * 7919 * 1000 AS VARCHAR) WHEN 'Int64' THEN CAST(event_id * 7919 * 1000 AS VARCHAR) WHEN 'Bool' THEN CASE WHEN user_id % 2 = 0 THEN 'true' END ELSE event_type END AS val FROM (SELECT *, (['Int32', 'Int64', 'Bool', 'VarChar'])[event_id % 4 + 1] AS kind FROM events)")
def batch_scalar(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("kind", F.element_at(F.array(*map(F.lit, ["Int32", "Int64", "Bool", "VarChar"])), (F.col("event_id") % 4 + 1).cast("int")))
    text = F.when(F.col("kind").isin("Int32", "Int64"), (F.col("event_id") * 7919 * 1000).cast("string")).when(F.col("kind") == "Bool", F.when(F.col("user_id") % 2 == 0, "TRUE")).otherwise(F.col("event_type"))
    return e.select("event_id", "kind", D.batch_scalar(text, F.col("kind")).alias("val"))


@query("align_columns", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS score FROM orders")
def align_columns(spark, sf_dir):
    return P.align(_t(spark, sf_dir, "orders"), StructType.fromDDL("o_orderkey bigint, o_orderstatus string, score double"))


@query("lag_by_minute", on(fixtures.LOG) + " SELECT make_timestamp(((tso >> 18) // 60000) * 60000000) AS minute, count(*) AS n, max(tso) AS top FROM log WHERE kind <> 'TimeTick' GROUP BY 1")
def lag_by_minute(spark, sf_dir):
    d = fixtures.log(spark, sf_dir).where("kind <> 'TimeTick'").withColumn("at", T.tso_to_timestamp(F.col("tso")))
    g = d.groupBy(F.window("at", "1 minute")).agg(F.count("*").alias("n"), F.max("tso").alias("top"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "n", "top")
