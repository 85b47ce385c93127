"""Queries of conversions, filters, schemas, change records, snapshots, progress and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecflow import fixtures
from vecflow.functions import convert as V
from vecflow.functions import types as Y
from vecflow.operators import changes as H
from vecflow.operators import envelope as E
from vecflow.operators import filters as X
from vecflow.operators import metrics as M
from vecflow.operators import ordering as O
from vecflow.operators import profile as R
from vecflow.operators import progress as G
from vecflow.operators import schema as S
from vecflow.operators import snapshot as N
from vecflow.plans.registry import query
from vecflow.plans.sql import on, solution

_t = fixtures.table

# conversions


def _events(spark, sf_dir):
    return _t(spark, sf_dir, "events").withColumn("wide", F.col("event_id") * 7919 * 40503)


@query("conv_bool", "SELECT event_id, lower(trim(CASE WHEN user_id % 2 = 0 THEN ' TRUE' ELSE event_type END)) = 'true' AS by_text, ((event_id * 7919 * 40503) & 4294967295) <> 0 AS by_int, abs(value / 10) >= 1 AS by_float FROM events")
def conv_bool(spark, sf_dir):
    text = F.when(F.col("user_id") % 2 == 0, " TRUE").otherwise(F.col("event_type"))
    return _events(spark, sf_dir).select("event_id", V.to_bool(text, "string").alias("by_text"), V.to_bool(F.col("wide"), "integer").alias("by_int"), V.to_bool(F.col("value") / 10, "floating").alias("by_float"))


@query("conv_short", "SELECT event_id, CAST(xor((event_id * 7919 * 40503) & 65535, 32768) - 32768 AS SMALLINT) AS v FROM events")
def conv_short(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", V.to_short(F.col("wide")).alias("v"))


@query("conv_int", "SELECT event_id, CAST(xor((event_id * 7919 * 40503) & 4294967295, 2147483648) - 2147483648 AS INTEGER) AS v FROM events")
def conv_int(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", V.to_int(F.col("wide")).alias("v"))


@query("conv_long", "SELECT event_id, event_id * 7919 * 40503 AS v FROM events")
def conv_long(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", V.to_long(F.col("wide").cast("string")).alias("v"))


@query("conv_float", "SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS f, value AS d FROM events")
def conv_float(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", V.to_float(F.col("value")).cast("double").alias("f"), V.to_double(F.col("value").cast("string")).alias("d"))


@query("conv_string", "SELECT event_id, CAST(event_id * 7919 * 40503 AS VARCHAR) AS i, CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS b FROM events")
def conv_string(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", V.to_string(F.col("wide")).alias("i"), V.to_string(F.col("user_id") % 2 == 0).alias("b"))


@query("conv_list", "SELECT event_id, CAST(event_id * 7919 * 40503 AS VARCHAR) AS items, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS n FROM events")
def conv_list(spark, sf_dir):
    e = _events(spark, sf_dir)
    some = V.to_list(F.when(F.col("user_id") % 2 == 0, F.col("event_type")))
    return e.select("event_id", F.array_join(V.to_list(V.to_list(F.col("wide").cast("string")), is_list=True), ",").alias("items"), F.when(some.isNull(), 0).otherwise(F.size(some)).alias("n"))


@query("conv_bytes", "SELECT event_id, hex(event_type) AS h FROM events")
def conv_bytes(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.hex(V.to_bytes(F.col("event_type"))).alias("h"))


@query("conv_float_vector", "SELECT vec_id, embedding[1] AS a, embedding[64] AS b FROM embeddings")
def conv_float_vector(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    packed = e.select("vec_id", V.convert_untyped(F.col("embedding"), "floats").alias("raw"))
    v = V.to_float_vector(F.col("raw"), is_bytes=True)
    return packed.select("vec_id", v.alias("v")).select("vec_id", F.element_at("v", 1).alias("a"), F.element_at("v", 64).alias("b"))


@query("conv_untyped", "SELECT event_id, event_id AS n, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS e, event_type AS s, '[' || user_id || ']' AS other FROM events")
def conv_untyped(spark, sf_dir):
    enum = {"click": 1, "view": 2}
    return _events(spark, sf_dir).select("event_id", V.convert_untyped(F.col("event_id"), "integer").alias("n"), V.convert_untyped(F.col("event_type"), "enum", enum).alias("e"), V.convert_untyped(F.col("event_type"), "string").alias("s"), V.convert_untyped(F.array("user_id"), "list").alias("other"))


@query("decimal_modes", "SELECT event_id, value AS as_double, CAST(CAST(value AS DECIMAL(38,7)) AS VARCHAR) AS f, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,15)) AS VARCHAR) AS d, CAST(value AS VARCHAR) AS s FROM events")
def decimal_modes(spark, sf_dir):
    v = F.col("value")
    return _events(spark, sf_dir).select("event_id", V.decimal_mode(v, "Double", "double").alias("as_double"), V.decimal_mode(v, "Float", "precise").cast("string").alias("f"), V.decimal_mode(v, "Double", "precise").cast("string").alias("d"), V.decimal_mode(v, "Double", "string").alias("s"))


_FIELD_TYPES = list(Y.TYPES)


@query("type_mapping", "SELECT p_partkey, t AS type, CASE " + " ".join(f"WHEN t = '{k}' THEN '{v}'" for k, v in Y.TYPES.items()) + f" END AS column_type FROM (SELECT p_partkey, ({_FIELD_TYPES!r})[p_partkey % {len(_FIELD_TYPES)} + 1] AS t FROM part)")
def type_mapping(spark, sf_dir):
    types = F.array(*map(F.lit, _FIELD_TYPES))
    p = _t(spark, sf_dir, "part").select("p_partkey", F.element_at(types, (F.col("p_partkey") % len(_FIELD_TYPES) + 1).cast("int")).alias("type"))
    return p.join(Y.type_table(spark), "type").select("p_partkey", "type", "column_type")


@query("infer_types", "SELECT event_id, (['Bool', 'Int64', 'Double', 'Array', 'JSON', 'VarChar', 'None'])[event_id % 7 + 1] AS type FROM events")
def infer_types(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    k, user = F.col("event_id") % 7, F.col("user_id").cast("string")
    sample = F.when(k == 0, "true").when(k == 1, user).when(k == 2, F.concat(user, F.lit(".5"))).when(k == 3, F.concat(F.lit("["), user, F.lit("]"))).when(k == 4, F.col("props")).when(k == 5, F.concat(F.lit('"'), "event_type", F.lit('"')))
    return e.select("event_id", Y.infer_type(sample).alias("type"))


@query("json_fields", "SELECT event_id, CAST(regexp_extract(props, '\"k\": ?(-?[0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_fields(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# filters


@query("collection_filter", r"SELECT p_partkey, p_brand AS collection FROM part WHERE regexp_full_match(p_brand, '(Brand#1.*)|(Brand#[234])') AND NOT regexp_full_match(p_brand, 'Brand#12|Brand#3')")
def collection_filter(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("collection"))
    return X.filter_collections(p, ["Brand#1.*", "Brand#[234]"], ["Brand#12", "Brand#3"])


def _named(spark, sf_dir):
    name = F.when(F.col("pk") % 13 == 0, " ").when(F.col("pk") % 11 != 0, F.concat(F.lit("c"), (F.col("pk") % 10).cast("string")))
    return fixtures.log(spark, sf_dir).where("kind <> 'TimeTick'").withColumn("collection", name)


_NAMED = fixtures.LOG + """,
named AS (SELECT *, CASE WHEN pk % 13 = 0 THEN ' ' WHEN pk % 11 <> 0 THEN 'c' || (pk % 10) END AS collection FROM log WHERE kind <> 'TimeTick')"""


@query("drop_unnamed", on(_NAMED) + " SELECT p, collection FROM named WHERE trim(collection) <> ''")
def drop_unnamed(spark, sf_dir):
    return X.drop_unnamed(_named(spark, sf_dir)).select("p", "collection")


def _known(spark, sf_dir):
    return _t(spark, sf_dir, "nation").where("n_nationkey < 7").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("collection"), F.col("n_regionkey").cast("string").alias("pk_field"))


@query("unknown_collection", on(_NAMED) + " SELECT p, collection, collection IN (SELECT 'c' || n_nationkey FROM nation WHERE n_nationkey < 7) AS known FROM named WHERE trim(collection) <> ''")
def unknown_collection(spark, sf_dir):
    known, unknown = X.drop_unknown(X.drop_unnamed(_named(spark, sf_dir)), _known(spark, sf_dir))
    return known.select("p", "collection", F.lit(True).alias("known")).unionByName(unknown.select("p", "collection", F.lit(False).alias("known")))


@query("ddl_events", on(fixtures.LOG) + " SELECT p, CASE WHEN p % 50 = 0 THEN 'DDL' ELSE kind END AS kind, p % 50 = 0 AS side FROM log WHERE kind <> 'TimeTick' OR p % 50 = 0")
def ddl_events(spark, sf_dir):
    d = fixtures.log(spark, sf_dir).withColumn("kind", F.when(F.col("p") % 50 == 0, "DDL").otherwise(F.col("kind")))
    dml, ddl = X.split_ddl(d)
    return dml.select("p", "kind", F.lit(False).alias("side")).unionByName(ddl.select("p", "kind", F.lit(True).alias("side")))


# schemas and lookups


@query("schema_lookup", on(_NAMED) + " SELECT p, collection, CAST(n_regionkey AS VARCHAR) AS pk_field FROM named LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 7) ON collection = 'c' || n_nationkey")
def schema_lookup(spark, sf_dir):
    return S.with_schema(_named(spark, sf_dir), _known(spark, sf_dir)).select("p", "collection", "pk_field")


@query("resolve_vchannel", """WITH c AS (SELECT CAST(c_nationkey AS VARCHAR) AS collection, c_custkey AS pos, c_name AS vchannel, 'p' || (c_custkey % 7) AS pchannel FROM customer WHERE c_nationkey % 3 > 0)
 SELECT CAST(n_nationkey AS VARCHAR) AS collection, (SELECT vchannel FROM c WHERE c.collection = CAST(n_nationkey AS VARCHAR) ORDER BY CASE WHEN pchannel = 'p1' THEN 0 ELSE 1 END, pos LIMIT 1) AS vchannel FROM nation""")
def resolve_vchannel(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").where("c_nationkey % 3 > 0").select(F.col("c_nationkey").cast("string").alias("collection"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("vchannel"), F.concat(F.lit("p"), (F.col("c_custkey") % 7).cast("string")).alias("pchannel"))
    return S.resolve_vchannel(_t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("collection")), c, "p1")


_FIELDS_SQL = """fields AS (
 SELECT p_brand AS collection, p_partkey AS pos, CASE WHEN p_size % 9 = 0 THEN 'ID' WHEN p_size % 9 = 1 THEN 'x_id' ELSE p_name || p_partkey END AS name,
        (['Float', 'VarChar', 'Bool', 'Int64'])[p_partkey % 4 + 1] AS type, CASE WHEN length(p_brand) = 7 AND p_brand < 'Brand#3' THEN 'x_id' ELSE 'none' END AS metadata_pk FROM part)"""


@query("pk_resolution", on(_FIELDS_SQL) + """ SELECT collection, arg_min(name, (r, pos)) AS pk FROM (SELECT *, CASE WHEN name = metadata_pk THEN 0
 WHEN (lower(name) = 'id' OR lower(name) LIKE '%\\_id' ESCAPE '\\' OR lower(name) LIKE 'id\\_%' ESCAPE '\\') AND type IN ('Int64', 'VarChar') THEN 1 WHEN type IN ('Int64', 'VarChar') THEN 2 ELSE 3 END AS r FROM fields) GROUP BY collection""")
def pk_resolution(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 9 == 0, "ID").when(F.col("p_size") % 9 == 1, "x_id").otherwise(F.concat("p_name", F.col("p_partkey").cast("string")))
    kinds = F.array(*map(F.lit, ["Float", "VarChar", "Bool", "Int64"]))
    meta = F.when((F.length("p_brand") == 7) & (F.col("p_brand") < "Brand#3"), "x_id").otherwise("none")
    return S.resolve_pk(p.select(F.col("p_brand").alias("collection"), F.col("p_partkey").alias("pos"), name.alias("name"), F.element_at(kinds, (F.col("p_partkey") % 4 + 1).cast("int")).alias("type"), meta.alias("metadata_pk")))


def _with_fields(spark, sf_dir, changes=O.ordered_changes):
    """Released changes in order; the fields of an insert depend on its offset."""
    d = changes(fixtures.log(spark, sf_dir)).withColumn("collection", F.col("event_type"))
    base = [F.lit("id"), F.lit("value")]
    return d.withColumn("fields", F.when(F.col("p") % 3 == 0, F.array(*base)).when(F.col("p") % 3 == 1, F.array(*base, F.lit("props"))).otherwise(F.array(F.lit("id"), F.lit("props"))))


_FIELDS = solution() + """, fl AS (SELECT *, event_type AS collection, (['id,value', 'id,value,props', 'id,props'])[p % 3 + 1] AS fields FROM done WHERE kind = 'Insert'),
first AS (SELECT collection, arg_min(fields, seq) AS fields, min(seq) AS seq FROM fl GROUP BY 1)"""


@query("first_schema", _FIELDS + " SELECT * FROM first")
def first_schema(spark, sf_dir):
    d = S.first_schema(_with_fields(spark, sf_dir))
    return d.select("collection", F.array_join("fields", ",").alias("fields"), "seq")


def _metadata(spark, sf_dir):
    return _t(spark, sf_dir, "region").select(F.when(F.col("r_regionkey") == 0, "view").when(F.col("r_regionkey") == 1, "signup").otherwise(F.col("r_name")).alias("collection"), F.array(F.lit("id"), F.lit("score")).alias("fields"))


@query("schema_source", _FIELDS + """, m AS (SELECT CASE r_regionkey WHEN 0 THEN 'view' WHEN 1 THEN 'signup' ELSE r_name END AS collection FROM region)
 SELECT collection, CASE WHEN m.collection IS NOT NULL THEN 'id,score' ELSE fields END AS fields, CASE WHEN m.collection IS NOT NULL THEN 'metadata' ELSE 'insert' END AS source FROM first FULL JOIN m USING (collection)""")
def schema_source(spark, sf_dir):
    d = S.schema_source(S.first_schema(_with_fields(spark, sf_dir)), _metadata(spark, sf_dir))
    return d.select("collection", F.array_join("fields", ",").alias("fields"), "source")


@query("schema_drift", _FIELDS + """, d AS (SELECT fl.collection, array_to_string(list_sort(list_filter(str_split(fl.fields, ','), lambda x: NOT list_contains(str_split(first.fields, ','), x))), ',') AS extra,
  array_to_string(list_sort(list_filter(str_split(first.fields, ','), lambda x: NOT list_contains(str_split(fl.fields, ','), x))), ',') AS missing FROM fl JOIN first USING (collection))
 SELECT collection, extra, missing, count(*) AS n FROM d WHERE extra <> '' OR missing <> '' GROUP BY ALL""")
def schema_drift(spark, sf_dir):
    # the log is one physical channel, so places that aren't numbered tell the first
    d = S.drift_from_first(_with_fields(spark, sf_dir, O.placed_changes))
    return d.select("collection", F.array_join("extra", ",").alias("extra"), F.array_join("missing", ",").alias("missing"), "n")


# change records


@query("envelope", on(fixtures.UPSERTS) + " SELECT p, CASE kind WHEN 'Insert' THEN 'c' ELSE 'd' END AS op, pk AS key_pk, CASE WHEN kind = 'Delete' THEN pk END AS before_pk, CAST(NULL AS DOUBLE) AS before_value, CASE WHEN kind = 'Insert' THEN pk END AS after_pk, value AS after_value FROM upserts")
def envelope(spark, sf_dir):
    d = E.envelope(fixtures.upserts(spark, sf_dir), "pk", ["pk", "value"])
    return d.select("p", "op", F.col("key.pk").alias("key_pk"), F.col("before.pk").alias("before_pk"), F.col("before.value").alias("before_value"), F.col("after.pk").alias("after_pk"), F.col("after.value").alias("after_value"))


@query("source_block", on(fixtures.LOG) + " SELECT p, '1' AS version, 'vecflow' AS connector, tso >> 18 AS ts_ms, (tso >> 18) * 1000 AS ts_us, (tso >> 18) * 1000000 AS ts_ns, 'default' AS db, event_type AS collection, pchannel, vchannel, tso FROM log")
def source_block(spark, sf_dir):
    d = E.source_block(fixtures.log(spark, sf_dir).withColumn("collection", F.col("event_type")))
    return d.select("p", *(F.col(f"source.{c}").alias(c) for c in ("version", "connector", "ts_ms", "ts_us", "ts_ns", "db", "collection", "pchannel", "vchannel", "tso")))


@query("event_position", on(fixtures.LOG) + " SELECT p, tso >> 18 AS event_time_ms, 'pchannel=' || pchannel || ',tso=' || tso || coalesce(',vchannel=' || vchannel, '') AS position FROM log")
def event_position(spark, sf_dir):
    d = E.event_position(fixtures.log(spark, sf_dir))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("position"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return d.select("p", "event_time_ms", text.alias("position"))


@query("route_topic", on(fixtures.LOG) + " SELECT p, 'cdc.default.' || event_type AS topic FROM log WHERE kind <> 'TimeTick'")
def route_topic(spark, sf_dir):
    d = fixtures.log(spark, sf_dir).where("kind <> 'TimeTick'").withColumn("collection", F.col("event_type"))
    return E.route(d, "cdc").select("p", "topic")


@query("record_key", on(fixtures.UPSERTS) + """ SELECT p, '{"pk":' || pk || '}' AS key FROM upserts""")
def record_key(spark, sf_dir):
    return E.with_key(fixtures.upserts(spark, sf_dir), "pk").select("p", "key")


@query("serialize_json", on(fixtures.UPSERTS) + """ SELECT p, CASE kind WHEN 'Insert' THEN '{"op":"c","after":{"pk":' || pk || '}}' ELSE '{"op":"d","before":{"pk":' || pk || '}}' END AS value FROM upserts""")
def serialize_json(spark, sf_dir):
    d = E.envelope(fixtures.upserts(spark, sf_dir), "pk", ["pk"])
    return E.serialize(d, ["op", "before", "after"]).select("p", "value")


@query("upsert_correlate", on(fixtures.UPSERTS) + " SELECT collection, pk, tso, CASE count(DISTINCT kind) WHEN 2 THEN 'u' ELSE CASE max(kind) WHEN 'Insert' THEN 'c' ELSE 'd' END END AS op, max(value) AS value FROM upserts GROUP BY ALL")
def upsert_correlate(spark, sf_dir):
    return H.correlate_upserts(fixtures.upserts(spark, sf_dir), ["value"]).select("collection", "pk", "tso", "op", "value")


@query("current_state", on(fixtures.UPSERTS) + " SELECT pk, tso, value FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY tso DESC, CASE kind WHEN 'Delete' THEN 0 ELSE 1 END DESC, p DESC) AS n FROM upserts) WHERE n = 1 AND kind <> 'Delete'")
def current_state(spark, sf_dir):
    return H.current_state(fixtures.upserts(spark, sf_dir), ["value"]).select("pk", "tso", "value")


_PHASES = "snap AS (SELECT * FROM orders WHERE o_orderkey % 10 < 7), strm AS (SELECT * FROM orders WHERE o_orderkey % 10 >= 5)"


@query("handoff_union", on(_PHASES) + " SELECT o_orderkey, 'r' AS op, 0 AS phase FROM snap UNION ALL SELECT o_orderkey, 'c', 1 FROM strm")
def handoff_union(spark, sf_dir):
    return H.handoff_union(fixtures.snap_orders(spark, sf_dir), fixtures.stream_orders(spark, sf_dir)).select("o_orderkey", "op", "phase")


@query("handoff", on(fixtures.LOG_MULTI) + """, ck AS (SELECT pchannel, max(p) // 2 AS "offset", max(tso) AS tso FROM log_multi WHERE pchannel <> 'dml_1' GROUP BY 1)
 SELECT DISTINCT CAST(NULL AS BIGINT) AS p, pk, 'r' AS op, 0 AS phase, (SELECT min(tso) FROM ck) AS tso FROM log_multi WHERE kind = 'Insert'
 UNION ALL SELECT p, pk, CASE kind WHEN 'Insert' THEN 'c' ELSE 'd' END, 1, log_multi.tso FROM log_multi LEFT JOIN ck USING (pchannel) WHERE kind <> 'TimeTick' AND ("offset" IS NULL OR p > "offset")""")
def handoff(spark, sf_dir):
    d = fixtures.log_multi(spark, sf_dir)
    ck = d.where("pchannel <> 'dml_1'").groupBy("pchannel").agg(F.expr("max(p) div 2").alias("offset"), F.max("tso").alias("tso"))
    snap = d.where("kind = 'Insert'").select("pk").distinct()
    return H.handoff(snap, d.where("kind <> 'TimeTick'").select("pchannel", "p", "pk", "kind", "tso"), ck).select("p", "pk", "op", "phase", "tso")


@query("handoff_overlap", on(_PHASES) + " SELECT o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'stream' WHEN t.o_orderkey IS NULL THEN 'snapshot' ELSE 'both' END AS phase FROM snap s FULL JOIN strm t USING (o_orderkey)")
def handoff_overlap(spark, sf_dir):
    return H.handoff_overlap(fixtures.snap_orders(spark, sf_dir), fixtures.stream_orders(spark, sf_dir), ["o_orderkey"])


@query("dedupe_handoff", on(_PHASES) + " SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 7 THEN 'r' ELSE 'c' END AS op, o_totalprice FROM orders")
def dedupe_handoff(spark, sf_dir):
    both = H.handoff_union(fixtures.snap_orders(spark, sf_dir), fixtures.stream_orders(spark, sf_dir))
    return H.dedupe(both, ["o_orderkey"], ["phase"], ["op", "o_totalprice"])


# snapshots


@query("snapshot_read", "SELECT vec_id, label, 'r' AS op, 'embeddings' AS collection, CAST(NULL AS BIGINT) AS tso FROM embeddings")
def snapshot_read(spark, sf_dir):
    d = N.snapshot(_t(spark, sf_dir, "embeddings"), "embeddings", "vec_id", ["vec_id", "label"])
    return d.select("vec_id", "label", E.operation(F.col("kind")).alias("op"), "collection", "tso")


@query("snapshot_pk_filter", "SELECT event_id, CASE WHEN user_id % 5 > 0 THEN user_id END AS pk FROM events WHERE user_id % 5 > 0")
def snapshot_pk_filter(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("user_id") % 5 > 0, F.col("user_id")).alias("pk"))
    return X.all_rows_filter(e, "pk")


@query("snapshot_pages", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page FROM orders")
def snapshot_pages(spark, sf_dir):
    return N.page(_t(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0, width=4096)


@query("snapshot_text_pages", "SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 100 AS page FROM customer")
def snapshot_text_pages(spark, sf_dir):
    return N.page(_t(spark, sf_dir, "customer").select("c_name"), "c_name", 100)


@query("snapshot_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def snapshot_counts(spark, sf_dir):
    return N.snapshot_counts(_t(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def _counts(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("collection")).agg(F.count("*").alias("n"))


_COUNTS = "c AS (SELECT o_orderpriority AS collection, count(*) AS n FROM orders GROUP BY 1)"


@query("snapshot_notifications", on(_COUNTS) + " SELECT collection, 'in_progress' AS status, CAST(NULL AS BIGINT) AS n FROM c UNION ALL SELECT collection, 'completed', n FROM c")
def snapshot_notifications(spark, sf_dir):
    return N.snapshot_notifications(_counts(spark, sf_dir))


@query("snapshot_metrics", on(_COUNTS) + " SELECT 0 AS guarantee_tso, count(*) AS collections, CAST(sum(n) AS BIGINT) AS rows_scanned, true AS completed FROM c")
def snapshot_metrics(spark, sf_dir):
    return N.snapshot_metrics(_counts(spark, sf_dir), None)


@query("snapshot_decision", """SELECT c_custkey, mode, CASE WHEN mode IN ('initial', 'when_needed') THEN c_nationkey % 3 = 0 OR c_custkey % 2 = 0 WHEN mode = 'recovery' THEN c_nationkey % 3 = 0 ELSE false END AS take
 FROM (SELECT *, (['initial', 'never', 'recovery', 'when_needed'])[c_custkey % 4 + 1] AS mode FROM customer)""")
def snapshot_decision(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").withColumn("mode", F.element_at(F.array(*map(F.lit, ["initial", "never", "recovery", "when_needed"])), (F.col("c_custkey") % 4 + 1).cast("int")))
    return c.select("c_custkey", "mode", N.snapshot_decision(F.col("mode"), F.col("c_nationkey") % 3 != 0, F.col("c_custkey") % 2 != 0).alias("take"))


@query("monitored_collections", "SELECT DISTINCT p_brand AS name FROM part WHERE p_brand <> 'Brand#3'")
def monitored_collections(spark, sf_dir):
    return N.monitored_collections(_t(spark, sf_dir, "part").select(F.col("p_brand").alias("name")), exclude=["Brand#3"])


# payload profiles


def _payloads(spark, sf_dir):
    t = F.col("event_type")
    payload = F.when((F.col("user_id") % 3 == 2) & (F.col("event_id") > 100) & (t != "error"), "unknown").when(t == "error", "tick").when(t == "purchase", "unknown").when(t == "view", "batch").otherwise("single")
    return _t(spark, sf_dir, "events").select(F.concat(F.lit("dml_"), (F.col("user_id") % 3).cast("string")).alias("topic"), F.col("event_id").alias("offset"), payload.alias("payload"))


_PAYLOADS = """pl AS (SELECT 'dml_' || (user_id % 3) AS topic, event_id AS o, CASE WHEN user_id % 3 = 2 AND event_id > 100 AND event_type <> 'error' THEN 'unknown' WHEN event_type = 'error' THEN 'tick' WHEN event_type = 'purchase' THEN 'unknown' WHEN event_type = 'view' THEN 'batch' ELSE 'single' END AS payload FROM events),
prof AS (SELECT topic, arg_min(payload, o) FILTER (payload IN ('single', 'batch')) AS format, count(*) FILTER (payload = 'unknown') AS n_unknown, min(o) FILTER (payload = 'unknown') AS first_unknown FROM pl GROUP BY 1)"""


@query("payload_profile", on(_PAYLOADS) + " SELECT * FROM prof")
def payload_profile(spark, sf_dir):
    return R.payload_profile(_payloads(spark, sf_dir))


@query("mixed_formats", on(_PAYLOADS) + " SELECT count(DISTINCT format) AS n_formats, count(DISTINCT format) > 1 AS mixed, count(*) FILTER (format <> 'single') AS clashes FROM prof")
def mixed_formats(spark, sf_dir):
    return R.check_formats(R.payload_profile(_payloads(spark, sf_dir)), "single")


@query("format_fallback", on(_PAYLOADS) + ", late AS (SELECT topic, arg_min(payload, o) FILTER (payload IN ('single', 'batch')) AS format FROM pl WHERE o >= 500 GROUP BY 1) SELECT topic, coalesce(format, 'batch') AS format FROM late")
def format_fallback(spark, sf_dir):
    return R.resolve_format(R.payload_profile(_payloads(spark, sf_dir).where("offset >= 500")))


@query("profile_reprobe", on(_PAYLOADS) + ", late AS (SELECT topic, arg_min(payload, o) FILTER (payload IN ('single', 'batch')) AS f FROM pl WHERE o >= 500 OR topic = 'dml_0' GROUP BY 1) SELECT topic, coalesce(f, format) AS format, f IS NULL AND format IS NOT NULL AS from_start, coalesce(f, format) IS NULL AND n_unknown > 0 AS error FROM prof LEFT JOIN late USING (topic)")
def profile_reprobe(spark, sf_dir):
    d = _payloads(spark, sf_dir)
    return R.reprobe(d, d.where("topic <> 'dml_0'").select("topic", F.lit(500).alias("stored")).distinct())


# progress and metrics


@query("progress_map", on(fixtures.LOG_MULTI) + " SELECT 'mq_offset_' || pchannel AS key, CAST(max(p) AS VARCHAR) AS val FROM log_multi GROUP BY 1 UNION ALL SELECT 'vchannel_timetick_' || vchannel, CAST(max(tso) AS VARCHAR) FROM log_multi WHERE kind = 'TimeTick' AND vchannel IS NOT NULL GROUP BY 1 UNION ALL VALUES ('checkpoint_ts', '7'), ('snapshot_completed', 'true')")
def progress_map(spark, sf_dir):
    return G.progress_rows(fixtures.log_multi(spark, sf_dir), 7, True)


@query("progress_load", on(fixtures.LOG_MULTI) + " SELECT 'offset' AS kind, pchannel AS name, max(p) AS val FROM log_multi GROUP BY 2 UNION ALL SELECT 'tick', vchannel, CASE WHEN vchannel LIKE '%v3' THEN 0 ELSE max(tso) END FROM log_multi WHERE kind = 'TimeTick' AND vchannel IS NOT NULL GROUP BY 2 UNION ALL VALUES ('checkpoint', '', 7), ('completed', '', 1)")
def progress_load(spark, sf_dir):
    rows = G.progress_rows(fixtures.log_multi(spark, sf_dir), 7, True)
    return G.load_progress(rows.withColumn("val", F.when(F.col("key").endswith("v3"), "bad").otherwise(F.col("val"))))


@query("stale_progress", on(fixtures.LOG_MULTI) + """, h AS (SELECT pchannel, (tso >> 18) // 86400000 AS d, max(p) AS m FROM log_multi GROUP BY 1, 2), g AS (SELECT pchannel, d AS checked_at, CASE WHEN d % 5 > 0 THEN m - m % 200 END AS progress FROM h)
 SELECT *, coalesce(progress IS NOT NULL AND progress = lag(progress) OVER (PARTITION BY pchannel ORDER BY checked_at), false) AS stale FROM g""")
def stale_progress(spark, sf_dir):
    day = F.floor(F.shiftright("tso", 18) / 86400000).cast("long")
    h = fixtures.log_multi(spark, sf_dir).groupBy("pchannel", day.alias("checked_at")).agg(F.max("p").alias("m"))
    return G.stale_progress(h.select("pchannel", "checked_at", F.when(F.col("checked_at") % 5 > 0, F.col("m") - F.col("m") % 200).alias("progress")))


@query("event_bytes", on(fixtures.LOG) + " SELECT p, CAST(256 + CASE WHEN kind = 'Insert' THEN 32 + 2 * length(props) ELSE 0 END AS BIGINT) AS bytes FROM log")
def event_bytes(spark, sf_dir):
    return M.event_bytes(fixtures.log(spark, sf_dir), {"pk": "long", "value": "double", "props": "string"}).select("p", "bytes")


@query("buffer_limits", on(fixtures.LOG_MULTI) + """, b AS (SELECT pchannel, p, 256 + CASE WHEN kind = 'Insert' THEN 2 * length(props) ELSE 0 END AS bytes FROM log_multi WHERE kind <> 'TimeTick')
 SELECT pchannel, p, count(*) OVER w AS events, CAST(sum(bytes) OVER w AS BIGINT) AS held, count(*) OVER w > 1000 OR sum(bytes) OVER w > 250000 AS over FROM b WINDOW w AS (PARTITION BY pchannel ORDER BY p)""")
def buffer_limits(spark, sf_dir):
    d = M.event_bytes(fixtures.log_multi(spark, sf_dir).where("kind <> 'TimeTick'"), {"props": "string"})
    return M.buffer_limits(d, 1000, 250_000).select("pchannel", "p", "events", "held", "over")


@query("pipeline_counters", solution() + " SELECT (SELECT count(*) FROM ev WHERE late) AS late, (SELECT count(release_p) FROM rel) AS released, (SELECT count(*) FROM rel WHERE release_p IS NULL) AS pending, (SELECT count(*) FROM wm) AS ticks")
def pipeline_counters(spark, sf_dir):
    return M.pipeline_counters(O.Ordered(fixtures.log(spark, sf_dir)))


@query("stream_metrics", solution("log_multi") + " SELECT pchannel, max(g) AS watermark, CASE WHEN max(g) <= 0 THEN 0 ELSE greatest(0, 1704153600000 - (max(g) >> 18)) END AS lag, max(p) AS position, max(g) > 0 AS resolved FROM wm GROUP BY 1")
def stream_metrics(spark, sf_dir):
    return M.stream_metrics(O.Ordered(fixtures.log_multi(spark, sf_dir)).marks, 1704153600000)
