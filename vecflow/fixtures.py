"""Change-log inputs derived from the driver's tables, as DataFrames and as the SQL that oracles start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions.tso import tso_compose


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one physical channel's log: p, kind, pchannel, vchannel, tso, pk, value, props, event_type."""
    e = table(spark, sf_dir, "events")
    span = e.agg(F.max(ms("ts")).alias("hi"), F.min(ms("ts")).alias("lo"), F.count("*").alias("n")).first()
    step = (span["hi"] - span["lo"]) // span["n"] if span["n"] else 0
    tick = F.col("event_type") == "error"
    back = F.when(tick, 4 * step).otherwise((F.col("event_id") * 7919 % 13) * step)
    return e.select(
        F.col("event_id").alias("p"),
        F.when(tick, "TimeTick").when(F.col("event_type") == "purchase", "Delete").otherwise("Insert").alias("kind"),
        F.lit("dml_0").alias("pchannel"),
        F.when(~(tick & (F.col("event_id") % 3 == 0)), F.concat(F.lit("dml_0_v"), (F.col("event_id") % 4).cast("string"))).alias("vchannel"),
        tso_compose(ms("ts") - back, F.col("event_id") % 262144).alias("tso"),
        F.col("user_id").alias("pk"), "value", "props", "event_type",
    )


LOG = """
st AS (SELECT (max((epoch_us(ts) // 1000)) - min((epoch_us(ts) // 1000))) // count(*) AS step FROM events),
log AS (
  SELECT event_id AS p,
         CASE event_type WHEN 'error' THEN 'TimeTick' WHEN 'purchase' THEN 'Delete' ELSE 'Insert' END AS kind,
         'dml_0' AS pchannel,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE 'dml_0_v' || (event_id % 4) END AS vchannel,
         (((epoch_us(ts) // 1000) - CASE WHEN event_type = 'error' THEN 4 * step ELSE (event_id * 7919 % 13) * step END) << 18) | (event_id % 262144) AS tso,
         user_id AS pk, value, props, event_type
  FROM events, st
)"""


def log_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log dealt over three physical channels."""
    channel = F.concat(F.lit("dml_"), (F.col("pk") % 3).cast("string"))
    return log(spark, sf_dir).withColumn("pchannel", channel).withColumn("vchannel", F.concat(channel, F.substr(F.col("vchannel"), F.lit(6))))


LOG_MULTI = LOG + """,
log_multi AS (
  SELECT * REPLACE ('dml_' || (pk % 3) AS pchannel, 'dml_' || (pk % 3) || substring(vchannel, 6) AS vchannel) FROM log
)"""


_ORDER_COLUMNS = [("o_orderkey", "Int64"), ("o_custkey", "Int64"), ("o_orderstatus", "VarChar"), ("o_totalprice", "Double"), ("o_orderpriority", "VarChar")]


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as columnar insert messages: msg_id, num_rows, fields array<struct<name, type, vals array<string>>>."""
    o = table(spark, sf_dir, "orders")
    row = F.struct("o_orderkey", *(F.col(n).cast("string").alias(f"c_{n}") for n, _ in _ORDER_COLUMNS))
    g = o.groupBy(F.expr("o_orderkey div 16").alias("msg_id")).agg(F.count("*").cast("int").alias("num_rows"), F.array_sort(F.collect_list(row)).alias("rows"))
    fields = F.array(*(_field(n, t) for n, t in _ORDER_COLUMNS))
    return g.select("msg_id", "num_rows", fields.alias("fields"))


def _field(name: str, kind: str):
    return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.transform("rows", lambda r: r[f"c_{name}"]).alias("vals"))


BATCHES = "batches AS (SELECT o_orderkey // 16 AS msg_id, CAST(count(*) AS INTEGER) AS num_rows, [" + ", ".join(f"{{'name': '{n}', 'type': '{t}', 'vals': list(CAST({n} AS VARCHAR) ORDER BY o_orderkey)}}" for n, t in _ORDER_COLUMNS) + "] AS fields FROM orders GROUP BY 1)"


def deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as delete messages: msg_id, int_keys or str_keys, legacy_keys (each null where unused)."""
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    g = rows.groupBy(F.col("l_orderkey").alias("msg_id")).agg(F.array_sort(F.collect_list(F.col("l_linenumber").cast("long"))).alias("k"))
    odd, legacy = F.col("msg_id") % 2 == 1, F.col("msg_id") % 4 == 0
    return g.select(
        "msg_id", F.when(~odd & ~legacy, F.col("k")).alias("int_keys"),
        F.when(odd, F.transform("k", lambda x: x.cast("string"))).alias("str_keys"), F.when(legacy, F.col("k")).alias("legacy_keys"),
    )


DELETES = """
deletes AS (
  SELECT msg_id, CASE WHEN msg_id % 2 = 0 AND msg_id % 4 <> 0 THEN k END AS int_keys,
         CASE WHEN msg_id % 2 = 1 THEN list_transform(k, lambda x: CAST(x AS VARCHAR)) END AS str_keys,
         CASE WHEN msg_id % 4 = 0 THEN k END AS legacy_keys
  FROM (SELECT l_orderkey AS msg_id, list(CAST(l_linenumber AS BIGINT) ORDER BY l_linenumber) AS k FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
)"""


def upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes: status P deletes and inserts at one tso, F deletes, O inserts. p, kind, collection, pk, tso, value."""
    o = table(spark, sf_dir, "orders")
    tso = tso_compose(ms("o_orderdate"), F.col("o_orderkey") % 262144)
    kinds = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("Insert"), F.lit("Delete"))).when(F.col("o_orderstatus") == "F", F.array(F.lit("Delete"))).otherwise(F.array(F.lit("Insert")))
    d = o.select(F.posexplode(kinds).alias("i", "kind"), "o_orderkey", "o_custkey", tso.alias("tso"), "o_totalprice")
    return d.select((F.col("o_orderkey") * 2 + F.col("i")).alias("p"), "kind", F.lit("orders").alias("collection"), F.col("o_custkey").alias("pk"), "tso", F.when(F.col("kind") == "Insert", F.col("o_totalprice")).alias("value"))


UPSERTS = """
upserts AS (
  SELECT o_orderkey * 2 + i AS p, kind, 'orders' AS collection, o_custkey AS pk,
         ((epoch_us(o_orderdate) // 1000) << 18) | (o_orderkey % 262144) AS tso, CASE WHEN kind = 'Insert' THEN o_totalprice END AS value
  FROM (SELECT *, unnest(range(0, len(ks))) AS i, unnest(ks) AS kind
        FROM (SELECT *, CASE o_orderstatus WHEN 'P' THEN ['Insert', 'Delete'] WHEN 'F' THEN ['Delete'] ELSE ['Insert'] END AS ks FROM orders))
)"""


def snap_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 10 < 7")


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 10 >= 5")


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: pchannel, msg_id (8 little-endian bytes, decimal text, or bytes that are neither), tso."""
    n = table(spark, sf_dir, "customer").withColumn("off", F.col("c_custkey").cast("long") * 100000007)
    le = F.unhex(F.concat(*(F.substring(F.lpad(F.hex("off"), 16, "0"), 15 - 2 * i, 2) for i in range(8))))
    text = F.encode(F.col("off").cast("string"), "UTF-8")
    bad = F.encode(F.lit("abc"), "UTF-8")
    return n.select(F.col("c_name").alias("pchannel"), F.when(F.col("c_custkey") % 7 == 6, bad).when(F.col("c_custkey") % 2 == 0, le).otherwise(text).alias("msg_id"), (F.col("off") * 4096).alias("tso"))


CHECKPOINTS = """
checkpoints AS (
  SELECT c_name AS pchannel, c_custkey, CAST(c_custkey AS BIGINT) * 100000007 AS off, c_custkey % 7 = 6 AS bad, CAST(c_custkey AS BIGINT) * 100000007 * 4096 AS tso FROM customer
)"""
