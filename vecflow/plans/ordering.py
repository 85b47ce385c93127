"""Queries of watermark ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecflow import fixtures
from vecflow.functions import tso as T
from vecflow.operators import ordering as O
from vecflow.operators.asof import running
from vecflow.plans.registry import query
from vecflow.plans.sql import on, solution


@query("ordered_changes", solution() + " SELECT seq, p, kind, pchannel, vchannel, tso, pk, value, release_p FROM done")
def ordered_changes(spark, sf_dir):
    return O.ordered_changes(fixtures.log(spark, sf_dir)).select("seq", "p", "kind", "pchannel", "vchannel", "tso", "pk", "value", "release_p")


@query("ordered_changes_by_channel", solution("log_multi") + " SELECT seq, p, kind, pchannel, vchannel, tso, pk FROM done")
def ordered_changes_by_channel(spark, sf_dir):
    return O.ordered_changes(fixtures.log_multi(spark, sf_dir)).select("seq", "p", "kind", "pchannel", "vchannel", "tso", "pk")


@query("late_events", solution() + " SELECT p, kind, vchannel, tso, g_before FROM ev WHERE late")
def late_events(spark, sf_dir):
    return O.Ordered(fixtures.log(spark, sf_dir)).events.where("late").select("p", "kind", "vchannel", "tso", "g_before")


@query("watermark_asof", solution("log_multi") + " SELECT pchannel, p, tso, g_before, late FROM ev")
def watermark_asof(spark, sf_dir):
    return O.Ordered(fixtures.log_multi(spark, sf_dir)).events.select("pchannel", "p", "tso", "g_before", "late")


@query("release_position", solution() + " SELECT p, tso, release_p FROM rel")
def release_position(spark, sf_dir):
    return O.Ordered(fixtures.log(spark, sf_dir)).released().select("p", "tso", "release_p")


@query("vchannel_timeticks", on(fixtures.LOG_MULTI) + " SELECT pchannel, vchannel, p, max(tso) OVER (PARTITION BY pchannel, vchannel ORDER BY p) AS tick FROM log_multi WHERE kind = 'TimeTick' AND vchannel IS NOT NULL")
def vchannel_timeticks(spark, sf_dir):
    own = O.ticks_of(fixtures.log_multi(spark, sf_dir)).where("vchannel is not null")
    return running(own, ["pchannel", "vchannel"], "p", "tso", "tick", O.RANGE).select("pchannel", "vchannel", "p", "tick")


@query("channel_ticks", solution() + " SELECT p, vc, level FROM gr WHERE live")
def channel_ticks(spark, sf_dir):
    o = O.Ordered(fixtures.log(spark, sf_dir))
    return O.tick_grid(o.ticks, o.seen).where("live").select("p", "vc", "level")


@query("global_watermark", solution("log_multi") + " SELECT pchannel, p, g FROM wm")
def global_watermark(spark, sf_dir):
    return O.Ordered(fixtures.log_multi(spark, sf_dir)).marks.select("pchannel", "p", "g")


@query("stalled_vchannels", solution("log_multi") + """, l AS (SELECT fs.pchannel, fs.vchannel, max(level) AS tick FROM fs LEFT JOIN gr ON gr.pchannel = fs.pchannel AND gr.vc = fs.vchannel GROUP BY ALL)
 SELECT pchannel, vchannel, tick, tick IS NULL OR tick < max(tick) OVER (PARTITION BY pchannel) AS stalled FROM l""")
def stalled_vchannels(spark, sf_dir):
    return O.stalled(fixtures.log_multi(spark, sf_dir)).select("pchannel", "vchannel", "tick", "stalled")


@query("tso_order", on(fixtures.LOG_MULTI) + " SELECT pchannel, p, tso, row_number() OVER (PARTITION BY pchannel ORDER BY tso, CASE kind WHEN 'Delete' THEN 0 ELSE 1 END, p) AS seq FROM log_multi WHERE kind <> 'TimeTick'")
def tso_order(spark, sf_dir):
    return O.in_order(fixtures.log_multi(spark, sf_dir).where("kind <> 'TimeTick'")).select("pchannel", "p", "tso", "seq")


@query("delete_first", on(fixtures.UPSERTS) + " SELECT p, kind, pk, tso, row_number() OVER (ORDER BY tso, CASE kind WHEN 'Delete' THEN 0 ELSE 1 END, p) AS seq FROM upserts")
def delete_first(spark, sf_dir):
    changes = fixtures.upserts(spark, sf_dir).withColumn("pchannel", F.lit("dml_0"))
    return O.in_order(changes).select("p", "kind", "pk", "tso", "seq")


@query("force_flush", solution("log_multi") + " SELECT pchannel, p, tso, max(tso) OVER (PARTITION BY pchannel) AS watermark, row_number() OVER (PARTITION BY pchannel ORDER BY tso, CASE kind WHEN 'Delete' THEN 0 ELSE 1 END, p) AS seq FROM rel WHERE release_p IS NULL")
def force_flush(spark, sf_dir):
    o = O.Ordered(fixtures.log_multi(spark, sf_dir))
    return O.force_flush(o.released().where("release_p is null"), o.spread).select("pchannel", "p", "tso", "watermark", "seq")


@query("partitions", on(fixtures.LOG_MULTI) + " SELECT pchannel, row_number() OVER (ORDER BY pchannel) AS n FROM (SELECT DISTINCT pchannel FROM log_multi)")
def partitions(spark, sf_dir):
    from vecflow.sources.channels import partitions as of

    return of(fixtures.log_multi(spark, sf_dir))


@query("tso_to_ts", "SELECT event_id, make_timestamp((((epoch_us(ts) // 1000) << 18) >> 18) * 1000) AS at FROM events")
def tso_to_ts(spark, sf_dir):
    e = fixtures.table(spark, sf_dir, "events")
    return e.select("event_id", T.tso_to_timestamp(T.tso_compose(fixtures.ms("ts"), F.lit(0))).cast("timestamp_ntz").alias("at"))


@query("tso_parts", on(fixtures.LOG) + " SELECT p, tso >> 18 AS physical_ms, tso & 262143 AS logical, ((tso >> 18) << 18) | (tso & 262143) AS again FROM log")
def tso_parts(spark, sf_dir):
    d = fixtures.log(spark, sf_dir).select("p", T.tso_physical_ms(F.col("tso")).alias("physical_ms"), T.tso_logical(F.col("tso")).alias("logical"))
    return d.withColumn("again", T.tso_compose(F.col("physical_ms"), F.col("logical")))


@query("watermark_lag", solution() + " SELECT p, CASE WHEN g <= 0 THEN 0 ELSE greatest(0, 1704153600000 - (g >> 18)) END AS lag FROM wm")
def watermark_lag(spark, sf_dir):
    marks = O.Ordered(fixtures.log(spark, sf_dir)).marks
    return marks.select("p", T.lag_ms(F.lit(1704153600000), F.col("g")).alias("lag"))
