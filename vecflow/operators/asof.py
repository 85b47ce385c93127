"""As-of joins and running numbers without a window over the large side.

Few change points are sent whole, and the large side stays where it is. Else the key axis is cut into buckets. The small side (change points) is gathered by bucket, with the nearest point beyond
the bucket carried in; the large side meets its bucket's row in an equi-join and searches its points by halving. So the
large side is spread over as many tasks as it has buckets, however few channels there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets of the key axis whose carried points are put together at once.
SPINE = 4096


#: Keys on which bounds of ranges rest at most.
SAMPLE = 4096


#: Rows that a task is dealt, about, where their number is known.
DEALT = 100_000


#: Change points that are sent to every task at most: each row of the large side is compared with all of its channel.
FEW = 64


def dealt(df: DataFrame, rows: int | None, *by: str) -> DataFrame:
    """df dealt by columns to as many tasks as its rows ask for, before a window by the same columns. Without that
    tasks are joined by the bytes they shuffle, which for rows of few numbers are a twentieth of what sorting them takes."""
    n = -(-(rows or 0) // DEALT)
    return df.repartition(n, *by) if n > 1 else df


def asof(left: DataFrame, right: DataFrame, on: list[str], key: str, point: str, value: str, forward: bool = False, strict: bool = True, width: int = 1024, name: str | None = None, keys: DataFrame | None = None, points: int | None = None) -> DataFrame:
    """left with the value of the nearest right row: the last with point < key, or forward the first with point > key;
    with strict False equal points count too. Null where there is none. Points are unique within ``on``. ``keys`` may hold
    the columns on and key of left, or more of them, where they are cheaper to come by than left itself. ``points`` is the
    number of right's rows, or a greater one, where that is known."""
    name = name or value
    if points is not None and points <= FEW:
        return _by_stretches(left, right, on, key, point, value, forward, strict, name)
    bucket = F.floor(F.col(key) / F.lit(width)).cast("long")
    l = left.withColumn("__b", bucket)
    r = right.select(*on, F.floor(F.col(point) / F.lit(width)).cast("long").alias("__b"), F.struct(F.col(point).alias("k"), F.col(value).alias("v")).alias("__x"))
    mine = r.groupBy(*on, "__b").agg(F.array_sort(F.collect_list("__x")).alias("__pts"))
    edge = F.element_at("__pts", 1 if forward else -1)
    spine = (left if keys is None else keys).select(*on, bucket.alias("__b")).distinct().join(mine, [*on, "__b"], "full_outer")
    # the nearest point beyond a bucket is the greatest of those before it (forward: the least of those after it)
    spine = spine.withColumns({"__at": -F.col("__b") if forward else F.col("__b"), "__edge": F.when(F.col("__pts").isNotNull(), edge)})
    spine = running(spine, on, "__at", "__edge", None, SPINE, "__carry", least=forward).drop("__at", "__edge")
    # points that lie before the one sought (forward) or up to it
    n = _up_to(F.col("__pts"), F.col(key), strict if forward else not strict)
    best = F.coalesce(F.get("__pts", n if forward else n - 1), F.col("__carry"))
    return l.join(spine, [*on, "__b"], "left").withColumn(name, best["v"]).drop("__b", "__pts", "__carry")


def _by_stretches(left: DataFrame, right: DataFrame, on: list[str], key: str, point: str, value: str, forward: bool, strict: bool, name: str) -> DataFrame:
    """asof() by the stretch of the key axis, up to the next point, for which each point stands: those are sent to every
    task, and each row of left lies in one at most."""
    at, end, k = F.col("__at"), F.col("__end"), F.col(key)
    r = right.where(F.col(point).isNotNull()).select(*(F.col(c).alias(f"__on_{c}") for c in on), F.col(point).alias("__at"), F.col(value).alias("__v"))
    r = r.withColumn("__end", (F.lag if forward else F.lead)("__at").over(Window.partitionBy(*(f"__on_{c}" for c in on)).orderBy("__at")))
    if forward:
        inside = (k < at) & (end.isNull() | (k >= end)) if strict else (k <= at) & (end.isNull() | (k > end))
    else:
        inside = (k > at) & (end.isNull() | (k <= end)) if strict else (k >= at) & (end.isNull() | (k < end))
    for c in on:
        inside = inside & (F.col(c) == F.col(f"__on_{c}"))
    rest = [c for c in left.columns if c not in (*on, name)]
    return left.join(F.broadcast(r), inside, "left").select(*on, *rest, F.col("__v").alias(name))


def _up_to(points: Column, key: Column, equal: bool) -> Column:
    """How many of an array's sorted points have k < key, or with equal k <= key; 0 of a null array."""
    size = F.greatest(F.coalesce(F.size(points), F.lit(0)), F.lit(0))
    halvings = F.greatest(F.ceil(F.log2(size + 1)).cast("int"), F.lit(1))
    steps = F.slice(F.array(*(F.lit(1 << i) for i in range(30, -1, -1))), -halvings, halvings)

    def step(n: Column, more: Column, key: Column) -> Column:
        k = F.get(points, n + more - 1)["k"]
        return n + F.when(k <= key if equal else k < key, more).otherwise(0)

    # the key is bound once: its expression, which may decode a whole message, must not be evaluated at each halving
    found = F.transform(F.array(key), lambda k: F.aggregate(steps, F.lit(0), lambda n, more: step(n, more, k)))
    return F.when(size > 0, F.get(found, F.lit(0))).otherwise(0)


def ranges(df: DataFrame, key: str, n: int) -> Column:
    """A number that rises with a key of any orderable type, for at most n ranges of about equally many keys. The bounds
    come from the SAMPLE keys of smallest hashes, which are the same whenever they are asked for."""
    k = F.col(key)
    some = df.where(k.isNotNull()).select(key).distinct().orderBy(F.xxhash64(k), k).limit(SAMPLE).collect()
    keys = sorted(r[0] for r in some)
    bounds = sorted({keys[i * len(keys) // n] for i in range(1, n)}) if keys else []
    return _up_to(F.array(*(F.struct(F.lit(b).alias("k")) for b in bounds)), k, True) if bounds else F.lit(0)


def running(df: DataFrame, within: list[str], key: str, value: str, name: str | None, width: int, before: str | None = None, least: bool = False, rows: int | None = None) -> DataFrame:
    """df with the running maximum (or minimum) of a column in key order as ``name``, put together from buckets of the key
    as in ``number``, and as ``before`` that of the rows before (null at the first). Keys are unique within ``within``;
    ``rows`` is about their number."""
    top, choose = (F.min, F.least) if least else (F.max, F.greatest)
    d = df.withColumn("__r", F.floor(F.col(key) / F.lit(width)).cast("long"))
    tops = d.groupBy(*within, "__r").agg(top(value).alias("__m"))
    ahead = Window.partitionBy(*within).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    reach = tops.select(*within, "__r", top("__m").over(ahead).alias("__reach"))
    own = Window.partitionBy(*within, "__r").orderBy(key)
    parts = {n: top(value).over(w) for n, w in ((name, own), (before, own.rowsBetween(Window.unboundedPreceding, -1))) if n}
    d = dealt(d, rows, *within, "__r").withColumns(parts).join(reach, [*within, "__r"])
    return d.withColumns({n: choose(n, "__reach") for n in parts}).drop("__r", "__reach")


def number(df: DataFrame, within: list[str], axis: Column, order: list[Column], name: str = "seq", rows: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """df with running numbers from 1 in the given order: numbered within buckets of the axis (which must rise with the
    order), and shifted by the sizes of the buckets before. ``rows`` is about the number of df's rows. ``keys`` may hold
    exactly the rows of df, with at least the columns of within and axis, where they are cheaper to come by than df itself."""
    d = df.withColumn("__b", axis.cast("long"))
    sizes = (d if keys is None else keys.withColumn("__b", axis.cast("long"))).groupBy(*within, "__b").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(*within).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inner = F.row_number().over(Window.partitionBy(*within, "__b").orderBy(*order))
    return dealt(d, rows, *within, "__b").withColumn("__i", inner).join(before, [*within, "__b"]).withColumn(name, (F.col("__before") + F.col("__i")).cast("long")).drop("__b", "__i", "__before")
