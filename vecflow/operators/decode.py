"""Messages to events: routing by type, payload decoding, defaults, row counts, key extraction, quarantine.

A single message is JSON {base: {msgType, timestamp}, collectionName, shardName, timestamps, numRows, fieldsData,
primaryKeys}; a batch message is JSON {msgType, pchannel, messages: [...]} of message maps. Where the protobuf package is
present, from_protobuf with the same field names gives the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.functions.tso import effective_tso, or_default

FIELD = "STRUCT<name: STRING, id: BIGINT, type: STRING, dim: INT, vals: ARRAY<STRING>>"
KEYS = "STRUCT<ints: ARRAY<BIGINT>, strs: ARRAY<STRING>>"
SINGLE = f"STRUCT<base: STRUCT<msgType: STRING, timestamp: BIGINT>, collectionName: STRING, shardName: STRING, timestamps: ARRAY<BIGINT>, numRows: INT, fieldsData: ARRAY<{FIELD}>, primaryKeys: {KEYS}, int64PrimaryKeys: ARRAY<BIGINT>>"
#: Message maps of a batch: what each field must be, by the names that schema_of_variant() gives.
ELEMENT_KINDS = {"msgType": "STRING", "collectionName": "STRING", "vchannel": "STRING", "ts": "BIGINT", "timestamp": "BIGINT", "numRows": "BIGINT", "fieldsData": "ARRAY", "primaryKeys": "ARRAY"}
FIELD_KINDS = {"name": "STRING", "id": "BIGINT", "type": "STRING", "dim": "BIGINT", "vals": "ARRAY"}
INNER = f"STRUCT<msgType: STRING, collectionName: STRING, vchannel: STRING, ts: BIGINT, timestamp: BIGINT, numRows: INT, fieldsData: ARRAY<{FIELD}>, primaryKeys: ARRAY<STRING>>"
BATCH = f"STRUCT<msgType: STRING, pchannel: STRING, messages: ARRAY<{INNER}>>"

#: Message type -> event kind; a null kind is skipped.
KINDS = {"Insert": "Insert", "Delete": "Delete", "CreateCollection": "DDL", "DropCollection": "DDL", "TimeTick": "TimeTick", "CreatePartition": None, "DropPartition": None}


def event_kind(msg_type: Column) -> Column:
    """Insert, Delete, DDL or TimeTick; skip for partition changes; unknown for anything else."""
    out = None
    for t, k in KINDS.items():
        out = (F if out is None else out).when(msg_type == t, F.lit(k or "skip"))
    return out.otherwise("unknown")


def route_messages(df: DataFrame, unknown: str = "quarantine") -> DataFrame:
    """df(msg_type, ...) with kind. unknown: quarantine keeps them as such, skip drops them, error fails."""
    d = df.withColumn("kind", event_kind(F.col("msg_type"))).where("kind <> 'skip'")
    if unknown == "skip":
        return d.where("kind <> 'unknown'")
    if unknown == "error":
        return d.withColumn("kind", F.when(F.col("kind") == "unknown", F.raise_error(F.concat(F.lit("unknown message type "), F.col("msg_type")))).otherwise(F.col("kind")))
    return d


def reject_empty(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages: a null or empty value is bad."""
    empty = F.coalesce(F.length("value") == 0, F.lit(True))
    return df.where(~empty), df.where(empty)


def quarantine(bad: DataFrame, expected: str, detected: Column, detail: Column, strict: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """(topic, partition, offset, expected, detected, detail) of bad messages, and columns ``also`` kept; strict fails with
    them as the message."""
    out = bad.select("topic", "partition", "offset", *also, F.lit(expected).alias("expected"), detected.alias("detected"), detail.alias("detail"))
    if strict:
        said = F.concat_ws(" ", F.lit("expected"), "expected", F.lit("detected"), "detected", F.lit("at"), "topic", F.col("partition").cast("string"), F.col("offset").cast("string"), "detail")
        return out.withColumn("detail", F.raise_error(said).cast("string"))
    return out


def row_count(num_rows: Column, fields: Column) -> Column:
    """The stated number of rows, or the length of the first column where it is 0 or missing."""
    first = F.get(fields, F.lit(0))["vals"]
    return F.when(F.coalesce(num_rows, F.lit(0)) == 0, F.coalesce(F.size(first), F.lit(0))).otherwise(num_rows)


def field_name(name: Column, field_id: Column) -> Column:
    return F.coalesce(F.when(F.trim(name) != "", name), field_id.cast("string"))


def delete_keys(ints: Column, strs: Column, legacy: Column) -> Column:
    """Keys of a delete as text: typed integers or strings, else the legacy integers; null if there are none of them."""
    return F.coalesce(ints.cast("array<string>"), strs, legacy.cast("array<string>"))


def decode_single(df: DataFrame) -> DataFrame:
    """Messages (topic, offset, value) with one message each -> one row per message: kind, collection, pchannel,
    vchannel, tso, num_rows, fields, keys."""
    # a generator of one row: filters on what is decoded stay above it, else each of their branches decodes the message anew
    m = df.select("*", F.explode(F.array(F.from_json(F.col("value").cast("string"), SINGLE))).alias("m"))
    m = route_messages(m.withColumn("msg_type", F.col("m.base.msgType")))
    return m.select(
        "topic", "offset", "kind", F.col("m.collectionName").alias("collection"), F.col("topic").alias("pchannel"),
        or_default(F.col("m.shardName"), F.col("topic")).alias("vchannel"),
        effective_tso(F.col("m.base.timestamp"), F.col("m.timestamps")).alias("tso"),
        row_count(F.col("m.numRows"), F.col("m.fieldsData")).alias("num_rows"), F.col("m.fieldsData").alias("fields"),
        delete_keys(F.col("m.primaryKeys.ints"), F.col("m.primaryKeys.strs"), F.col("m.int64PrimaryKeys")).alias("keys"),
    )


def batch_defaults(m: Column, pchannel: Column) -> dict[str, Column]:
    """msg_type, vchannel and tso of one message map of a batch."""
    return {
        "msg_type": F.coalesce(m["msgType"], F.lit("TimeTick")),
        "vchannel": F.coalesce(F.when(F.trim(m["vchannel"]) != "", m["vchannel"]), pchannel),
        "tso": F.coalesce(m["ts"], m["timestamp"], F.lit(0).cast("long")),
    }


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... of a variant; null where it is missing."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _is_map(v: Column) -> Column:
    return F.coalesce(_kind(v) == "OBJECT", F.lit(False))


def variant_text(v: Column) -> Column:
    """A variant as text: scalars plain, arrays and maps as JSON, null as null."""
    return F.when(F.coalesce(F.is_variant_null(v), F.lit(True)), None).when(_kind(v).isin("ARRAY", "OBJECT"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))


def _misfit(v: Column, name: str, kind: str, place: Column) -> Column:
    own = F.try_variant_get(v, f"$.{name}", "variant")
    fits = own.isNull() | F.is_variant_null(own) | (_kind(own) == kind)
    if name in ("numRows", "dim"):  # these must fit 32 bits as well
        fits = fits & (own.isNull() | F.is_variant_null(own) | F.try_variant_get(own, "$", "int").isNotNull())
    return F.when(~fits, F.concat(place, F.lit(f"{name}: "), _kind(own)))


def misfits(v: Column) -> Column:
    """What is of a wrong type in a message map of a batch, as texts ``name: type``; missing and null fields fit."""
    own = F.array(*(_misfit(v, n, k, F.lit("")) for n, k in ELEMENT_KINDS.items()))
    fields = F.coalesce(F.try_variant_get(v, "$.fieldsData", "array<variant>"), F.array().cast("array<variant>"))
    inner = F.flatten(F.transform(fields, lambda f, i: F.when(_is_map(f), F.array(*(_misfit(f, n, k, F.concat(F.lit("fieldsData["), i.cast("string"), F.lit("]."))) for n, k in FIELD_KINDS.items()))).otherwise(F.array().cast("array<string>"))))
    return F.array_compact(F.concat(own, inner))


def _texts(v: Column, path: str) -> Column:
    return F.transform(F.try_variant_get(v, path, "array<variant>"), variant_text)


def _typed_element(v: Column) -> Column:
    """The INNER struct of a message map; elements of fieldsData that are no maps are left out."""
    fields = F.transform(F.filter(F.try_variant_get(v, "$.fieldsData", "array<variant>"), _is_map), lambda f: F.struct(
        F.try_variant_get(f, "$.name", "string").alias("name"), F.try_variant_get(f, "$.id", "bigint").alias("id"), F.try_variant_get(f, "$.type", "string").alias("type"),
        F.try_variant_get(f, "$.dim", "int").alias("dim"), _texts(f, "$.vals").alias("vals"),
    ))
    plain = {"msgType": "string", "collectionName": "string", "vchannel": "string", "ts": "bigint", "timestamp": "bigint", "numRows": "int"}
    return F.struct(*(F.try_variant_get(v, f"$.{n}", t).alias(n) for n, t in plain.items()), fields.alias("fieldsData"), _texts(v, "$.primaryKeys").alias("primaryKeys"))


def _batch_elements(df: DataFrame) -> DataFrame:
    """df with pchannel and fault (null, or why the whole message can't be read) and one row for each element: i, e."""
    b = df.withColumn("b", F.try_parse_json(F.col("value").cast("string")))
    list_, channel = (F.try_variant_get("b", f"$.{n}", "variant") for n in ("messages", "pchannel"))
    absent = list_.isNull() | F.is_variant_null(list_)
    fault = (
        F.when(F.col("b").isNull(), "malformed JSON").when(~_is_map(F.col("b")), F.concat(F.lit("message: "), _kind(F.col("b"))))
        .when(~(absent | (_kind(list_) == "ARRAY")), F.concat(F.lit("messages: "), _kind(list_)))
        .when(~(channel.isNull() | F.is_variant_null(channel) | (_kind(channel) == "STRING")), F.concat(F.lit("pchannel: "), _kind(channel)))
    )
    elements = F.when(fault.isNull(), F.try_variant_get("b", "$.messages", "array<variant>"))
    rest = [c for c in df.columns if c not in ("value", "pchannel", "fault", "i", "e")]
    d = b.select(*rest, "value", fault.alias("fault"), F.coalesce(F.when(fault.isNull(), F.try_variant_get("b", "$.pchannel", "string")), F.col("topic")).alias("pchannel"), elements.alias("elements"))
    return d.select(*rest, "value", "fault", "pchannel", F.posexplode_outer("elements").alias("i", "e"))


def decode_batch(df: DataFrame) -> DataFrame:
    """Messages (topic, offset, value) with batches -> one row per inner message, as of decode_single, with its place in
    the batch. The batch's pchannel goes before the topic. Elements that are no maps are left out, and the rest is kept;
    elements with a field of a wrong type, and messages that can't be read, are in batch_quarantine() instead."""
    e = _batch_elements(df).where(_is_map(F.col("e"))).where(F.size(misfits(F.col("e"))) == 0)
    m = e.select("topic", "offset", "pchannel", "i", _typed_element(F.col("e")).alias("m"))
    m = route_messages(m.withColumns(batch_defaults(F.col("m"), F.col("pchannel"))), unknown="skip")
    return m.select(
        "topic", "offset", "i", "kind", F.col("m.collectionName").alias("collection"), "pchannel", "vchannel", "tso",
        row_count(F.col("m.numRows"), F.col("m.fieldsData")).alias("num_rows"), F.col("m.fieldsData").alias("fields"), F.col("m.primaryKeys").alias("keys"),
    )


def batch_quarantine(df: DataFrame, strict: bool = False) -> DataFrame:
    """What decode_batch() can't take of messages (topic, partition, offset, value): quarantine() rows with element, the
    place in the batch (null for a whole message), detected, the wrong types, and detail, the element or message as text.

    A null or empty value counts as malformed JSON."""
    e = _batch_elements(df)
    wrong = F.when(_is_map(F.col("e")), misfits(F.col("e")))
    bad = e.select("topic", "partition", "offset", F.when(F.col("fault").isNull(), F.col("i")).alias("element"), F.coalesce("fault", F.when(F.size(wrong) > 0, F.array_join(wrong, ", "))).alias("found"), F.coalesce(F.to_json("e"), F.col("value").cast("string"), F.lit("")).alias("text"))
    bad = bad.where("found is not null")
    out = quarantine(bad, "a batch of typed message maps", F.col("found"), F.col("text"), strict, also=("element",))
    return out.select("topic", "partition", "offset", "element", "expected", "detected", "detail")


def explode_deletes(df: DataFrame, compat_first_key: bool = False) -> DataFrame:
    """One row per key of df(keys, ...): key and key_pos; compat_first_key gives only the first."""
    d = df.where(F.size("keys") > 0)
    if compat_first_key:
        return d.withColumn("key", F.get("keys", F.lit(0))).withColumn("key_pos", F.lit(0))
    rest = [c for c in df.columns if c != "keys"]
    return d.select(*rest, F.posexplode("keys").alias("key_pos", "key"))


def scalar_values(kind: Column, typed: dict[str, Column]) -> Column:
    """A field's values as text from the array of its stored kind; empty if none is set."""
    out = None
    for k, c in typed.items():
        out = (F if out is None else out).when(kind == k, c.cast("array<string>"))
    return F.coalesce(out, F.array().cast("array<string>"))


def array_field(values: Column, compat_first_elem: bool = False) -> Column:
    return F.get(values, F.lit(0)) if compat_first_elem else values


def batch_scalar(text: Column, kind: Column) -> Column:
    """A batch value as text after typing: Int32 that fits is narrowed, Float is narrowed, null stays null."""
    wide = text.try_cast("bigint")
    narrow = F.when((wide >= -(2**31)) & (wide < 2**31), wide.cast("int").cast("string")).otherwise(wide.cast("string"))
    return F.when(kind == "Int32", narrow).when(kind == "Int64", wide.cast("string")).when(kind == "Bool", F.lower(text)).otherwise(text)


def validate_lengths(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages: each column of a good one has exactly num_rows values."""
    n = F.col("num_rows")
    wrong = F.exists("fields", lambda f: F.size(f["vals"]) != n)
    bad = df.where(wrong).withColumn("bad_fields", F.transform(F.filter("fields", lambda f: F.size(f["vals"]) != n), lambda f: f["name"]))
    return df.where(~wrong), bad
