"""explode_message: a message's rows or keys as a table function for SQL, itself written in SQL: it becomes one generator
over a VARIANT of the message, so nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

_MAPS = "filter(coalesce(try_variant_get(m, '$.fieldsData', 'array<variant>'), array()), f -> schema_of_variant(f) LIKE 'OBJECT%')"
_JSON = "coalesce(CASE WHEN NOT is_variant_null({0}) THEN to_json({0}) END, 'null')"
_KEY = "CASE WHEN is_variant_null(k) THEN NULL WHEN schema_of_variant(k) RLIKE '^(ARRAY|OBJECT)' THEN to_json(k) ELSE try_variant_get(k, '$', 'string') END"

# Values are bound to names by transforms of arrays of one element: m the message, fs its columns as (name, vals), n rows.
_INSERT = f"""
flatten(transform(array(transform({_MAPS}, f -> struct(try_variant_get(f, '$.name', 'variant') AS name, coalesce(try_variant_get(f, '$.vals', 'array<variant>'), array()) AS vals))), fs ->
  flatten(transform(array(CASE WHEN schema_of_variant(try_variant_get(m, '$.numRows', 'variant')) = 'BIGINT' AND coalesce(try_variant_get(m, '$.numRows', 'bigint'), 0) <> 0
      THEN least(try_variant_get(m, '$.numRows', 'bigint'), coalesce(array_max(transform(fs, f -> size(f.vals))), 0)) ELSE size(get(fs, 0).vals) END), n ->
    CASE WHEN n > 0 THEN transform(sequence(0, cast(n - 1 AS INT)), i -> struct('Insert' AS kind, cast(NULL AS STRING) AS key,
      concat('{{', array_join(transform(fs, f -> concat({_JSON.format('f.name')}, ': ', {_JSON.format('get(f.vals, i)')})), ', '), '}}') AS row)) ELSE array() END))))"""
_DELETE = f"""
transform(coalesce(try_variant_get(m, '$.primaryKeys.ints', 'array<variant>'), try_variant_get(m, '$.primaryKeys.strs', 'array<variant>'), try_variant_get(m, '$.int64PrimaryKeys', 'array<variant>'), array()), k ->
  struct('Delete' AS kind, {_KEY} AS key, cast(NULL AS STRING) AS row))"""


def register(spark: SparkSession) -> None:
    """explode_message(value): (row_pos, kind, key, row) of one JSON message: an insert's rows as JSON objects by field
    name, a delete's keys. Anything else, and a null or malformed message, gives no row; columns that are no maps are left
    out; a number of rows that is no integer counts as missing, and one beyond the longest column as its length."""
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION explode_message(value STRING) RETURNS TABLE(row_pos INT, kind STRING, key STRING, row STRING)
RETURN SELECT e.pos, e.col.kind, e.col.key, e.col.row FROM LATERAL posexplode(flatten(transform(array(try_parse_json(value)), m ->
  CASE try_variant_get(m, '$.base.msgType', 'string') WHEN 'Insert' THEN {_INSERT} WHEN 'Delete' THEN {_DELETE} ELSE array() END))) AS e""")
