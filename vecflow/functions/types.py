"""Field types of collections and the Spark types they become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Field type -> Spark type: fixed values.
TYPES = {
    "Bool": "boolean", "Int8": "smallint", "Int16": "smallint", "Int32": "int", "Int64": "bigint", "Float": "float", "Double": "double",
    "String": "string", "VarChar": "string", "Text": "string", "JSON": "string", "Geometry": "string", "FloatVector": "array<float>",
    "BinaryVector": "binary", "Int8Vector": "binary", "Float16Vector": "binary", "BFloat16Vector": "binary", "SparseFloatVector": "string",
    "Array": "array<string>", "ArrayOfVector": "binary", "ArrayOfStruct": "binary", "None": "string",
}
#: Types a primary key can have.
KEY_TYPES = ("Int64", "VarChar")
_LOGICAL = {"JSON": "json", "Geometry": "json", "FloatVector": "float_vector"}


def spark_type(field_type: str, mode: str = "double") -> str:
    if field_type in ("Float", "Double") and mode != "double":
        return "string" if mode == "string" else "decimal(38,7)" if field_type == "Float" else "decimal(38,15)"
    return TYPES.get(field_type, "string")


def struct_field(name: str, field_type: str, primary: bool = False, dim: int = 0, mode: str = "double") -> StructField:
    """One column of a collection; its logical type and dimension are column metadata, only the key is required."""
    meta = {"logical": _LOGICAL[field_type]} if field_type in _LOGICAL else {}
    if dim:
        meta["dim"] = dim
    return StructField(name, _parse_datatype_string(spark_type(field_type, mode)), not primary, meta)


def collection_struct(fields: list[dict], mode: str = "double") -> StructType:
    return StructType([struct_field(f["name"], f["type"], f.get("primary", False), f.get("dim", 0), mode) for f in fields])


def type_table(spark: SparkSession, mode: str = "double") -> DataFrame:
    return spark.createDataFrame([(t, spark_type(t, mode)) for t in TYPES], "type string, column_type string")


def infer_type(json: Column) -> Column:
    """The field type of a sample value given as JSON text."""
    t = F.trim(json)
    return (
        F.when(t.isNull() | (t == "null"), "None").when(t.isin("true", "false"), "Bool").when(t.rlike(r"^-?[0-9]+$"), "Int64")
        .when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), "Double").when(t.startswith("["), "Array").when(t.startswith("{"), "JSON").otherwise("VarChar")
    )
