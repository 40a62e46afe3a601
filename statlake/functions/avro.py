"""Schemas as data: Spark fields with their Avro form, and nested fields by dotted names."""

from __future__ import annotations

import re
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T


def avro_text(spark: SparkSession, data_type: T.DataType, nullable: bool, name: str = "topLevelRecord", namespace: str = "") -> str | None:
    """Avro form of a Spark type as JSON text, by Spark's own converter; null if it holds a type or a name that
    Avro lacks."""
    sql = spark._jvm.org.apache.spark.sql
    text = re.sub('"string collate [^"]*"', '"string"', data_type.json())  # a collation is not part of a value
    try:
        made = sql.avro.SchemaConverters.toAvroType(sql.types.DataType.fromJson(text), nullable, name, namespace)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() in ("IncompatibleSchemaException", "SchemaParseException"):
            return None
        raise
    return made.toString()


def schema_fields(spark: SparkSession, schema: T.StructType, namespace: str = "") -> list[dict]:
    """The ``fields`` entry of a catalog row: the columns in their order."""
    return [
        {
            "name": f.name,
            "spark_type": f.dataType.simpleString(),
            "nullable": f.nullable,
            "avro_type": avro_text(spark, f.dataType, f.nullable, f.name, namespace),
        }
        for f in schema.fields
    ]


def nested_fields(schema: T.StructType) -> list[dict]:
    """The ``nested`` entry of a catalog row: columns and all that they hold, parents before children.

    Fields of structs are named ``parent.field``, elements of arrays ``parent.element``, keys and values of
    maps ``parent.key`` and ``parent.value``; names that hold a dot or a back quote are quoted. The type of
    a struct, array or map is that word alone, so a change shows at the field that changed and not at
    all that hold it.
    """

    def walk(name: str, kind: T.DataType, nullable: bool) -> Iterator[dict]:
        inner: list[tuple[str, T.DataType, bool]] = []
        if isinstance(kind, T.StructType):
            inner = [(_part(f.name), f.dataType, f.nullable) for f in kind.fields]
        elif isinstance(kind, T.ArrayType):
            inner = [("element", kind.elementType, kind.containsNull)]
        elif isinstance(kind, T.MapType):
            inner = [("key", kind.keyType, False), ("value", kind.valueType, kind.valueContainsNull)]
        text = kind.typeName() if isinstance(kind, T.StructType | T.ArrayType | T.MapType) else kind.simpleString()
        yield {"name": name, "spark_type": text, "nullable": nullable, "avro_type": None}
        for part, own, empty in inner:
            yield from walk(f"{name}.{part}", own, empty)

    return [x for f in schema.fields for x in walk(_part(f.name), f.dataType, f.nullable)]


def _part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`" if "." in name or "`" in name else name
