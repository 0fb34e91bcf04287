"""JSON columns lifted into plain columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_json(df: DataFrame, column: str, schema: T.StructType, flag: str | None = None) -> DataFrame:
    """Replace a JSON string column by one column per field of ``schema``.

    Unparseable text gives NULL fields. With ``flag``, a boolean column of that
    name tells whether any field could be read.
    """
    parsed = df.withColumn("_parsed", F.from_json(F.col(column), schema))
    kept = [c for c in df.columns if c != column]
    lifted = [F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields]
    if flag:
        any_field = F.coalesce(*[F.when(F.col(f"_parsed.{f.name}").isNotNull(), True) for f in schema.fields],
                               F.lit(False))
        lifted.append(any_field.alias(flag))
    return parsed.select(*kept, *lifted)


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema of a JSON text column, from all its values.

    One pass in which every task merges the types it has seen, so what reaches the driver is one type, not values. Fields in any row
    are fields of the schema; integers and decimals become decimals, other types that differ VARIANT, and fields that are only ever
    null strings. Text that is no JSON is passed over. Raises ValueError if the values are not objects.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("t")).first()["t"]
    # Names stand in backticks where they could be mistaken for anything else.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<|\bVOID\b", lambda m: {"OBJECT<": "STRUCT<", "VOID": "STRING"}.get(m[0], m[0]), merged or "")
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"{column} holds no JSON objects but {merged}")
    return T.StructType([T.StructField("_", T._parse_datatype_string(ddl))])["_"].dataType


def flatten_unknown_json(df: DataFrame, column: str, flag: str | None = None) -> DataFrame:
    """``flatten_json`` with the schema that the column itself has; one more pass finds it."""
    return flatten_json(df, column, infer_json_schema(df, column), flag)
