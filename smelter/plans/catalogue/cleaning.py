"""Cleaning text, dates and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.nested import flatten_json
from smelter.functions.text import blank_to_null, squeeze
from smelter.functions.typing import to_date
from smelter.plans.catalogue.patterns import EDGE_SPACES, SPACES
from smelter.plans.registry import query
from smelter.sources.readers import table


@query("""
WITH raw AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 40 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date_str
    FROM orders
)
SELECT o_orderkey, CAST(try_cast(order_date_str AS DATE) AS DATE) AS order_date FROM raw
""")
def order_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.pmod("o_orderkey", F.lit(40)) == 0, "unknown").otherwise(
        F.col("o_orderdate").cast("date").cast("string"))
    raw = table(spark, sf, "orders").select("o_orderkey", text.alias("order_date_str"))
    return raw.withColumn("order_date", to_date("order_date_str")).drop("order_date_str")


@query("SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour FROM events")
def event_hour(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.hour("ts").alias("event_hour"))


@query(f"""
SELECT doc_id, nullif(regexp_replace(regexp_replace(text, '{EDGE_SPACES}', '', 'g'), '{SPACES}', ' ', 'g'), '')
           AS text,
       coalesce(lower(nullif(trim(lang), '')), 'unknown') AS lang
FROM documents
""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        blank_to_null(squeeze("text")).alias("text"),
        F.coalesce(F.lower(blank_to_null(F.trim("lang"))), F.lit("unknown")).alias("lang"),
    )


@query("""
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       json_extract(props, '$.k') IS NOT NULL AS _dq_json_valid
FROM events
""")
def events_props_flat(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "props")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return flatten_json(events, "props", schema, flag="_dq_json_valid")
