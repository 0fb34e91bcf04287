"""Text formats that are written and read back, row ids, and estimates with a bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.nested import flatten_unknown_json, infer_json_schema
from smelter.operators import sketches
from smelter.operators.joins import join_null_safe
from smelter.operators.lineage import scratch_folder
from smelter.plans.registry import query
from smelter.sources.readers import read_any, read_json, table

ERROR = 0.02


@query("""
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, true AS is_close FROM lineitem GROUP BY l_returnflag
""")
def approx_orders(spark: SparkSession, sf: str) -> DataFrame:
    # The estimate is within three times its relative standard deviation. It has a pass of its own: beside an exact
    # count of distinct values every one of them would carry a sketch through the shuffle.
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey")
    exact = lines.distinct().groupBy("l_returnflag").agg(F.count("l_orderkey").alias("n_orders"))
    guessed = lines.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", ERROR).alias("guessed"))
    found = join_null_safe(exact, guessed, ["l_returnflag"])
    close = F.abs(F.col("guessed") - F.col("n_orders")) <= 3 * ERROR * F.col("n_orders")
    return found.select("l_returnflag", "n_orders", close.alias("is_close"))


@query("""
SELECT c_custkey, trim('  ' || c_name || ' ') AS name, rtrim(c_mktsegment || '  ') AS segment,
       ltrim('   ' || c_mktsegment) AS left_segment FROM customer
""")
def trimmed_columns(spark: SparkSession, sf: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("name"),
        F.rtrim(F.concat(segment, F.lit("  "))).alias("segment"),
        F.ltrim(F.concat(F.lit("   "), segment)).alias("left_segment"))


@query("""
SELECT p_partkey, p_size, p_type, 'STRUCT<_c0: INT, _c1: INT, _c2: STRING>' AS csv_schema,
       'STRUCT<key: BIGINT, size: BIGINT>' AS json_schema
FROM part
""")
def csv_fields(spark: SparkSession, sf: str) -> DataFrame:
    # The schema of the lines is that of one of them, that of the objects what all of them have in common.
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    lines = parts.select(F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), "p_type").alias("line"))
    objects = parts.select(F.to_json(F.struct(F.col("p_partkey").alias("key"), F.col("p_size").alias("size"))).alias("object"))
    fields = (f"{f.name}: {f.dataType.simpleString().upper()}" for f in infer_json_schema(objects, "object").fields)
    one = lines.agg(F.max("line")).first()[0]
    parsed = F.from_csv("line", "p_partkey bigint, p_size int, p_type string")
    return lines.select(parsed.alias("p"), F.schema_of_csv(F.lit(one)).alias("csv_schema"),
                        F.lit(f"STRUCT<{', '.join(fields)}>").alias("json_schema")).select("p.*", "csv_schema", "json_schema")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) < current_date AS is_past FROM orders")
def orders_past(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", (F.to_date("o_orderdate") < F.current_date()).alias("is_past"))


@query("""
SELECT l_returnflag, count(*) AS n_rows,
       count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS n_ids
FROM lineitem GROUP BY l_returnflag
""")
def stable_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    # An id that follows from the row itself is the same however the rows are dealt out.
    row_id = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf, "lineitem").select("l_returnflag", row_id.alias("row_id")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_bronze(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").write.json(folder)
    return read_json(spark, folder, "event_id bigint, user_id bigint, event_type string, value double")


@query("""
SELECT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS p_partkey, p_size,
       CASE WHEN p_partkey % 10 = 0 THEN 'x' || p_partkey || ',' || p_size END AS raw
FROM part
""")
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a field that does not fit keep the whole line beside what could be read."""
    folder = scratch_folder(spark)
    broken = F.when(F.pmod("p_partkey", F.lit(10)) == 0, "x").otherwise("")
    line = F.concat(broken, F.col("p_partkey").cast("string"), F.lit(","), F.col("p_size").cast("string"))
    table(spark, sf, "part").select(line.alias("value")).write.text(folder)
    return read_any(spark, "csv", folder, "p_partkey bigint, p_size int, raw string",
                    mode="PERMISSIVE", columnNameOfCorruptRecord="raw")


@query("""
SELECT event_id, user_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
       try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL AS _dq_json_valid FROM events
""")
def events_props_inferred(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "props")
    return flatten_unknown_json(events, "props", "_dq_json_valid")


def _daily_users(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of each day's users per event type, stored by day and read back."""
    folder = scratch_folder(spark)
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    sketches.distinct_sketches(events, ["day", "event_type"], "user_id").write.partitionBy("day").parquet(folder)
    return spark.read.parquet(folder)


@query()
def users_estimated(spark: SparkSession, sf: str) -> DataFrame:
    """Users of each month and event type, estimated from the days' sketches, and how far that is from counting them."""
    daily = _daily_users(spark, sf).withColumn("month", F.trunc("day", "month"))
    monthly = sketches.merged_sketches(daily, ["month", "event_type"])
    exact = table(spark, sf, "events").groupBy(F.trunc(F.to_date("ts"), "month").alias("month"), "event_type").agg(
        F.count_distinct("user_id").alias("n_users"))
    both = monthly.select("month", "event_type", sketches.estimate("sketch").alias("estimated")).join(exact, ["month", "event_type"])
    return both.withColumn("relative_error", F.abs(F.col("estimated") - F.col("n_users")) / F.col("n_users"))


@query("""
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(DISTINCT user_id) AS n_users, true AS is_close
FROM events GROUP BY ALL
""")
def users_estimated_bound(spark: SparkSession, sf: str) -> DataFrame:
    found = users_estimated(spark, sf)
    return found.select("month", "event_type", "n_users", (F.col("relative_error") <= sketches.error_bound()).alias("is_close"))


PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query()
def quantiles_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of the lines' amounts with the error of their ranks."""
    lines = table(spark, sf, "lineitem").select(*PROFILED)
    return sketches.rank_errors(lines, sketches.quantile_profile(lines, PROFILED))


@query(f"""
SELECT column_name, quantile, n, true AS is_close
FROM (SELECT unnest({list(PROFILED)}) AS column_name) CROSS JOIN (SELECT CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS quantile)
CROSS JOIN (SELECT count(*) AS n FROM lineitem)
""")
def quantiles_lineitem_bound(spark: SparkSession, sf: str) -> DataFrame:
    found = quantiles_lineitem(spark, sf)
    return found.select("column_name", "quantile", "n", (F.col("rank_error") <= 1 / sketches.ACCURACY).alias("is_close"))
