"""Scalar function families: text, dates, math, arrays, maps, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.text import squeeze
from smelter.plans.catalogue.patterns import SPACES
from smelter.plans.registry import query
from smelter.sources.readers import table


@query("""
SELECT c_custkey,
       upper(substr(c_mktsegment, 1, 3)) AS segment_code,
       lower(c_mktsegment) AS segment,
       length(c_name) AS name_length,
       concat(c_mktsegment, '/', c_nationkey) AS path,
       concat_ws('|', c_name, c_mktsegment) AS label,
       split_part(c_name, '#', 2) AS number_text,
       CAST(regexp_extract(c_name, '#0*([0-9]+)', 1) AS BIGINT) AS number,
       regexp_replace(c_name, '[0-9]', 'x', 'g') AS masked,
       ltrim('  ' || c_mktsegment) || rtrim('! ') || trim('  .  ') AS trimmed,
       printf('%s has %.2f', c_name, c_acctbal) AS sentence
FROM customer
""")
def customer_labels(spark: SparkSession, sf: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.upper(segment.substr(1, 3)).alias("segment_code"),
        F.lower(segment).alias("segment"),
        F.length(name).cast("bigint").alias("name_length"),
        F.concat(segment, F.lit("/"), F.col("c_nationkey").cast("string")).alias("path"),
        F.concat_ws("|", name, segment).alias("label"),
        F.split(name, "#")[1].alias("number_text"),
        F.regexp_extract(name, "#0*([0-9]+)", 1).cast("bigint").alias("number"),
        F.regexp_replace(name, "[0-9]", "x").alias("masked"),
        F.concat(F.ltrim(F.concat(F.lit("  "), segment)), F.rtrim(F.lit("! ")), F.trim(F.lit("  .  ")))
        .alias("trimmed"),
        F.format_string("%s has %.2f", name, "c_acctbal").alias("sentence"),
    )


@query("""
SELECT o_orderkey,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, strftime(o_orderdate, '%Y-%m') AS month_label,
       CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due, CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS notice,
       CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age_days
FROM orders
""")
def order_calendar(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.date_format(day, "yyyy-MM").alias("month_label"),
        F.date_add(day, 30).alias("due"), F.date_sub(day, 7).alias("notice"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
    )


@query("""
SELECT event_id,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
       CAST(second(ts) AS INTEGER) AS second,
       CAST(floor(epoch(ts)) AS BIGINT) AS unix_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS text_time,
       CAST(strptime(strftime(ts, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS TIMESTAMP) AS to_minute,
       CAST(ts AS DATE) AS day
FROM events
""")
def event_clock(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    seconds = F.unix_timestamp(ts)
    minute_text = F.date_format(ts, "dd/MM/yyyy HH:mm")
    return table(spark, sf, "events").select(
        "event_id",
        F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second"),
        seconds.alias("unix_time"),
        F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss").alias("text_time"),
        F.to_timestamp(minute_text, "dd/MM/yyyy HH:mm").cast("timestamp_ntz").alias("to_minute"),
        F.to_date(ts).alias("day"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice,
       abs(l_discount - l_tax) AS spread,
       round(l_extendedprice, 0) AS rounded,
       CAST(ceil(l_extendedprice) AS BIGINT) AS up, CAST(floor(l_extendedprice) AS BIGINT) AS down,
       round(ln(l_extendedprice), 8) AS natural_log, round(log2(l_extendedprice), 8) AS log_2,
       round(log10(l_extendedprice), 8) AS log_10,
       round(pow(1 + l_discount, 2), 8) AS growth, round(sqrt(l_quantity), 8) AS root,
       round(exp(l_tax), 8) AS exponent,
       greatest(l_discount, l_tax) AS most, least(l_discount, l_tax) AS fewest
FROM lineitem
""")
def price_math(spark: SparkSession, sf: str) -> DataFrame:
    price, share, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.abs(share - tax).alias("spread"),
        F.round(price, 0).alias("rounded"),
        F.ceil(price).alias("up"), F.floor(price).alias("down"),
        F.round(F.log(price), 8).alias("natural_log"), F.round(F.log2(price), 8).alias("log_2"),
        F.round(F.log10(price), 8).alias("log_10"),
        F.round(F.pow(1 + share, 2), 8).alias("growth"), F.round(F.sqrt("l_quantity"), 8).alias("root"),
        F.round(F.exp(tax), 8).alias("exponent"),
        F.greatest(share, tax).alias("most"), F.least(share, tax).alias("fewest"),
    )


@query(f"""
WITH tokens AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '{SPACES}'), lambda t: t <> '') AS words FROM documents
),
placed AS (
    SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) - 1 AS place FROM tokens
)
SELECT token, count(*) AS n_occurrences, count(DISTINCT doc_id) AS n_docs, CAST(min(place) AS INTEGER) AS earliest
FROM placed GROUP BY token
""")
def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split(F.lower(squeeze("text")), " ")
    docs = table(spark, sf, "documents").select(words.alias("words"))
    # Each text's distinct words are listed once more behind all of them, so that words
    # and documents are counted in one aggregation that combines before its shuffle.
    listed = docs.select(F.size("words").alias("length"),
                         F.posexplode(F.flatten(F.array("words", F.array_distinct("words")))).alias("place", "token"))
    in_text = F.col("place") < F.col("length")
    return listed.filter(F.col("token") != "").groupBy("token").agg(
        F.count_if(in_text).alias("n_occurrences"),
        F.count_if(~in_text).alias("n_docs"),
        F.min(F.when(in_text, F.col("place"))).alias("earliest"))


@query("""
SELECT user_id, event_type, count(*) AS n, CAST(count(*) OVER (PARTITION BY user_id) AS INTEGER) AS n_types,
       bool_or(event_type = 'purchase') OVER (PARTITION BY user_id) AS has_purchase
FROM events GROUP BY user_id, event_type
""")
def user_type_map(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    # One entry per event type: the map stays as small as the set of types.
    per_user = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("by_type"))
    return per_user.select(
        "user_id", F.explode("by_type").alias("event_type", "n"),
        F.size(F.map_keys("by_type")).alias("n_types"),
        F.array_contains(F.map_keys("by_type"), "purchase").alias("has_purchase"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS packed,
       json_extract_string(props, '$.k') AS k_tuple, 'k' AS only_key, json_extract_string(props, '$.k') AS only_value
FROM events
""")
def events_json_access(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    events = table(spark, sf, "events").select("event_id", "event_type", "props", k.alias("k_text"))
    as_map = F.create_map(F.lit("k"), F.col("k_text"))
    lifted = events.select("*", F.json_tuple("props", "k").alias("k_tuple"))
    return lifted.select(
        "event_id", "k_text", F.col("k_text").cast("bigint").alias("k"),
        F.to_json(F.struct("event_type", F.col("k_text").cast("int").alias("k"))).alias("packed"), "k_tuple",
        F.map_keys(as_map)[0].alias("only_key"), F.map_values(as_map)[0].alias("only_value"))
