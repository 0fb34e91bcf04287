from __future__ import annotations

import sys

import pytest
from conftest import SF
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from smelter.functions import text
from smelter.functions.nested import flatten_json
from smelter.functions.quality import first_reason, is_positive
from smelter.functions.typing import to_date, to_double, to_int, to_timestamp
from smelter.operators import logs, tags, udfs
from smelter.operators.aggregates import salted_sum, share_of_group_max, share_of_max
from smelter.operators.dedup import latest_by_key, upsert
from smelter.operators.joins import as_of_version, build_history, enrich, join_null_safe, overlapping_versions
from smelter.operators.progress import accuracy, at_depth, step_progress, with_not_started
from smelter.sources.readers import table


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- typing and quality

def test_lenient_typing(spark):
    df = spark.createDataFrame([("1.5",), ("N/A",), ("NaN",), ("7",), ("2026-01-15",), ("2026-01-15 14:30:00",), (None,)], "t string")
    rows = df.select("t", to_double("t").alias("d"), to_int("t").alias("i"), to_date("t").alias("day"),
                     to_timestamp("t").alias("ts")).collect()
    found = {r.t: (r.d, r.i, str(r.day)) for r in rows}
    assert found["1.5"] == (1.5, None, "None") and found["7"] == (7.0, 7, "None")
    assert found["N/A"] == found["NaN"] == found[None] == (None, None, "None")
    assert found["2026-01-15"] == (None, None, "2026-01-15")
    assert [r.ts.hour for r in rows if r.t and r.t.endswith(":00")] == [14]


def test_quality(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(is_positive("p")).collect()] == [True, False, False, False]
    reason = first_reason({"known": F.col("p").isNotNull(), "positive": F.col("p") > 0})
    assert [r[0] for r in df.select(reason).collect()] == [None, "positive", "positive", "known"]


def test_flatten_json(spark):
    df = spark.createDataFrame([(1, '{"browser": "Chrome", "os": "Linux"}'), (2, "broken"), (3, None)], "id int, m string")
    schema = StructType([StructField("browser", StringType()), StructField("os", StringType())])
    flat = flatten_json(df, "m", schema, "ok")
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [
        (1, "Chrome", "Linux", True), (2, None, None, False), (3, None, None, False)]


# --- text

def test_spaces_are_those_of_python(spark):
    every = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    # One row per 4096 characters is enough to see which of them are replaced.
    chunks = ["".join(every[i:i + 4096]) for i in range(0, len(every), 4096)]
    df = spark.createDataFrame([(c,) for c in chunks], "t string")
    kept = "".join(r[0] for r in df.select(F.regexp_replace("t", text.SPACES, "")).collect())
    assert set(every) - set(kept) == {c for c in every if c.isspace()} == set(text.SPACE_CHARS)


# Per sample: without outer space, and the keys of text, code and choices.
KEYS = [
    ("  A  b\tC \n", "A  b\tC", "a b c", "A b C", "A  B\tC"),
    ("\u00a0x\u2003y\u3000", "x\u2003y", "x y", "x y", "X\u2003Y"),
    ("", "", "", "", ""),
    (" ", "", "", "", ""),
    ("\x1c a \x1f", "a", "a", "a", "A"),
    ("it's  \"q\"", "it's  \"q\"", "it's \"q\"", "it's 'q'", "ITS  Q"),
    ("B) spark.read_1 @x!", "B) spark.read_1 @x!", "b) spark.read_1 @x!", "B) spark.read_1 @x!", "B SPARK.READ_1 @X"),
    ("ÄÖ ß", "ÄÖ ß", "äö ß", "ÄÖ ß", " "),
    ("\u200bz", "\u200bz", "\u200bz", "\u200bz", "Z"),
]


@pytest.mark.parametrize("sample", KEYS, ids=range(len(KEYS)))
def test_keys(spark, sample):
    df = spark.createDataFrame([(sample[0],)], "s string")
    keys = df.select(text.strip("s"), text.text_key("s"), text.code_key("s"), text.choice_key("s")).first()
    assert tuple(keys) == sample[1:]


UNDEFINED = "Variable '{}' is not defined. Did you forget to import or create it?"
TIP = "Tip: shuffle partitions defaults to 200. For small data, set it lower."
DEPRECATED = "Deprecation warning detected — the code still works but consider updating."
NO_TABLE = "Table '{}' doesn't exist. Check the table name and catalog."
NO_JAR = "Missing dependency: {}. The JAR may not be on the classpath."

# Per log, by hand: severity, message and line of each finding.
LOGS = [
    ("pre line 12 NameError: name 'x' is not defined\nline 99", [("error", UNDEFINED.format("x"), 12)]),
    ("x" * 300 + "line 5" + "y" * 250 + "TypeError: late", [("error", "Type error: late", None)]),
    ("line 5 " + "\N{GRINNING FACE}" * 150 + "a" * 20 + "NameError: name 'x' is not defined", [("error", UNDEFINED.format("x"), 5)]),
    ("\N{GRINNING FACE}" * 250 + "line 7 TypeError: \N{GRINNING FACE}", [("error", "Type error: \N{GRINNING FACE}", 7)]),
    ("TypeError: a\r\nTypeError: b", [("error", "Type error: a\r", None)]),
    ("typeerror: lower", [("error", "Type error: lower", None)]),
    ("ſyntaxError: long s", [("error", "Syntax error: long s", None)]),
    ("SYNTAXERROR: up", [("error", "Syntax error: up", None)]),
    ("AttributeError: 'Ä1' object has no attribute 'b'", [("error", "'Ä1' doesn't have attribute 'b'. Check the API docs.", None)]),
    ("WARN something deprecated\nspark.sql.shuffle.partitions", [("info", TIP, None), ("info", DEPRECATED, None)]),
    ("AnalysisException\nTable or view not found: t", []),
    ("org.AnalysisException: Table or view not found: db.t;", [("error", NO_TABLE.format("db.t;"), None)]),
    ("My Error here\n  WARN w\nINFO i\n", [("error", "My Error here", None)]),
    ("Error only\n" + "z" * 500, [("error", "z" * 500, None)]),
    ("WARN Error", []), ("error small", []), ("", []), ("Error\n\n \t\n", [("error", "Error", None)]),
    ("Py4JJavaError: x ClassNotFoundException: org.K line 3", [("error", NO_JAR.format("org.K"), 3)]),
    ("IndentationError: \nNameError: name 'a b' is not defined", [("error", "NameError: name 'a b' is not defined", None)]),
]


def test_log_rules(spark):
    df = spark.createDataFrame([(i, log) for i, (log, _) in enumerate(LOGS)], "id int, log string")
    found = {i: [] for i in range(len(LOGS))}
    for r in logs.classify(df, "log").orderBy("id", "rule").collect():
        found[r.id].append((r.severity, r.message, r.line))
    assert found == {i: expected for i, (_, expected) in enumerate(LOGS)}


def test_limits_of_log_rules_are_the_callers(spark):
    df = spark.createDataFrame([(1, "line 5" + "y" * 250 + "TypeError: late"), (2, "Error only\n" + "z" * 500)], "id int, log string")
    assert values(logs.classify(df, "log", nearby=None, longest=7), "id", "message", "line") == [
        (1, "Type error: late", 5), (2, "zzzzzzz", None)]


def test_rules_that_give_one_message_are_told_once(spark):
    rules = (logs.Rule("a+", "error", "same", "a"), logs.Rule("b+", "info", "same", "b"), logs.Rule("b", "info", "other", "b"))
    df = spark.createDataFrame([(1, "ab")], "id int, log string")
    assert values(logs.classify(df, "log", rules), "rule", "message") == [(0, "same"), (2, "other")]


def test_labels(spark):
    code = "class A:\n  def f(self): spark.readStream.x.where(1)\n.config('a', 1) .config(\"b\", 2)"
    df = spark.createDataFrame([(1, code), (2, "nothing"), (3, None)], "id int, code string")
    found = [r.label for r in tags.tag(df, "code").orderBy("position").collect()]
    assert found == [
        ".config('a', ...) — configuration key", ".config('b', ...) — configuration key",
        "spark.read — batch data reader", "spark.readStream — streaming reader",
        ".filter() / .where() — row filtering", "class A — define a class"]


# --- dedup and joins

def test_latest_by_key_is_stable(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "c")], "k int, at int, v string")
    for parts in (1, 3, 7):
        latest = latest_by_key(rows.repartition(parts), ["k"], [F.desc("at"), F.desc("v")])
        assert values(latest, "k", "v") == [(1, "b"), (2, "c")]


def test_upsert(spark):
    current = spark.createDataFrame([(1, 1, "old"), (2, 9, "kept")], "k int, at int, v string")
    updates = spark.createDataFrame([(1, 2, "new"), (2, 3, "late"), (3, 1, "added")], "k int, at int, v string")
    assert values(upsert(current, updates, ["k"], [F.desc("at")]), "k", "v") == [(1, "new"), (2, "kept"), (3, "added")]


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert values(join_null_safe(left, right, ["k"], "left"), "v", "w") == [(1, 10), (2, 20), (3, None)]


def test_enrich_beyond_the_broadcast_limit(spark):
    facts = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    dimension = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert values(enrich(facts, dimension, "k"), "id", "w") == values(enrich(facts, dimension, "k", max_bytes=2), "id", "w")


@pytest.fixture(scope="module")
def history(spark):
    seen = [("a", "2020-05-01", "x", 1), ("a", "2020-05-01", "y", 2), ("a", "2020-06-01", "x", 3),
            ("a", "2021-01-01", "z", 4), ("a", "2023-12-31", None, 5), ("b", "2022-02-02", "q", 6), ("b", "2030-01-01", "r", 7)]
    df = spark.createDataFrame(seen, "k string, day string, v string, n int")
    return build_history(df.withColumn("day", F.col("day").cast("timestamp_ntz")), "k", "day", "v", "n")


def test_history(history):
    days = [(k, v, str(a)[:10], str(b)[:10]) for k, v, a, b in values(history, "k", "v", "valid_from", "valid_to")]
    assert sorted(days, key=repr) == sorted([
        ("a", "x", "2020-05-01", "2021-01-01"), ("a", "z", "2021-01-01", "2023-12-31"),
        ("a", None, "2023-12-31", "None"), ("b", "q", "2022-02-02", "2030-01-01"), ("b", "r", "2030-01-01", "None")], key=repr)
    assert overlapping_versions(history, "k").count() == 0
    assert overlapping_versions(history.withColumn("valid_to", F.lit("2040-01-01").cast("timestamp_ntz")), "k").count() == 3


def test_version_in_force(spark, history):
    asked = [(1, "a", "2020-04-30", None), (2, "a", "2020-05-01", "x"), (3, "a", "2020-12-31", "x"), (4, "a", "2021-01-01", "z"),
             (5, "a", "2022-07-07", "z"), (6, "a", "2025-01-01", None), (7, "b", "2029-12-31", "q"), (8, "c", "2022-01-01", None),
             (9, None, "2022-01-01", None), (10, "a", None, None)]
    facts = spark.createDataFrame([(i, k, d) for i, k, d, _ in asked], "id int, k string, day string")
    found = as_of_version(facts.withColumn("day", F.col("day").cast("timestamp_ntz")), history, "k", "day")
    assert {r.id: r.v for r in found.collect()} == {i: v for i, _, _, v in asked}
    assert found.count() == len(asked)
    assert found.filter("id = 6").first().valid_from is not None


def test_versions_beyond_one_block(spark):
    """Facts before, between, on and after the versions of a key with several blocks of them, and with gaps."""
    history = spark.range(200).select(
        F.lit(1).alias("k"), F.col("id").cast("string").alias("v"),
        F.expr("TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(cast(id AS int) * 2)").alias("valid_from"),
        F.expr("CASE WHEN id < 199 THEN TIMESTAMP_NTZ '2024-01-02' + make_dt_interval(cast(id AS int) * 2) END").alias("valid_to"))
    facts = spark.range(-2, 410).select("id", F.lit(1).alias("k"), F.expr(
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(cast(id AS int))").alias("day"))
    more = spark.createDataFrame([(1000, 2, None), (1001, None, None)], "id long, k int, day timestamp_ntz")
    found = {r.id: r.v for r in as_of_version(facts.union(more), history, "k", "day").collect()}
    assert found == {i: str(min(i // 2, 199)) if i >= 398 or i >= 0 and i % 2 == 0 else None for i in range(-2, 410)} | {1000: None, 1001: None}


# --- aggregates

def test_salted_sum_of_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 17).cast("string")).alias("k"),
                                    F.when(F.col("id") % 11 != 0, F.col("id") / 4).alias("v"))
    direct = rows.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.avg("v").alias("a"))
    assert values(salted_sum(rows, ["k"], ["id"], "v", "s"), "k", "s", "row_count", "avg_s") == values(direct, "k", "s", "n", "a")


def test_shares_do_not_depend_on_batches(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, 4.0), ("z", 0.0)], "g string, v double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        assert values(share_of_max(df, "v", "s"), "s") == [(0.0,), (0.25,), (0.5,), (0.75,), (1.0,)]
        assert values(share_of_group_max(df, ["g"], "v", "s"), "v", "s") == [(0.0, None), (1.0, 0.5), (2.0, 1.0), (3.0, 0.75), (4.0, 1.0)]
        sale = df.select(udfs.discount("v").alias("sale"))
        assert values(sale, "sale") == values(df.select((F.col("v") * F.lit(0.9)).alias("sale")), "sale")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_row_udf(spark):
    df = spark.createDataFrame([(1.0,), (None,), (12.5,)], "v double")
    assert values(df.select(udfs.discount_row("v").alias("s")), "s") == values(
        df.select((F.col("v") * F.lit(0.9)).alias("s")), "s")


def test_approximate_distinct(spark):
    keys = table(spark, SF, "lineitem").select("l_orderkey")
    exact = keys.distinct().count()
    close = keys.agg(F.approx_count_distinct("l_orderkey", 0.02)).first()[0]
    assert abs(close - exact) <= 3 * 0.02 * exact


# --- progress

STEPS = ["one", "two", "three"]


def progress_rows(spark, rows):
    df = spark.createDataFrame(rows, "user string, step string, done boolean, depth string, at int")
    return step_progress(df, ["user"], "step", F.col("done"), "depth", ["at"], STEPS)


def test_progress(spark):
    states = [("a", "one", True, "beginner", 1), ("a", "three", True, "advanced", 3), ("a", "two", False, "beginner", 2),
              ("b", "one", True, "x", 1), ("b", "two", True, "y", 2), ("b", "three", True, "z", 0),
              ("c", "elsewhere", True, "x", 1)]
    found = progress_rows(spark, states)
    assert values(found, "user", "current_step", "current_index", "steps_completed", "depth", "updated_at") == [
        ("a", "two", 1, 2, "advanced", 3), ("b", "three", 2, 3, "y", 2), ("c", "one", 0, 1, "x", 1)]
    everyone = spark.createDataFrame([("a",), ("d",)], "user string")
    assert values(with_not_started(everyone, found, "user"), "user", "started", "current_step") == [
        ("a", True, "two"), ("d", False, None)]


def test_accuracy(spark):
    df = spark.createDataFrame([("a", "pass"), ("a", "fail"), ("a", "hint"), ("b", "fail")], "u string, r string")
    found = accuracy(df, ["u"], F.col("r") == "pass", F.col("r") == "hint")
    assert values(found, "u", "attempts", "passes", "hints", "accuracy") == [("a", 3, 1, 1, 1 / 3), ("b", 1, 0, 0, 0.0)]


def test_depth_filter(spark):
    df = spark.createDataFrame([Row(n=1, depth="all"), Row(n=2, depth="beginner"), Row(n=3, depth="advanced")])
    assert values(at_depth(df, "beginner"), "n") == [(1,), (2,)]
