from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.sources import readers, writers
from smelter.functions.nested import flatten_unknown_json, infer_json_schema
from smelter.operators import sketches
from smelter.sources.incremental import list_files, new_files, note_files, read_unseen, rows_since, rows_since_with_overlap
from smelter.sources.snapshots import evolve, rows_as_of, snapshot_rows, with_bucket

USERS = "user_id,name,age\nu1,Ann,31\nu2,Bo,unknown\n"
USER_SCHEMA = T.StructType([T.StructField("user_id", T.StringType(), nullable=False),
                            T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("u1", "Ann", 31), ("u2", "Bo", None), ("u3", "Cy", 7)], USER_SCHEMA)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "o.csv").write_text("order_id,price,quantity\n1,9.5,2\n2,1.25,3\n")
    assert dict(readers.read_csv_inferred(spark, str(tmp_path)).dtypes) == {
        "order_id": "int", "price": "double", "quantity": "int"}


def test_csv_typed_nulls_what_does_not_fit(spark, tmp_path):
    (tmp_path / "u.csv").write_text(USERS)
    rows = readers.read_csv(spark, str(tmp_path), USER_SCHEMA).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [("u1", "Ann", 31), ("u2", "Bo", None)]


def test_json_bronze(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"event_id": 1, "action": "buy"}\nbroken\n')
    events = readers.with_lineage(readers.read_json(spark, str(tmp_path), "event_id bigint, action string"))
    rows = events.orderBy("event_id").collect()
    assert [(r.event_id, r.action) for r in rows] == [(None, None), (1, "buy")]
    assert all(r._ingested_at is not None and r._source_file.endswith("e.json") for r in rows)


def test_lineage_survives_a_shuffle(spark, tmp_path):
    (tmp_path / "u.csv").write_text(USERS)
    scan = readers.with_lineage(readers.read_csv(spark, str(tmp_path), USER_SCHEMA))
    files = scan.repartition(4, "user_id").select("_source_file").distinct().collect()
    assert [r[0].endswith("u.csv") for r in files] == [True]


@pytest.mark.parametrize("fmt, options", [
    ("csv", {"header": True}), ("json", {}), ("parquet", {}), ("orc", {}), ("xml", {"rowTag": "row"})])
def test_formats(spark, people, tmp_path, fmt, options):
    path = str(tmp_path / fmt)
    people.write.format(fmt).options(**options).save(path)
    back = readers.read_any(spark, fmt, path, USER_SCHEMA, **options).select("user_id", "name", "age")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, people.collect()), key=str)


def test_text_format(spark, people, tmp_path):
    people.select("name").write.text(str(tmp_path / "t"))
    assert {r.value for r in readers.read_any(spark, "text", str(tmp_path / "t")).collect()} == {"Ann", "Bo", "Cy"}


def test_write_modes(spark, people, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(people, path)
    with pytest.raises(AnalysisException):
        writers.write_parquet(people, path)
    writers.write_parquet(people, path, "ignore")
    assert spark.read.parquet(path).count() == 3
    writers.write_parquet(people, path, "append")
    assert spark.read.parquet(path).count() == 6
    writers.write_parquet(people.limit(1), path, "overwrite")
    assert spark.read.parquet(path).count() == 1


def test_partitioned_layout(spark, people, tmp_path):
    path = str(tmp_path / "p")
    writers.write_by_partition(people, path, ["name"])
    one = spark.read.parquet(path).filter("name = 'Ann'")
    assert "PartitionFilters: [isnotnull(name" in plan(one)
    assert one.count() == 1
    assert len(list((tmp_path / "p" / "name=Ann").glob("*.parquet"))) == 1


def test_replace_partitions_leaves_others(spark, people, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(people, path, partition_by=["name"])
    writers.replace_partitions(people.filter("name = 'Ann'").withColumn("age", F.lit(99)), path, ["name"])
    assert {(r.name, r.age) for r in spark.read.parquet(path).collect()} == {("Ann", 99), ("Bo", None), ("Cy", 7)}


def test_bucketed_tables_join_without_shuffle(spark, people):
    writers.save_bucketed(people, "people_a", ["user_id"], 4)
    writers.save_bucketed(people.select("user_id", F.col("age").alias("years")), "people_b", ["user_id"], 4)
    joined = spark.table("people_a").hint("merge").join(spark.table("people_b"), "user_id")
    assert joined.count() == 3
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_insert_into(spark, people):
    people.write.mode("overwrite").saveAsTable("people_t")
    writers.append_to_table(people.select("age", "name", "user_id"), "people_t")
    assert spark.table("people_t").count() == 6
    assert spark.table("people_t").filter("user_id = 'u1'").select("age").distinct().first()[0] == 31


def test_repartition_before_write(spark, tmp_path):
    spark.range(100).repartition(5).write.parquet(str(tmp_path / "five"))
    spark.range(100).repartition(5).coalesce(2).write.parquet(str(tmp_path / "two"))
    assert len(list((tmp_path / "five").glob("*.parquet"))) == 5
    assert len(list((tmp_path / "two").glob("*.parquet"))) == 2


def test_row_and_partition_ids(spark):
    rows = spark.range(0, 1000, 1, 4).select(
        "id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part"),
        F.xxhash64("id").alias("stable"))
    assert rows.select("row").distinct().count() == rows.select("stable").distinct().count() == 1000
    assert {r["count"] for r in rows.groupBy("part").count().collect()} == {250}


def test_csv_and_json_text_columns(spark):
    df = spark.createDataFrame([("1,a", '{"k": 5}')], ["line", "doc"])
    row = df.select(F.from_csv("line", "n int, s string").alias("c"), F.schema_of_csv(F.lit("1,a")).alias("sc"),
                    F.schema_of_json(F.lit('{"k": 5}')).alias("sj"), F.json_tuple("doc", "k").alias("k")).first()
    assert (row.c.n, row.c.s, row.sc, row.sj, row.k) == (
        1, "a", "STRUCT<_c0: INT, _c1: STRING>", "STRUCT<k: BIGINT>", "5")


def test_unseen_files_only(spark, tmp_path):
    source, ledger = tmp_path / "in", str(tmp_path / "ledger")
    source.mkdir()
    (source / "a.csv").write_text(USERS)
    old = dt.datetime.now().timestamp() - 86_400

    def unseen(overlap="1 hour"):
        return read_unseen(spark, str(source), ledger, lambda reader, path: reader.schema(USER_SCHEMA).csv(path, header=True), "*.csv", overlap)

    os.utime(source / "a.csv", (old, old))
    first = unseen()
    n = first.count()
    assert n == len(USERS.splitlines()) - 1
    first.write.parquet(str(tmp_path / "bronze"))
    note_files(spark.read.parquet(str(tmp_path / "bronze")), ledger)
    listed = spark.read.parquet(ledger).collect()
    assert [(r._source_file.endswith("in/a.csv"), r.n_rows) for r in listed] == [(True, n)]
    assert unseen().count() == 0
    (source / "b.csv").write_text("user_id,name,age\nu9,Di,4\n")
    # As old as the first file: told from it by the ledger, within the overlap; older files are not looked for.
    (source / "c.csv").write_text("user_id,name,age\nu8,Ed,5\n")
    os.utime(source / "c.csv", (old, old))
    (source / "d.csv").write_text("user_id,name,age\nu7,Flo,6\n")
    os.utime(source / "d.csv", (old - 7200, old - 7200))
    assert sorted(r.user_id for r in unseen().collect()) == ["u8", "u9"]
    assert sorted(r.user_id for r in unseen("3 hours").collect()) == ["u7", "u8", "u9"]
    note_files(unseen(), ledger)
    assert unseen().count() == 0 and spark.read.parquet(ledger).count() == 3
    assert new_files(list_files(spark, str(source)), spark.read.parquet(ledger)).count() == 1
    assert "content" not in list_files(spark, str(source)).columns


def test_unknown_json(spark):
    texts = ['{"k": 1, "a b": [1, 2], "c": {"d": null, "e": "OBJECT<VOID>"}}', '{"k": 2.5, "OBJECT<x": true, "v": 1}', "no json", None,
             '{"v": "text"}', "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    schema = infer_json_schema(df, "doc")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["a b"] == "array<bigint>" and kinds["c"] == "struct<d:string,e:string>" and kinds["OBJECT<x"] == "boolean"
    assert kinds["k"].startswith("decimal") and kinds["v"] == "variant"
    rows = {r.id: r for r in flatten_unknown_json(df.filter("id <> 4"), "doc", "ok").collect()}
    assert rows[0]["a b"] == [1, 2] and rows[0].c.e == "OBJECT<VOID>" and float(rows[1].k) == 2.5 and rows[1]["OBJECT<x"]
    assert [rows[i].ok for i in (0, 1, 2, 3, 5)] == [True, True, False, False, False]
    for bad in ("[1]", "3", "no json", None):
        with pytest.raises(ValueError):
            infer_json_schema(spark.createDataFrame([(bad,)], "doc string"), "doc")


def test_sketches_merge(spark):
    rows = spark.range(40_000).select((F.col("id") % 10).alias("day"), F.pmod(F.xxhash64("id"), F.lit(5000)).alias("user"))
    daily = sketches.distinct_sketches(rows.unionByName(spark.range(3).select(F.col("id").alias("day"), F.lit(None).cast("bigint").alias("user"))), ["day"], "user")
    whole = sketches.merged_sketches(daily.withColumn("all", F.lit(1)), ["all"]).select(sketches.estimate("sketch")).first()[0]
    exact = rows.select("user").distinct().count()
    assert abs(whole - exact) <= sketches.error_bound() * exact
    again = sketches.merged_sketches(daily.unionByName(daily).withColumn("all", F.lit(1)), ["all"]).select(sketches.estimate("sketch")).first()[0]
    assert again == whole and daily.count() == 10


def test_quantiles_and_their_ranks(spark):
    df = spark.range(5000).select(F.when(F.col("id") > 9, F.col("id")).alias("a"), F.lit(None).cast("int").alias("none"), F.lit(7).alias("same"))
    for accuracy in (20, 10_000):
        profile = sketches.quantile_profile(df, ["a", "none", "same"], [0.0, 0.5, 1.0], accuracy)
        found = {(r.column_name, r["quantile"]): r for r in sketches.rank_errors(df, profile).collect()}
        assert all(r.rank_error <= 1 / accuracy for k, r in found.items() if k[0] != "none")
        assert found["none", 0.5].value is None and found["none", 0.5].n == 0 and found["same", 0.5].value == 7.0
        assert found["a", 0.5].n == 4990
    wrong = spark.createDataFrame([("a", 0.5, 10.0, 4990)], profile.schema)
    assert sketches.rank_errors(df, wrong).first().rank_error > 0.4


def test_rows_since(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in range(6)]
    source = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "id int, ts timestamp")
    target = source.filter("id IN (0, 1, 3)")
    assert [r.id for r in rows_since(source, target, "ts").orderBy("id").collect()] == [4, 5]
    late = rows_since_with_overlap(source, target, "ts", ["id"], "90 minutes")
    assert [r.id for r in late.orderBy("id").collect()] == [2, 4, 5]
    untimed = source.unionByName(spark.createDataFrame([(8, None), (9, None)], "id int, ts timestamp"))
    assert [r.id for r in rows_since(untimed, target, "ts").orderBy("id").collect()] == [4, 5]
    assert [r.id for r in rows_since(untimed, target, "ts", ["id"]).orderBy("id").collect()] == [4, 5, 8, 9]
    some = target.unionByName(untimed.filter("id = 8"))
    assert [r.id for r in rows_since(untimed, some, "ts", ["id"]).orderBy("id").collect()] == [4, 5, 9]
    assert [r.id for r in rows_since_with_overlap(untimed, some, "ts", ["id"], "90 minutes").orderBy("id").collect()] == [2, 4, 5, 9]
    empty = source.filter("id < 0")
    assert rows_since(source, empty, "ts").count() == 6
    assert rows_since_with_overlap(source, empty, "ts", ["id"], "1 hour").count() == 6


DAYS = [dt.datetime(2026, 1, d) for d in (1, 2, 3, 4)]


@pytest.fixture
def snapshots(spark, people, tmp_path):
    """Two appends of growing width, then a replacement in which a column has another type, and their log."""
    path = str(tmp_path / "t")
    parts = [people.filter("user_id = 'u1'").select("user_id"), people.filter("user_id = 'u2'").select("user_id", "age"),
             people.filter("user_id = 'u3'").select("user_id", F.lit("old").alias("age")), people.limit(0).select("user_id")]
    for number, rows in enumerate(parts, 1):
        rows.write.parquet(f"{path}/_snapshot_id={number}")
    log = spark.createDataFrame([(n, base, at) for n, (base, at) in enumerate(zip((1, 1, 3, 3), DAYS), 1)],
                                "snapshot_id bigint, base_id bigint, committed_at timestamp")
    return path, log


def test_snapshots(spark, snapshots):
    found = {n: snapshot_rows(spark, *snapshots, n) for n in (1, 2, 3, 4)}
    assert {n: sorted(r.user_id for r in df.collect()) for n, df in found.items()} == {
        1: ["u1"], 2: ["u1", "u2"], 3: ["u3"], 4: ["u3"]}
    assert [df.columns for df in found.values()] == [["user_id"], ["user_id", "age"], ["user_id", "age"], ["user_id", "age"]]
    assert dict(found[2].dtypes)["age"] == "int" and dict(found[3].dtypes)["age"] == "string"
    assert rows_as_of(spark, *snapshots, dt.datetime(2026, 1, 2, 12)).count() == 2
    with pytest.raises(ValueError):
        rows_as_of(spark, *snapshots, dt.datetime(2025, 1, 1))
    with pytest.raises(ValueError):
        snapshot_rows(spark, *snapshots, 9)


def test_schema_evolution(spark, snapshots):
    rows = evolve(snapshot_rows(spark, *snapshots, 2), {"user_id": "id"}).orderBy("id").collect()
    assert [r.id for r in rows] == ["u1", "u2"] and rows[0].age is None
    assert evolve(snapshot_rows(spark, *snapshots, 2), dropped=("age",)).columns == ["user_id"]


def test_hash_buckets(spark, people, tmp_path):
    bucketed = with_bucket(people, "user_id", 16)
    assert bucketed.filter("_bucket < 0 OR _bucket > 15").count() == 0
    bucketed.write.partitionBy("_bucket").parquet(str(tmp_path / "b"))
    bucket = bucketed.filter("user_id = 'u1'").first()._bucket
    found = spark.read.parquet(str(tmp_path / "b")).filter((F.col("_bucket") == bucket) & (F.col("user_id") == "u1"))
    assert found.count() == 1 and "PartitionFilters: [isnotnull(_bucket" in plan(found)
