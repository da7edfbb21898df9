"""The bucketed read model: what an upsert leaves, what a failed one leaves, and what is shuffled."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.joins import not_exists
from tidemark.operators.aggregates import duplicate_keys
from tidemark.plans.refresh import refresh_read_model
from tidemark.sources.bucketed_model import BucketedModel


@pytest.fixture
def model(spark, frame, tmp_path):
    base = f"model_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{tmp_path}/{base}'")
    made = BucketedModel(spark, f"{base}.rows", "k", frame([], "k string, v int").schema, buckets=8)
    yield made
    spark.sql(f"DROP DATABASE {base} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, model):
    return spark.table(model.table).select(F.input_file_name()).distinct().count()


def test_upsert_replaces_keys(model, frame):
    model.create(frame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5), (None, 5)], "k string, v int"))
    fresh = frame([("b", 7), ("d", 8), ("d", 8)], "k string, v int")
    for _ in range(2):  # repeating changes nothing
        model.upsert(fresh, frame([("b",), ("c",), ("nowhere",), (None,)], "id string"))
        assert rows(model.read()) == [("a", 1), ("b", 7), ("d", 8), ("d", 8), (None, 5), (None, 5)]
    assert rows(model.keyed()) == [("a", 1), ("b", 7), ("d", 8), ("d", 8)]


def test_a_bucket_may_lose_its_last_row(model, frame):
    model.create(frame([("a", 1)], "k string, v int"))
    model.upsert(frame([], "k string, v int"), frame([("a",)], "id string"))
    assert rows(model.read()) == []
    model.upsert(frame([("a", 2)], "k string, v int"), frame([], "id string"))
    model.upsert(frame([], "k string, v int"), frame([], "id string"))
    assert rows(model.read()) == [("a", 2)]


def test_empty_and_replaced_tables(model, frame):
    model.create(frame([], "k string, v int"))
    assert rows(model.read()) == []
    model.create(frame([(str(i), i) for i in range(50)], "k string, v int"))
    model.create(frame([("z", 0)], "k string, v int"))
    assert rows(model.read()) == [("z", 0)]


def test_a_model_of_its_own_rows(model, frame):
    model.create(frame([(str(i % 7), i) for i in range(50)], "k string, v int"))
    before = rows(model.read())
    model.create(model.read())
    model.upsert(model.keyed().where("k = '3'"), frame([("3",)], "id string"))
    assert rows(model.read()) == before


def test_a_failed_write_changes_nothing(spark, model, frame):
    model.create(frame([("a", 1), ("b", 2)], "k string, v int"))
    with pytest.raises(PySparkException):
        model.upsert(frame([(None, 3)], "k string, v int"), frame([("a",)], "id string"))
    # A write that ended before its version was set: its partitions are there, but nobody reads them.
    version = model._begin()
    model._write(frame([("a", 9), ("new", 9)], "k string, v int"), version)
    assert rows(model.read()) == [("a", 1), ("b", 2)]
    model.upsert(frame([("b", 5)], "k string, v int"), frame([], "id string"))
    assert rows(model.read()) == [("a", 1), ("b", 5)]
    assert rows(spark.table(model.table).where("v = 9")) == []


def test_readers_keep_their_rows_and_old_files_go(spark, model, frame):
    model.create(frame([(str(i), 0) for i in range(100)], "k string, v int"))
    first = model.read()
    for v in range(1, 6):
        model.upsert(frame([(str(i), v) for i in range(100)], "k string, v int"), frame([], "id string"))
        if v == 1:
            assert {r.v for r in first.collect()} == {0}
    assert rows(model.read()) == sorted([(str(i), 5) for i in range(100)], key=str)
    # The live files and those of the version before.
    assert files(spark, model) <= 2 * 8
    assert {r.v for r in spark.table(model.table).select("v").distinct().collect()} == {4, 5}


def test_only_touched_buckets_are_written(spark, model, frame):
    model.create(frame([(str(i), 0) for i in range(200)], "k string, v int"))
    before = set(model._live().values())
    model.upsert(frame([("3", 1)], "k string, v int"), frame([], "id string"))
    assert len(before - set(model._live().values())) == 1


def test_other_number_of_buckets_is_an_error(spark, model, frame):
    model.create(frame([("a", 1)], "k string, v int"))
    with pytest.raises(ValueError, match="8 buckets"):
        BucketedModel(spark, model.table, "k", model.schema, buckets=9).create(model.read())


def test_names_that_need_quotes(spark, frame, model):
    given = frame([("a", 1), ("b", 2)], "`the key` string, `a.b` int")
    other = BucketedModel(spark, f"{model.table}_2", "the key", given.schema, buckets=4)
    other.create(given)
    other.upsert(given.where("`the key` = 'a'").selectExpr("`the key`", "3 AS `a.b`"), frame([], "id string"))
    assert rows(other.read()) == [("a", 3), ("b", 2)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_by_key_do_not_shuffle_the_model(spark, model, frame, no_broadcast):
    model.create(frame([(str(i), i) for i in range(100)] + [(None, 1)], "k string, v int"))
    assert "Exchange" not in plan(duplicate_keys(model.read(), "k"))
    assert "Exchange" not in plan(model.read().select("k", "v").distinct())
    given = spark.range(50).selectExpr("CAST(id AS STRING) AS id")
    for df in (
        not_exists(given, "id", model.read(), "k"),
        model.read().join(given, F.col("k") == F.col("id"), "left_anti"),
        model.read().join(given, F.col("k") == F.col("id")),
    ):
        # One side is shuffled, and it is not the model's.
        text = plan(df)
        assert text.count("Exchange hashpartitioning(id") == text.count("Exchange") == 1, text


def test_refresh_into_a_bucketed_model(spark, model, frame):
    model.create(frame([("a", 1), ("b", 2), ("c", 3)], "k string, v int"))
    build = lambda some: some.select("k", F.when(F.col("k") == "c", F.raise_error(F.lit("no")).cast("int")).otherwise(9).alias("v"))
    done = refresh_read_model(frame([("a",), ("c",), ("d",)], "k string"), model, build)
    assert rows(done) == [("a",), ("d",)]
    assert rows(model.read()) == [("a", 9), ("b", 2), ("c", 3), ("d", 9)]
