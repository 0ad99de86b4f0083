"""Replacing tables in one step, and ids that stay."""

import pytest
from pyspark.sql import functions as F

from sparkplate.operators.ids import encode_ids, extend_ids
from sparkplate.sources import catalog as K


@pytest.fixture(scope="module")
def ns(spark):
    K.ensure_namespace(spark, "replace_check")
    return "replace_check"


def numbers(spark, n, col="x"):
    return spark.range(0, n, 1, 4).select(F.col("id").alias(col))


def test_a_failed_write_leaves_the_old_rows(spark, ns):
    name = f"{ns}.halfway"
    K.write_table(numbers(spark, 10), name)
    stored = K.versions(spark, name)
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("y"))
    with pytest.raises(Exception, match="broken row"):
        K.write_table(broken, name)
    assert K.read_table(spark, name).count() == 10
    assert K.read_table(spark, name).columns == ["x"]
    assert K.versions(spark, name) == stored


def test_a_reader_of_the_old_version_can_finish(spark, ns):
    name = f"{ns}.readers"
    K.write_table(numbers(spark, 10), name)
    reader = K.read_table(spark, name)
    K.write_table(numbers(spark, 20, "other"), name)
    assert reader.count() == 10  # planned before the switch
    assert K.read_table(spark, name).count() == 20 and K.read_table(spark, name).columns == ["other"]
    for n in (30, 40, 50):
        K.write_table(numbers(spark, n), name)
    assert K.read_table(spark, name).count() == 50
    assert len(K.versions(spark, name)) == 2  # the present one and the one before


def test_a_table_may_be_replaced_from_itself(spark, ns):
    name = f"{ns}.itself"
    K.write_table(numbers(spark, 10), name)
    K.write_table(K.read_table(spark, name).where("x >= 4"), name)
    assert K.read_table(spark, name).count() == 6


def test_plain_tables_become_the_first_version(spark, ns):
    name = f"{ns}.plain"
    numbers(spark, 5).write.saveAsTable(name)
    K.write_table(numbers(spark, 7), name)
    assert K.read_table(spark, name).count() == 7 and len(K.versions(spark, name)) == 2


def test_names_partitions_and_pushdown(spark, ns):
    name = f"{ns}.parts"
    K.write_table(numbers(spark, 10).withColumn("p", F.col("x") % 3), name, partition_by="p")
    K.write_table(numbers(spark, 10), f"{ns}.parts__v2")  # not a version of parts
    listed = [r.tableName for r in K.list_tables(spark, ns).collect()]
    assert "parts" in listed and "parts__v2" in listed and not any("__v0" in t or "__v1" in t for t in listed)
    plan = K.read_table(spark, name).where("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def test_ids_stay_when_keys_arrive(spark):
    first = encode_ids(frame(spark, ["m", "c", "x", "c"]), "k", "id")
    assert {tuple(r) for r in first.collect()} == {("c", 1), ("m", 2), ("x", 3)}
    second = extend_ids(first, frame(spark, ["a", "x", "z", "a", None]), "k", "id")
    assert {tuple(r) for r in second.collect()} == {("c", 1), ("m", 2), ("x", 3), (None, 4), ("a", 5), ("z", 6)}
    third = extend_ids(second, frame(spark, [None, "b", "m"]), "k", "id")
    assert third.count() == 7 and {tuple(r) for r in third.exceptAll(second).collect()} == {("b", 7)}
    assert third.dtypes == [("k", "string"), ("id", "int")]


def test_ids_over_an_empty_dictionary_and_no_new_keys(spark):
    keys = frame(spark, [f"k{i % 97}" for i in range(5000)])
    none = spark.createDataFrame([], "k string, id int")
    first = extend_ids(none, keys, "k", "id")
    assert first.exceptAll(encode_ids(keys, "k", "id")).count() == 0 and first.count() == 97
    assert extend_ids(first, keys, "k", "id").exceptAll(first).count() == 0


def test_metrics_of_a_write_need_no_further_scan(spark, ns):
    """Counts taken while writing equal those of the checks afterwards; the source is read once."""
    from sparkplate.operators import quality as Q

    reads = spark.sparkContext.accumulator(0)
    source = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("k"))
    counted = source.mapInArrow(lambda batches: ((reads.add(b.num_rows), b)[1] for b in batches), "k bigint")
    seen = K.write_table(counted, f"{ns}.observed", observe={"rows": F.count(F.lit(1)), "nulls": F.count_if(F.col("k").isNull())})
    assert reads.value == 1000
    stored = K.read_table(spark, f"{ns}.observed")
    assert seen == {"rows": Q.row_count(stored).first()[0], "nulls": Q.check_not_null(stored, "k").count()} == {"rows": 1000, "nulls": 100}
    assert K.write_table(source, f"{ns}.observed") == {}


def test_session_views_are_in_no_namespace(spark, ns):
    K.publish_view(spark, numbers(spark, 3), "elsewhere.shown")
    assert "elsewhere_shown" not in {r.tableName for r in K.list_tables(spark, ns).collect()}
