"""Class counts, order of indexes, weights, filters and splits."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.hashing import sample_fraction, with_random_split, with_split
from sluice.operators import classes
from tests.plans import plan_of


def test_index_order_breaks_ties_by_text(spark):
    frame = spark.createDataFrame([(v,) for v in "ccba"], "v string")
    found = {r.v: r["index"] for r in classes.label_index(frame, "v").frame.collect()}
    assert found == {"c": 0, "a": 1, "b": 2}


def test_weights_add_up_to_the_rows(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    side = classes.label_index(events, "event_type")
    total = classes.attach_class_weight(events, "event_type", side).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(events.count())


def test_one_class_weighs_one(spark):
    frame = spark.createDataFrame([("a",)] * 5, "v string")
    assert [r.weight for r in classes.label_index(frame, "v").frame.collect()] == [1.0]
    assert [r.weight for r in classes.class_weights(frame, "v").collect()] == [1.0]


def test_unknown_and_null_labels_weigh_one(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    side = classes.label_index(frame, "v")
    other = spark.createDataFrame([("z",), (None,)], "v string")
    out = classes.attach_class_weight(other, "v", side).collect()
    assert [r.weight for r in out] == [1.0, 1.0]


def test_rare_filter_drops_null_labels(spark):
    frame = spark.createDataFrame([("a",)] * 3 + [(None,)] * 9 + [("b",)], "v string")
    assert classes.filter_rare_classes(frame, "v", 2).count() == 3


def test_long_list_filter_equals_short(spark):
    frame = spark.range(5000).withColumn("v", F.col("id").cast("string"))
    kept = [str(i) for i in range(0, 5000, 2)]
    assert classes.filter_isin(frame, "v", kept).count() == 2500
    assert classes.filter_isin(frame, "v", kept[:3]).count() == 3


def test_counts_scan_once_and_prune(spark, folder):
    counts = classes.class_counts(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_returnflag")
    plan = plan_of(counts)
    assert "ReadSchema: struct<l_returnflag:string>" in plan
    assert plan.count("Exchange") == 1 or "AdaptiveSparkPlan" in plan


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_splits_cover_and_ignore_partitioning(spark, folder, parts):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey")
    whole = {r.o_orderkey: r.split for r in with_split(orders, "o_orderkey").collect()}
    moved = with_split(orders.repartition(parts), "o_orderkey")
    assert {r.o_orderkey: r.split for r in moved.collect()} == whole
    assert len(whole) == orders.count() and set(whole.values()) == {"train", "val", "test"}
    share = sum(v == "train" for v in whole.values()) / len(whole)
    assert share == pytest.approx(0.7, abs=0.04)


def test_fractions_must_add_up(spark):
    with pytest.raises(ValueError):
        with_split(spark.range(3), "id", {"a": 0.5, "b": 0.4})


def test_random_splits_cover(spark):
    frame = spark.range(5000)
    counts = {r.split: r.n for r in classes.split_counts(with_random_split(frame)).collect()}
    assert sum(counts.values()) == 5000
    assert counts["train"] == pytest.approx(3500, abs=200)


def test_sample_edges(spark):
    frame = spark.range(2000)
    assert sample_fraction(frame, "id", 0.0).count() == 0
    assert sample_fraction(frame, "id", 1.0).count() == 2000
    quarter = sample_fraction(frame, "id", 0.25).count()
    assert quarter == pytest.approx(500, abs=80)


def test_decode_is_the_inverse_of_the_index(spark):
    frame = spark.createDataFrame([(v,) for v in "ccbazz"], "v string")
    side = classes.label_index(frame, "v")
    indexed = spark.createDataFrame([(float(i),) for i in range(5)], "i double")
    names = [r.name for r in classes.decode_labels(indexed, "i", side, "name").orderBy("i").collect()]
    assert names == ["c", "z", "a", "b", None]


def test_empty_table_has_no_classes(spark):
    empty = spark.createDataFrame([], "v string")
    assert classes.class_weights(empty, "v").count() == 0
    assert classes.filter_rare_classes(empty, "v", 1).count() == 0
    assert classes.attach_class_weight(empty, "v", classes.label_index(empty, "v")).count() == 0


def test_existing_column_is_not_overwritten(spark):
    frame = spark.createDataFrame([("a", 1.0)], "v string, weight double")
    with pytest.raises(ValueError, match="already"):
        classes.attach_class_weight(frame, "v", classes.label_index(frame, "v"))


def test_lists_of_any_length_behave_alike(spark):
    frame = spark.range(3000).select("id")
    for count in (2, 999, 1000, 1001, 1500):
        assert classes.filter_isin(frame, "id", [str(i) for i in range(count)]).count() == count
        assert classes.filter_isin(frame, "id", list(range(count))).count() == count
    table = spark.range(1500).select(F.col("id").alias("kept"))
    assert classes.filter_isin(frame, "id", table).count() == 1500
