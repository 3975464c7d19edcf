"""Side tables beyond the broadcast bounds give the same rows as small ones."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import classes, features
from sluice.operators.lookup import frequent_keys, join_side, rank_in_order, settle
from tests.plans import plan_of


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some are null, the others have long tails of ties."""
    value = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 701).cast("string")))
    )
    frame = spark.range(0, 9000, 1, 7).select("id", value.alias("v"))
    return frame.persist()


def rows(df):
    return sorted(map(str, df.collect()))


def test_large_label_index_equals_small(skewed):
    small = classes.label_index(skewed, "v")
    large = classes.label_index(skewed, "v", max_rows=0)
    assert small.small and not large.small
    columns = ["v", "n", "index"]
    assert rows(small.frame.select(columns)) == rows(large.frame.select(columns))
    assert sorted(r["index"] for r in large.frame.collect()) == list(range(large.rows))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join_equals_broadcast(skewed, how):
    small = classes.label_index(skewed, "v")
    large = classes.label_index(skewed, "v", max_rows=0)
    values = {} if how == "left_semi" else {"i": "index", "w": "weight"}
    a, b = (join_side(skewed, "v", side, values, how) for side in (small, large))
    assert a.columns == b.columns
    assert rows(a.select(*a.columns)) == rows(b)
    expected = skewed.count() if how == "left" else skewed.filter("v is not null").count()
    assert b.count() == expected


def without_adaptive(spark):
    """A session that neither splits skewed partitions nor broadcasts by itself."""
    from contextlib import contextmanager

    @contextmanager
    def block():
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            yield
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    return block()


@pytest.mark.parametrize("known", [True, False])
@pytest.mark.parametrize("length", [1, 10_000])
def test_keys_hot_in_the_new_table_only_are_spread(spark, known, length):
    """Frequent now, but rare or unseen when the side table was made; keys of any length."""
    hot = F.lit("h" * length)
    old = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    if known:
        old = old.unionAll(spark.range(1).select(hot.alias("v")))
    side = classes.label_index(old, "v", max_rows=0)
    cold = F.concat(F.lit("v"), (F.col("id") % 2000).cast("string"))
    new = spark.range(0, 20_000, 1, 8).select("id", F.when(F.col("id") % 10 > 0, hot).otherwise(cold).alias("v"))
    with without_adaptive(spark):
        joined = join_side(new, "v", side, {"i": "index"}, "left")
        assert joined.filter("i is null").count() == (0 if known else 18_000)
        held = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 20_000 and max(held) <= 2 * 20_000 / 8
        assert join_side(new, "v", side, {}, "left_semi").count() == (20_000 if known else 2000)


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_no_frequent_key_is_missed(spark, parts):
    """Keys just over the bound, among many seen once; nulls do not count."""
    size = 40_000
    kind = F.col("id") % (4 * parts)
    key = (
        F.when(F.col("id") % 17 == 0, F.lit(None))
        .when(kind < 2 * parts, F.concat(F.lit("k"), F.floor(kind / 5).cast("string")))
        .otherwise(F.concat(F.lit("once"), F.col("id").cast("string")))
    )
    df = spark.range(0, size, 1, 13).select(key.alias("v"))
    counts = {r.v: r["count"] for r in df.filter("v is not null").groupBy("v").count().collect()}
    total, found = frequent_keys(df, F.col("v"), parts)
    assert total == sum(counts.values())
    asked = {k for k, n in counts.items() if n * parts >= total}
    assert asked <= {k for k, _ in found} and (parts == 1 or asked)
    assert len(found) <= 2 * parts
    assert all(abs(counts[k] - n) * parts <= total / 4 and counts[k] * parts > total / 2 for k, n in found)


def test_keys_of_an_empty_table(spark):
    assert frequent_keys(spark.createDataFrame([], "v string"), F.col("v"), 8) == (0, [])


def test_side_tables_are_measured_with_their_arrays(spark):
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("v"), F.lit(1).alias("n"), F.array_repeat(F.col("id") * 1.5, 1000).alias("a")
    )
    assert not settle(rows, "v", max_bytes=8 << 20).small
    assert settle(rows.drop("a"), "v", max_bytes=8 << 20).small


def test_hot_rows_are_spread_over_the_partitions(spark, skewed):
    """No partition of the shuffled join gets the hot value's third of the rows."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = classes.label_index(skewed, "v", max_rows=0)
        joined = join_side(skewed, "v", large, {"i": "index"}, "inner")
        hot = joined.filter("v = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) >= 7 and max(r["count"] for r in hot) <= 2 * 3000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_copies_of_one_row_join_whole_and_spread(spark):
    frame = spark.range(0, 40000, 1, 40).select(F.when(F.col("id") % 4 < 3, "a").otherwise("b").alias("v"))
    side = classes.label_index(frame, "v", max_rows=0)
    joined = join_side(frame, "v", side, {"i": "index"})
    out = joined.groupBy("i").count()
    assert {r.i: r["count"] for r in out.collect()} == {0: 30000, 1: 10000}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_side(frame, "v", side, {"i": "index"})
        held = joined.filter("i = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(held) >= 6 and max(r["count"] for r in held) < 15000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_in_order_matches_sorting(skewed):
    counts = classes.class_counts(skewed.filter("v is not null"), "v")
    ranked = rank_in_order(counts, [F.desc("n"), F.asc("v")], "i").collect()
    expected = sorted(((-r.n, r.v) for r in ranked))
    assert [(-r.n, r.v) for r in sorted(ranked, key=lambda r: r.i)] == expected


def test_category_tables_large_equals_small(skewed):
    two = skewed.withColumn("w", F.when(F.col("id") % 11 != 0, F.substring("v", 1, 2)))
    small = features.category_tables(two, ["v", "w"])
    large = features.category_tables(two, ["v", "w"], max_rows=0)
    for name in small:
        assert not large[name].small
        columns = ["value", "n", "used", "index"]
        assert rows(small[name].frame.select(columns)) == rows(large[name].frame.select(columns))
    a, b = (features.index_categories(two, t) for t in (small, large))
    assert rows(a.select(a.columns)) == rows(b.select(a.columns))


def test_rare_filter_large_equals_small(skewed):
    a = classes.filter_rare_classes(skewed, "v", 9)
    b = classes.filter_rare_classes(skewed, "v", 9, max_rows=0)
    assert rows(a) == rows(b) and a.count() > 3000


def test_small_side_is_broadcast_without_shuffle(skewed):
    side = classes.label_index(skewed, "v")
    plan = plan_of(join_side(skewed, "v", side, {"i": "index"}))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_bytes_bound_counts(skewed):
    counts = classes.class_counts(skewed, "v")
    assert not settle(counts, "v", max_bytes=100).small


def test_empty_side(spark):
    empty = spark.createDataFrame([], "v string")
    side = classes.label_index(empty, "v")
    assert side.rows == 0 and side.total == 0
    assert join_side(empty, "v", side, {"i": "index"}, "left").count() == 0
