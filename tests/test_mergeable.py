"""Fits from merged parts against one fit of all rows."""

import pytest
from pyspark.sql import functions as F

from sluice.plans.mergeable import FitPart
from sluice.plans.preprocess import FlowPreprocessor


@pytest.fixture(scope="module")
def rows(spark):
    ids = F.col("id")
    kind = F.when(ids % 10 < 5, "a").when(ids % 10 < 8, "b").when(ids % 100 == 99, "rare").otherwise("c")
    return spark.range(0, 2000, 1, 4).select(
        ids.alias("key"),
        F.when(ids % 97 != 0, kind).alias("Attack"),
        (1e6 + F.sin(ids)).cast("string").alias("x"),
        F.when(ids % 53 == 0, "bad").otherwise((ids % 7).cast("string")).alias("y"),
        F.when(ids % 31 != 0, F.concat(F.lit("v"), ids % 13)).alias("proto"),
        F.concat(F.lit("s"), F.floor(F.sqrt(ids))).alias("state"),
    ).persist()


def facts(fitted):
    tables = {"label": fitted.labels, **fitted.categories}
    found = {name: {r.value: (r["index"], r.n) for r in side.frame.collect()} for name, side in tables.items()}
    return found, fitted.stds, {r.value: r.weight for r in fitted.labels.frame.collect()}


def same(a, b):
    assert a[0] == b[0]
    assert a[1] == pytest.approx(b[1], rel=1e-9) and a[2] == pytest.approx(b[2], rel=1e-12)


@pytest.mark.parametrize("invalid", ["skip", "keep"])
@pytest.mark.parametrize("count", [1, 2, 5])
def test_merged_parts_equal_one_fit(rows, count, invalid):
    settings = FlowPreprocessor(numeric=["x", "y"], min_class_rows=15, key="key", invalid=invalid)
    # One part has a class of its own and no row of another; rare classes are rare in each.
    place = F.when(F.col("Attack") == "c", 0).otherwise(F.pmod(F.xxhash64("key"), F.lit(count)))
    parts = [FitPart.measure(settings, rows.filter(place == i)) for i in range(count)]
    whole = settings.fit(rows)
    assert set(facts(whole)[0]["label"]) == {"a", "b", "c", "rare"}
    same(facts(parts[0].merge(*parts[1:]).fit()), facts(whole))


def test_rows_that_come_later(spark, rows, tmp_path, monkeypatch):
    """A saved part takes in new rows, of which classes can become frequent enough."""
    settings = FlowPreprocessor(numeric=["x", "y"], min_class_rows=15, key="key", invalid="skip")
    early, late = rows.filter("key < 1000"), rows.filter("key >= 1000")
    FitPart.measure(settings, early).save(str(tmp_path / "part"))
    held = FitPart.load(spark, str(tmp_path / "part"))
    assert "rare" not in facts(held.fit())[0]["label"]
    same(facts(held.merge(FitPart.measure(settings, late)).fit()), facts(settings.fit(rows)))
    nothing = FitPart.measure(settings, rows.filter("key < 0"))
    same(facts(held.merge(nothing).fit()), facts(settings.fit(early)))


def test_merging_is_associative(rows):
    settings = FlowPreprocessor(numeric=["x", "y"], min_class_rows=1, key="key", invalid="skip")
    a, b, c = (FitPart.measure(settings, rows.filter(F.col("key") % 3 == i)) for i in range(3))
    same(facts(a.merge(b).merge(c).fit()), facts(a.merge(b.merge(c)).fit()))


@pytest.mark.parametrize("columns", [["key", "Attack", "x"], ["key", "Attack", "proto"]])
def test_tables_without_categories_or_numbers(rows, columns):
    settings = FlowPreprocessor(numeric=["x"], min_class_rows=1, key="key", invalid="skip")
    some = rows.select(*columns)
    parts = [FitPart.measure(settings, some.filter(F.col("key") % 2 == i)) for i in range(2)]
    same(facts(parts[0].merge(parts[1]).fit()), facts(settings.fit(some)))


def test_bad_values_stop_the_fit_and_parts_must_fit_together(spark, rows, tmp_path):
    settings = FlowPreprocessor(numeric=["x", "y"], min_class_rows=1, key="key")
    part = FitPart.measure(settings, rows)
    with pytest.raises(ValueError, match="null, NaN or infinite"):
        part.fit()
    with pytest.raises(ValueError, match="do not merge"):
        part.merge(FitPart.measure(settings, rows.drop("proto")))
    with pytest.raises(ValueError, match="no label"):
        FitPart.measure(settings, rows.drop("Attack"))
    with pytest.raises(ValueError, match="holds no part"):
        FitPart.load(spark, str(tmp_path / "none"))
