"""Casts, feature choice, assembling, scaling, and the whole preparation."""

import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sluice.functions import columns as cols
from sluice.operators import features
from sluice.plans.preprocess import FLOW_NUMERIC, FittedPreprocessor, FlowPreprocessor
from sluice.plans.stages import fit_stages


def test_cast_keeps_bad_text_as_null(spark):
    frame = spark.createDataFrame([("",), ("x",), (" 1.5 ",), ("NaN",), ("Infinity",)], "a string")
    out = [r.a for r in cols.cast_numeric(frame, ["a", "b"]).collect()]
    assert out[:3] == [None, None, 1.5] and math.isnan(out[3]) and out[4] == math.inf


def test_flow_columns():
    assert len(FLOW_NUMERIC) == 35 == len(set(FLOW_NUMERIC))


def test_feature_choice_leaves_bigint_out(spark):
    frame = spark.createDataFrame([], "a int, b bigint, c double, d string, e float, y double")
    assert cols.feature_columns(frame, ["y"]) == ["a", "c", "e"]
    assert cols.feature_columns(frame, ["y"], include_long=True) == ["a", "b", "c", "e"]
    assert cols.string_columns(frame) == ["d"]


def test_names_with_dots(spark):
    frame = spark.createDataFrame([("1", "a")], "`x.y` string, `k z` string")
    out = cols.cast_numeric(frame, ["x.y"])
    assert out.columns == ["x.y", "k z"] and out.first()[0] == 1.0


def test_null_vector_becomes_empty(spark):
    frame = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (None,)], ["v"])
    out = [r.v for r in cols.vector_to_array(frame, "v").collect()]
    assert out == [[1.0, 2.0], []]


@pytest.fixture(scope="module")
def holes(spark):
    return spark.createDataFrame(
        [(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)], "a int, b double"
    )


def test_invalid_skip_and_keep(holes):
    skipped = features.assemble_features(holes, ["a", "b"], "v", "skip").collect()
    assert [r.v for r in skipped] == [[1.0, 1.0]]
    kept = [r.v for r in features.assemble_features(holes, ["a", "b"], "v", "keep").collect()]
    assert len(kept) == 4 and math.isnan(kept[1][1]) and math.isnan(kept[3][0])


def test_invalid_error_stops(holes):
    with pytest.raises(Exception, match="null, NaN or infinite"):
        features.assemble_features(holes, ["a", "b"], "v").collect()
    with pytest.raises(ValueError):
        features.assemble_features(holes, ["a", "b"], "v", "drop")


def test_scale_by_sample_deviation_without_centring(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    out = [r.s for r in features.standard_scale(frame, ["a", "b"], "s").orderBy("a").collect()]
    assert [v[0] for v in out] == pytest.approx([0.6547, 1.3093, 2.6186], abs=1e-4)
    assert [v[1] for v in out] == [0.0, 0.0, 0.0]


def test_index_drops_null_and_unseen(spark):
    fit = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    tables = features.category_tables(fit, ["c"])
    new = spark.createDataFrame([("y",), ("z",), (None,), ("x",)], "c string")
    assert sorted(r.c_index for r in features.index_categories(new, tables).collect()) == [0.0, 1.0]


def settings(**options):
    base = dict(label="y", drop=["junk"], numeric=["a", "b"], min_class_rows=2)
    return FlowPreprocessor(**{**base, **options})


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (i, str(i % 7), str(3.5 * (i % 5)), "p" if i % 3 else "q", f"s{i % 4}", "n",
         "common" if i % 2 else ("rare" if i == 40 else "other"))
        for i in range(60)
    ]
    return spark.createDataFrame(
        rows, "id long, a string, b string, c string, d string, junk string, y string"
    )


def vectors(df):
    return sorted(
        ([round(x, 9) for x in r.scaled_features], r.label, round(r.weight, 9)) for r in df.collect()
    )


def test_preparation_equals_ml_stages(spark, raw):
    fitted = settings().fit(raw)
    out = fitted.transform(raw)
    assert out.columns == ["scaled_features", "label", "weight"]
    assert fitted.features == ["a", "b", "c_index", "d_index"]
    kept = raw.filter("y <> 'rare'").select(
        F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b"), "c", "d", "y"
    )
    model = fit_stages(kept, ["c", "d"], ["a", "b"], "y")
    theirs = model.transform(kept)
    expected = sorted(
        ([round(x, 9) for x in r.scaled_features], r.label) for r in theirs.collect()
    )
    assert [v[:2] for v in vectors(out)] == [tuple(e) for e in expected]


def test_weights_balance(raw):
    out = settings().fit(raw).transform(raw)
    per_class = out.groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert len(per_class) == 2
    assert all(r.w == pytest.approx(out.count() / 2) for r in per_class)


def test_large_tables_give_the_same(raw):
    a = settings().fit(raw)
    b = settings(max_side_rows=0).fit(raw)
    assert not b.labels.small
    assert vectors(a.transform(raw)) == vectors(b.transform(raw))


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_partitioning_does_not_matter(raw, parts):
    assert vectors(settings().fit(raw.repartition(parts)).transform(raw)) == vectors(
        settings().fit(raw).transform(raw)
    )


def test_save_and_load(spark, raw, tmp_path):
    fitted = settings().fit(raw)
    fitted.save(spark, str(tmp_path))
    again = FittedPreprocessor.load(spark, str(tmp_path))
    assert again.features == fitted.features
    assert vectors(again.transform(raw)) == vectors(fitted.transform(raw))


def test_unlabelled_rows_give_features_alone(raw):
    out = settings().fit(raw).transform(raw.drop("y"))
    assert out.columns == ["scaled_features"] and out.count() == 60


def test_vector_output(raw):
    out = settings().fit(raw).transform(raw, as_vector=True)
    assert out.schema["scaled_features"].dataType.simpleString() == "vector"


def test_fit_on_train_sees_training_rows_only(raw):
    fitted = settings(key="id", fit_on="train").fit(raw)
    assert fitted.labels.total < 60
    assert fitted.transform(raw).columns == ["id", "scaled_features", "label", "weight"]
    with pytest.raises(ValueError):
        settings(fit_on="train").fit(raw)


def test_null_categories_are_left_out_of_later_fits(spark):
    rows = [("1", None, "x", "k"), ("2", "u", "y", "k"), ("3", "u", "y", "k"), ("9", "w", None, "k")]
    frame = spark.createDataFrame(rows, "a string, c string, d string, y string")
    fitted = settings(numeric=["a"], min_class_rows=1).fit(frame)
    assert {r.value: r.n for r in fitted.categories["d"].frame.collect()} == {"y": 2}
    assert {r.value: (r.n, r.used) for r in fitted.categories["c"].frame.collect()} == {
        "u": (2, 2), "w": (1, 0)
    }
    assert fitted.labels.total == 2
    assert fitted.stds["a"] == pytest.approx(2**-0.5)


def test_bad_numbers_follow_the_setting(spark):
    rows = [("1", "k"), ("x", "k"), ("3", "k"), ("4", "j"), ("6", "j")]
    frame = spark.createDataFrame(rows, "a string, y string")
    with pytest.raises(ValueError, match="1 rows"):
        settings(numeric=["a"]).fit(frame)
    skip = settings(numeric=["a"], invalid="skip").fit(frame)
    assert skip.labels.total == 4 and skip.transform(frame).count() == 4
    assert settings(numeric=["a"], invalid="keep").fit(frame).transform(frame).count() == 5


def test_empty_and_missing(spark):
    frame = spark.createDataFrame([], "a string, y string")
    fitted = settings(numeric=["a"]).fit(frame)
    assert fitted.transform(frame).count() == 0
    with pytest.raises(ValueError, match="label"):
        settings(numeric=["a"]).fit(frame.drop("y"))


def test_categories_alone_and_numbers_alone(spark):
    frame = spark.createDataFrame([("u", "k"), ("v", "k"), ("v", "j")], "c string, y string")
    only = settings(numeric=[], min_class_rows=1).fit(frame)
    assert only.features == ["c_index"] and only.transform(frame).count() == 3
    plain = spark.createDataFrame([("1", "k"), ("2", "j")], "a string, y string")
    assert settings(numeric=["a"], min_class_rows=1).fit(plain).transform(plain).count() == 2


def test_many_columns_with_aliases_stay_cheap_to_plan(spark):
    """A wide condition over renamed columns must not make the optimizer explode."""
    names = [f"x{i}" for i in range(40)]
    frame = spark.range(200).select(
        *[(F.col("id") * (i + 1)).cast("string").alias(n) for i, n in enumerate(names)],
        F.when(F.col("id") % 2 == 0, "k").otherwise("j").alias("y"),
    )
    for invalid in ("error", "skip", "keep"):
        fitted = settings(numeric=names, invalid=invalid).fit(frame)
        assert fitted.transform(frame).count() == 200
        assert fitted.stds["x1"] == pytest.approx(2 * fitted.stds["x0"])


@pytest.mark.parametrize("bad", [float("inf"), float("-inf")])
def test_infinite_values_are_invalid(spark, bad):
    frame = spark.createDataFrame(
        [(float(i), float(i % 3), "A") for i in range(30)] + [(bad, 1.0, "A")], "a double, b double, Attack string"
    )
    clean = frame.filter("a < 100 and a > -100")
    for invalid in ("skip", "keep"):
        settings = FlowPreprocessor(numeric=["a", "b"], min_class_rows=1, invalid=invalid)
        fitted, alone = settings.fit(frame), settings.fit(clean)
        assert fitted.stds == pytest.approx(alone.stds) and all(math.isfinite(x) for x in fitted.stds.values())
        out = [r.scaled_features for r in fitted.transform(frame).collect()]
        assert len(out) == (30 if invalid == "skip" else 31)
        assert sum(math.isnan(x) for row in out for x in row) == (0 if invalid == "skip" else 1)
    with pytest.raises(ValueError, match="infinite"):
        FlowPreprocessor(numeric=["a", "b"], min_class_rows=1).fit(frame)
    with pytest.raises(Exception, match="infinite"):
        features.assemble_features(frame, ["a", "b"], "v").collect()
    stats = {r.feature: r.std for r in features.scaler_stats(frame, ["a", "b"]).collect()}
    assert stats == pytest.approx({r.feature: r.std for r in features.scaler_stats(clean, ["a", "b"]).collect()})


def test_scaler_is_one_vector_aggregate(spark):
    from tests.plans import plan_of

    frame = spark.range(9).select(*[F.col("id").cast("double").alias(f"c{i}") for i in range(30)])
    plan = plan_of(features.scaler_stats(frame, frame.columns))
    assert "stddev" not in plan and plan.count("Exchange") == 1


def test_deviation_of_one_row_is_zero_on_both_paths(spark):
    one = spark.createDataFrame([(2.0, "A")], "a double, Attack string")
    for rows in (0, 100):
        fitted = FlowPreprocessor(numeric=["a"], min_class_rows=1, max_side_rows=rows).fit(one)
        assert fitted.stds == {"a": 0.0}


def test_ml_stages_have_no_cap(spark):
    from sluice.plans.stages import fit_stages

    frame = spark.range(120_000).select(
        F.col("id").cast("string").alias("c"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("y")
    )
    model = fit_stages(frame, ["c"], ["x"], "y")
    assert len(model.stages[0].labelsArray[0]) == 120_000
