"""Rounds, whole training runs, and evaluation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators.metrics import counts_summary
from sluice.plans.evaluate import evaluate_test_set
from sluice.plans.networks import AdamW, create_network, initial, weighted_gradient
from sluice.plans.scoring import score, score_counts
from sluice.plans import training
from sluice.plans.training import RowDraws, gradient_round, local_round, train
from sluice.sources.shards import stage_shards


@pytest.fixture(scope="module")
def rows(spark):
    """Two classes that a line separates, the second three times as heavy."""
    a, b = F.sin(F.col("id") * 1.3), F.cos(F.col("id") * 0.7)
    frame = spark.range(0, 4000, 1, 4).select(F.array(a, b).alias("scaled_features"), (a + b > 0.4).alias("up"))
    return frame.select(
        "scaled_features",
        F.col("up").cast("double").alias("label"),
        F.when(F.col("up"), 3.0).otherwise(1.0).alias("weight"),
    ).persist()


@pytest.fixture(scope="module")
def staged(rows, tmp_path_factory):
    return stage_shards(rows, 4, str(tmp_path_factory.mktemp("s") / "four"), file_rows=256)


def arrays(df):
    found = df.select("scaled_features", "label", "weight").collect()
    return (np.array([r[0] for r in found]), np.array([int(r[1]) for r in found]),
            np.array([r[2] for r in found]))


def test_gradient_does_not_depend_on_the_shards(rows, staged, tmp_path):
    net = create_network("gru", 2, 2, hidden_size=16, num_layers=2, dropout=0.0)
    flat = initial(net, 7)
    one = stage_shards(rows, 1, str(tmp_path / "one"))
    a, b = gradient_round(staged.frame, net, flat), gradient_round(one.frame, net, flat)
    x, y, w = arrays(rows)
    direct, loss, right = weighted_gradient(net, flat, x, y, w)
    assert (direct != 0).mean() > 0.5
    for found in (a, b):
        assert found.rows == 4000 and abs(found.right - right) <= 1
        assert found.loss == pytest.approx(loss, rel=1e-9)
        assert np.allclose(found.vector, direct, rtol=1e-9, atol=1e-9)


def test_long_vectors_are_summed_in_slices(rows, staged):
    net = create_network("rnn", 2, 2, hidden_size=200, num_layers=2, dropout=0.0)
    assert net.size > 32_768
    flat = initial(net)
    found = gradient_round(staged.frame, net, flat)
    direct, _, _ = weighted_gradient(net, flat, *arrays(rows))
    assert np.allclose(found.vector, direct, rtol=1e-8, atol=1e-8)


def test_dropout_is_repeatable(staged):
    net = create_network("lstm", 2, 2, hidden_size=8, num_layers=2, dropout=0.5)
    flat = initial(net)
    a, b, c = (gradient_round(staged.frame, net, flat, s) for s in ((1, 2), (1, 2), (1, 3)))
    assert np.allclose(a.vector, b.vector, atol=1e-9)
    assert not np.allclose(a.vector, c.vector, atol=1e-3)


def test_local_round_averages_the_workers(staged):
    net = create_network("linear", 2, 2)
    flat, optimizer = initial(net), AdamW(np.zeros(net.size), np.zeros(net.size))
    part = staged.frame.filter("pos < 200")
    done = local_round(part, 4, net, flat, optimizer, 0.01, 50)
    ends = []
    for shard in range(4):
        x, y, w = arrays(part.filter(F.col("shard") == shard).orderBy("pos"))
        own, place = AdamW(np.zeros(net.size), np.zeros(net.size)), flat
        for i in range(0, 200, 50):
            g, _, _ = weighted_gradient(net, place, x[i:i + 50], y[i:i + 50], w[i:i + 50])
            place = own.update(place, g / 50, 0.01)
        ends.append(np.concatenate([place, own.first, own.second]))
    assert done.rows == 800
    assert np.allclose(done.vector / done.rows, np.mean(ends, axis=0), atol=1e-10)


def test_empty_round_has_no_rows(staged):
    net = create_network("linear", 2, 2)
    assert gradient_round(staged.frame.filter("pos < 0"), net, initial(net)).rows == 0


@pytest.mark.parametrize("kind", ["rnn", "lstm", "gru", "transformer"])
def test_training_learns(staged, rows, kind):
    net = create_network(kind, 2, 2, hidden_size=8, num_layers=1, num_heads=2,
                         dim_feedforward=8, dropout=0.05)
    result = train(net, staged, rows, epochs=4, batch_size=64, local_steps=8, learning_rate=0.02)
    history = result.history.orderBy("epoch").collect()
    assert [r.epoch for r in history] == [1, 2, 3, 4]
    assert history[-1].train_loss < history[0].train_loss
    assert result.best_accuracy > 0.9
    assert sum(r.is_best for r in history) >= 1


def test_one_step_is_synchronous(rows, staged):
    """With one local step, an epoch is the same as AdamW over the whole batches in turn."""
    net = create_network("linear", 2, 2)
    start = initial(net)
    result = train(net, staged, rows, epochs=1, batch_size=500, local_steps=1,
                   learning_rate=0.01, start=start, dtype="float64")
    flat, optimizer = start, AdamW(np.zeros(net.size), np.zeros(net.size))
    for first in (0, 500):
        part = staged.frame.filter((F.col("pos") >= first) & (F.col("pos") < first + 500))
        x, y, w = arrays(part)
        g, _, _ = weighted_gradient(net, flat, x, y, w)
        flat = optimizer.update(flat, g / len(y), 0.01)
    assert np.allclose(result.weights, flat, atol=1e-10)


def seen_rounds(monkeypatch):
    """Rows of every local round that training makes from now on, whichever way it goes."""
    import sluice.plans.training as training

    seen = []

    def counting(plain):
        def run(*args, **options):
            done = plain(*args, **options)
            seen.append(done.rows)
            return done

        return run

    monkeypatch.setattr(training, "local_round", counting(training.local_round))
    monkeypatch.setattr(training.HeldBlocks, "local", counting(training.HeldBlocks.local))
    return seen


@pytest.mark.parametrize("file_rows, exchange", [(7, 1 << 20), (100, 1 << 20), (5000, 1 << 20), (100, 0)])
def test_every_row_is_used_unless_the_remainder_is_dropped(rows, tmp_path, monkeypatch, file_rows, exchange):
    net = create_network("linear", 2, 2)
    odd = stage_shards(rows.limit(1030), 2, str(tmp_path / "odd"), file_rows=file_rows)
    seen = seen_rounds(monkeypatch)
    train(net, odd, rows, epochs=1, batch_size=100, local_steps=2, exchange_bytes=exchange)
    assert sum(seen) == 1030 and min(seen) > 0
    seen.clear()
    train(net, odd, rows, epochs=1, batch_size=100, local_steps=2, drop_remainder=True, exchange_bytes=exchange)
    assert sum(seen) == 1000
    with pytest.raises(ValueError, match="fewer training rows"):
        train(net, odd, rows, epochs=1, batch_size=1000, local_steps=2, drop_remainder=True)


def plain_run(net, staged, batch, local_steps, epochs, rate, start):
    """The whole training as a loop over rows of the staged table, shard by shard."""
    held = staged.frame.orderBy("number").collect()
    cut = lambda rs: (
        np.array([r.scaled_features for r in rs]), np.array([int(r.label) for r in rs]),
        np.array([r.weight for r in rs]),
    )
    flat, optimizer = start, AdamW(np.zeros(net.size), np.zeros(net.size))
    width = batch * local_steps
    for _ in range(epochs):
        for first in range(0, staged.longest, width):
            if local_steps == 1:
                part = [r for r in held if first <= r.pos < first + width]
                g, _, _ = weighted_gradient(net, flat, *cut(part))
                flat = optimizer.update(flat, g / len(part), rate)
                continue
            ends, sizes, steps = [], [], 0
            for shard in range(staged.count):
                mine = [r for r in held if r.shard == shard and first <= r.pos < first + width]
                own, place = AdamW(optimizer.first, optimizer.second, optimizer.steps), flat
                for i in range(0, len(mine), batch):
                    g, _, _ = weighted_gradient(net, place, *cut(mine[i : i + batch]))
                    place = own.update(place, g / len(mine[i : i + batch]), rate)
                if mine:
                    ends.append(np.concatenate([place, own.first, own.second]) * len(mine))
                    sizes.append(len(mine))
                    steps = max(steps, own.steps)
            flat, first_, second = np.split(sum(ends) / sum(sizes), 3)
            optimizer = AdamW(first_, second, steps)
    return flat


@pytest.mark.parametrize("files", [1, 4, 13])
@pytest.mark.parametrize("local_steps", [1, 4])
def test_training_does_not_depend_on_the_layout(spark, rows, tmp_path, files, local_steps):
    """Any cut of the input, rows per staged file, and packing of files into tasks."""
    net = create_network("linear", 2, 2)
    start = initial(net, 3)
    path = str(tmp_path / "in")
    rows.limit(2001).repartition(files).write.parquet(path)
    source = spark.read.parquet(path)
    window = 100 * local_steps
    bound = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for file_rows in (window // 4, window, 100_000):
        staged = stage_shards(source, 3, str(tmp_path / f"s{file_rows}"), file_rows=file_rows)
        wanted = plain_run(net, staged, 100, local_steps, 1, 0.01, start)
        for size in ("1k", "40k", "128m") if file_rows == window else ("1m",):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                found = [
                    train(net, staged, rows, 1, 100, local_steps, 0.01, start=start, dtype="float64", exchange_bytes=x)
                    for x in ((1 << 20, 0) if size == "40k" else (1 << 20,))
                ]
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", bound)
            for run in found:
                assert np.allclose(run.weights, wanted, rtol=0, atol=1e-10)


@pytest.mark.parametrize("local_steps", [1, 2])
def test_a_task_holds_a_bounded_part_of_a_large_round(rows, tmp_path, monkeypatch, local_steps):
    """A batch of all rows: parts of whole blocks add up; steps of a shard read its rows in order."""
    net = create_network("linear", 2, 2)
    start, staged = initial(net, 3), stage_shards(rows.limit(3500), 1, str(tmp_path / "s"), file_rows=500)
    held = []
    table = training.HeldBlocks._table

    def counting(self, number):
        found = table(self, number)
        held.extend(found.mapPartitions(lambda pieces: [sum(len(p.n) // 8 for p in pieces)]).collect())
        return found

    monkeypatch.setattr(training.HeldBlocks, "_table", counting)
    batch = 3500 // local_steps
    found = train(net, staged, rows, 2, batch, local_steps, 0.01, start=start, dtype="float64", held_bytes=1)
    assert held == ([1024, 1024, 1024, 428] * 2 if local_steps == 1 else [])
    wanted = plain_run(net, staged, batch, local_steps, 2, 0.01, start)
    assert np.allclose(found.weights, wanted, rtol=0, atol=1e-10)


def test_parts_of_rounds_do_not_change_dropout(rows, tmp_path):
    net = create_network("lstm", 2, 2, hidden_size=8, num_layers=1, dropout=0.5)
    staged = stage_shards(rows, 1, str(tmp_path / "s"), file_rows=700)
    runs = [train(net, staged, rows, 1, 2500, 1, 0.01, dtype="float64", held_bytes=b) for b in (1, 1 << 20)]
    assert np.allclose(runs[0].weights, runs[1].weights, rtol=0, atol=1e-10)


def test_dropout_does_not_depend_on_the_packing(spark, rows, tmp_path):
    net = create_network("lstm", 2, 2, hidden_size=8, num_layers=2, dropout=0.5)
    staged = stage_shards(rows, 2, str(tmp_path / "s"), file_rows=500)
    flat = initial(net)
    optimizer = AdamW(np.zeros(net.size), np.zeros(net.size))
    whole = gradient_round(staged.frame, net, flat, (1, 2))
    moved = gradient_round(staged.frame.repartition(7), net, flat, (1, 2), block_rows=13)
    assert np.allclose(whole.vector, moved.vector, atol=1e-9)
    a = local_round(staged.frame, 2, net, flat, optimizer, 0.01, 100, (1, 2))
    b = local_round(staged.frame.repartition(5), 2, net, flat, optimizer, 0.01, 100, (1, 2))
    assert np.allclose(a.vector, b.vector, atol=1e-9)
    with pytest.raises(ValueError, match="column number"):
        gradient_round(rows, net, flat, (1, 2))


@pytest.mark.parametrize("local_steps", [1, 3])
@pytest.mark.parametrize("count, held_parts", [(1, 4096), (2, 4), (4, 4096)])
def test_held_blocks_equal_rounds_over_the_files(rows, tmp_path, monkeypatch, count, held_parts, local_steps):
    """Also with dropout, and when the blocks are dealt over several tables."""
    monkeypatch.setattr(training, "HELD_PARTS", held_parts)
    net = create_network("lstm", 2, 2, hidden_size=6, num_layers=2, dropout=0.3)
    staged = stage_shards(rows.limit(1501), count, str(tmp_path / "s"), file_rows=333)
    options = dict(epochs=2, batch_size=64, local_steps=local_steps, start=initial(net, 5), dtype="float64")
    held = train(net, staged, rows, **options)
    jobs = train(net, staged, rows, **options, exchange_bytes=0)
    assert np.allclose(held.weights, jobs.weights, rtol=0, atol=1e-10)
    a, b = (x.history.drop("run_id").orderBy("epoch").collect() for x in (held, jobs))
    assert [tuple(r) for r in a] == [pytest.approx(tuple(r)) for r in b]


def test_a_round_reads_its_own_partitions_alone(rows, tmp_path):
    """One task a shard, and rows pass the shuffle once for all epochs."""
    net = create_network("linear", 2, 2)
    staged = stage_shards(rows, 4, str(tmp_path / "s"))
    windows = training._windows(staged, 100, 1, False)
    held = training.HeldBlocks(staged, net, "float64", 100, windows)
    done = [held.run(i, lambda x, y, w, n: (n[:1] * 1.0, 0.0, len(set(n % 4)))) for i in range(len(windows))]
    assert [d.rows for d in done] == [400] * 10 and all(d.right == 4 for d in done)
    assert [d.vector.sum() for d in done] == [4 * 400 * i + 6 for i in range(10)]
    tables = dict(held.tables)
    held.run(0, lambda x, y, w, n: (w, 0.0, 0))
    assert held.tables == tables and len(tables) == 1
    assert tables[0][0].storageLevel.useMemory
    held.close()
    assert not tables[0][0].storageLevel.useMemory


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop", [1, 2, 3])
@pytest.mark.parametrize("torn", [False, True])
def test_a_stopped_run_goes_on_as_if_it_had_not(rows, staged, tmp_path, monkeypatch, stop, torn):
    """Stopped after an epoch's record is there, or while the record is being written."""
    net = create_network("gru", 2, 2, hidden_size=4, num_layers=1, dropout=0.2)
    rule = {"factor": 0.5, "patience": 0, "min_lr": 1e-6}
    options = dict(batch_size=200, local_steps=2, learning_rate=0.05, scheduler=rule, dtype="float64", run_id="r")
    whole = train(net, staged, rows, 4, **options)
    path = str(tmp_path / "state")
    plain = training.save_state if not torn else training.publish

    def stopping(spark, *args):
        if not torn:
            plain(spark, *args)
        if len(calls) + 1 == stop:
            raise Stopped
        calls.append(1)
        if torn:
            plain(spark, *args)

    calls = []
    monkeypatch.setattr(training, "publish" if torn else "save_state", stopping)
    with pytest.raises(Stopped):
        train(net, staged, rows, 4, state=path, **options)
    monkeypatch.undo()
    held = training.names_in(rows.sparkSession, path)
    last = stop - 1 if torn else stop
    assert [n for n in held if n.startswith("epoch-")] == ([f"epoch-{last:06d}"] if last else [])
    again = train(net, staged, rows, 4, state=path, **options)
    assert (again.weights == whole.weights).all() and (again.best_weights == whole.best_weights).all()
    assert again.history.orderBy("epoch").collect() == whole.history.orderBy("epoch").collect()
    assert training.names_in(rows.sparkSession, path) == ["epoch-000004"]
    done = train(net, staged, rows, 4, state=path, **options)  # nothing is left to do
    assert (done.weights == whole.weights).all()
    with pytest.raises(ValueError, match="another training"):
        train(net, staged, rows, 5, state=path, **{**options, "seed": 9})


def test_draws_are_even_and_differ_by_row_call_and_seed():
    draws = RowDraws((1, 2), np.arange(2000))
    first, second = draws.random((2000, 50)), draws.random((2000, 50))
    assert first.dtype == np.float32 and 0 <= first.min() and first.max() < 1
    for half in (first, second):
        assert abs(half.mean() - 0.5) < 0.005 and abs((half < 0.2).mean() - 0.2) < 0.005
        assert abs(np.corrcoef(half[:, 0], half[:, 1])[0, 1]) < 0.1
        assert abs(np.corrcoef(half[:-1, 0], half[1:, 0])[0, 1]) < 0.1
    assert abs(np.corrcoef(first.ravel(), second.ravel())[0, 1]) < 0.02
    other = RowDraws((1, 3), np.arange(2000)).random((2000, 50))
    assert abs(np.corrcoef(first.ravel(), other.ravel())[0, 1]) < 0.02
    assert (RowDraws((1, 2), np.arange(7, 9)).random((2, 50)) == first[7:9]).all()


def test_an_empty_table_stops(rows, tmp_path):
    net = create_network("linear", 2, 2)
    none = stage_shards(rows.filter("label > 5"), 2, str(tmp_path / "none"))
    assert none.rows == 0 and none.frame.count() == 0
    with pytest.raises(ValueError, match="no training rows"):
        train(net, none, rows, epochs=1)


def test_plateau_lowers_the_rate(staged, rows):
    net = create_network("linear", 2, 2)
    rule = {"factor": 0.1, "patience": 0, "min_lr": 1e-6}
    result = train(net, staged, rows, epochs=3, batch_size=500, local_steps=2,
                   learning_rate=1e-7, scheduler=rule)
    rates = [r.lr for r in result.history.orderBy("epoch").collect()]
    assert rates == [1e-7, 1e-7, 1e-7]
    rule = {"factor": 0.1, "patience": 0, "min_lr": 1e-9}
    result = train(net, staged, rows, epochs=4, batch_size=500, local_steps=2,
                   learning_rate=1e-6, scheduler=rule)
    rates = [r.lr for r in result.history.orderBy("epoch").collect()]
    assert rates == pytest.approx([1e-6, 1e-6, 1e-7, 1e-8])


def test_scores_agree_with_counts(rows):
    net = create_network("transformer", 2, 2, hidden_size=4, num_layers=1, num_heads=2, dim_feedforward=5)
    flat = initial(net, 4)
    one = score(rows, net, flat, keep=["label"])
    from sluice.operators.metrics import accuracy_loss
    a, b = accuracy_loss(one).first(), counts_summary(score_counts(rows, net, flat)).first()
    assert a.rows == b.rows == 4000
    assert a.loss == pytest.approx(b.loss) and a.accuracy == pytest.approx(b.accuracy)
    half = counts_summary(score_counts(rows, net, flat, dtype="float32")).first()
    assert half.loss == pytest.approx(b.loss, rel=1e-4)


def test_labels_out_of_range_stop(rows):
    net = create_network("linear", 2, 2)
    wrong = rows.withColumn("label", F.lit(2.0))
    with pytest.raises(Exception, match="labels must lie in 0..1"):
        score_counts(wrong, net, initial(net)).collect()
    with pytest.raises(Exception, match="labels must lie"):
        score_counts(rows.withColumn("label", F.lit(None).cast("double")), net, initial(net)).collect()


def test_missing_vectors_stop(rows):
    net = create_network("linear", 2, 2)
    holed = rows.withColumn("scaled_features", F.when(F.col("label") == 1, F.col("scaled_features")))
    with pytest.raises(Exception, match="every feature vector"):
        score(holed, net, initial(net)).collect()


def test_scoring_an_empty_table(rows):
    net = create_network("linear", 2, 2)
    empty = rows.filter("label > 5")
    assert score(empty, net, initial(net)).count() == 0
    found = counts_summary(score_counts(empty, net, initial(net))).first()
    assert (found.rows, found.loss, found.accuracy) == (0, 0.0, 0.0)


def test_evaluation_keeps_absent_classes(spark, rows, tmp_path):
    net = create_network("linear", 2, 3)
    names = spark.createDataFrame([(0, "down"), (1, "up"), (2, "never")], "index long, value string")
    result = evaluate_test_set(rows, net, initial(net), names, str(tmp_path))
    report = {(r["class"], r.metric): r.value for r in result.report.collect()}
    assert result.rows == 4000
    assert report["never", "support"] == 0 and report["weighted avg", "support"] == 4000
    assert report["accuracy", "accuracy"] == pytest.approx(result.accuracy)
    assert report["weighted avg", "recall"] == pytest.approx(result.accuracy)
    text = spark.read.text(str(tmp_path / "final_test_report")).first()[0]
    assert "test_accuracy" in text and "never" in text
