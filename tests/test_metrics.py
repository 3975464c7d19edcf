"""Confusion matrices, reports, losses and histories."""

import json
import math

import pytest
from pyspark.sql import functions as F

from sluice.functions import losses
from sluice.operators import metrics
from sluice.operators.progress import Plateau, best_epochs, history_frame, plateau_lr
from sluice.sources import reports


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 0)]
    return spark.createDataFrame(rows, "label int, prediction int")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d")], "index long, value string")


def test_matrix_has_the_classes_that_occur(pairs, names):
    counts = metrics.pair_counts(pairs)
    found = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(counts).collect()}
    assert found == {(0, 0): 5, (0, 1): 2, (1, 1): 3, (2, 0): 1}
    grid = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(counts, names).collect()}
    assert len(grid) == 16 and grid == {**dict.fromkeys(grid, 0), **found}


def test_percent_is_null_without_rows(pairs, names):
    dense = metrics.confusion_matrix(metrics.pair_counts(pairs), names)
    found = {(r.label, r.prediction): r.pct for r in metrics.confusion_pct(dense).collect()}
    assert found[0, 0] == pytest.approx(500 / 7) and found[3, 3] is None


def test_report_by_hand(pairs, names):
    report = metrics.classification_report(metrics.pair_counts(pairs), names)
    found = {(r["class"], r.metric): r.value for r in report.collect()}
    assert found["a", "precision"] == pytest.approx(5 / 6)
    assert found["a", "recall"] == pytest.approx(5 / 7)
    assert found["a", "f1-score"] == pytest.approx(10 / 13)
    assert found["b", "precision"] == pytest.approx(3 / 5)
    assert found["c", "f1-score"] == 0 and found["d", "support"] == 0
    assert found["accuracy", "accuracy"] == pytest.approx(8 / 11)
    assert found["macro avg", "recall"] == pytest.approx((5 / 7 + 1 + 0 + 0) / 4)
    assert found["weighted avg", "recall"] == pytest.approx(8 / 11)
    assert len(found) == 4 * 4 + 1 + 8


def test_report_of_nothing(spark, names):
    empty = spark.createDataFrame([], "label int, prediction int")
    found = metrics.classification_report(metrics.pair_counts(empty), names).collect()
    assert len(found) == 25 and all(r.value == 0 for r in found)
    assert metrics.confusion_matrix(metrics.pair_counts(empty)).count() == 0


def test_report_survives_json(spark, pairs, names, tmp_path):
    report = metrics.classification_report(metrics.pair_counts(pairs), names)
    reports.sink_report_json(report, str(tmp_path / "r"), {"model": "m"})
    again = reports.read_report_json(spark, str(tmp_path / "r"))
    plain = json.loads(spark.read.text(str(tmp_path / "r")).first()[0])
    assert plain["accuracy"] == pytest.approx(8 / 11) and plain["model_info"] == {"model": "m"}
    assert plain["b"]["support"] == 3 and plain["macro avg"]["support"] == 11
    key = ["class", "metric", "value"]
    assert sorted(map(tuple, report.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))


def test_cross_entropy_and_argmax(spark):
    frame = spark.createDataFrame(
        [([1.0, 2.0, 2.0], 1), ([1000.0, 0.0, 0.0], 0), ([0.0, 0.0, 0.0], 2), ([1.0, 2.0, 3.0], 9)],
        "z array<double>, y int",
    )
    out = frame.select(
        losses.cross_entropy(F.col("z"), F.col("y")).alias("l"), losses.argmax(F.col("z")).alias("p")
    ).collect()
    assert out[0].l == pytest.approx(math.log(math.exp(1) + 2 * math.exp(2)) - 2)
    assert out[1].l == 0.0 and out[2].l == pytest.approx(math.log(3)) and out[3].l is None
    assert [r.p for r in out] == [1, 0, 0, 2]


def test_losses_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "scores array<double>, label int, weight double")
    found = metrics.accuracy_loss(empty).first()
    assert (found.rows, found.loss, found.accuracy) == (0, 0.0, 0.0)


def test_weighted_loss_divides_by_rows(spark):
    frame = spark.createDataFrame([([0.0, 0.0], 0, 3.0), ([0.0, 0.0], 1, 1.0)],
                                  "scores array<double>, label int, weight double")
    assert metrics.weighted_loss(frame).first().loss == pytest.approx(2 * math.log(2))


def test_metadata_refuses_unequal_vectors(spark):
    frame = spark.createDataFrame([([1.0], 0), ([1.0, 2.0], 1)], "v array<double>, y int")
    with pytest.raises(Exception, match="differ in length"):
        metrics.dataset_metadata(frame, "v", "y").collect()
    found = metrics.dataset_metadata(frame.limit(0), "v", "y").first()
    assert (found.num_rows, found.num_classes, found.num_features) == (0, 0, 0)


def test_best_epochs_are_strictly_better(spark):
    scores = [0.0, 0.5, 0.5, 0.4, 0.6, -1.0]
    frame = spark.createDataFrame(
        [("r", i, s) for i, s in enumerate(scores)] + [("q", 0, 0.1)],
        "run_id string, epoch int, val_acc double",
    )
    found = {(r.run_id, r.epoch) for r in best_epochs(frame).filter("is_best").collect()}
    assert found == {("r", 1), ("r", 4), ("q", 0)}


def test_plateau_rule():
    rule = Plateau(1.0, factor=0.1, patience=1, min_lr=0.005)
    rates = [rule.step(x) for x in [1.0, 0.99995, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9]]
    assert rates == pytest.approx([1, 1, 1, 1, 0.1, 0.1, 0.01, 0.01, 0.005, 0.005, 0.005])


def test_plateau_over_runs_ignores_row_order(spark):
    rows = [(run, i, 1.0 if run == "flat" else 1.0 / (i + 1)) for run in ("flat", "down") for i in range(8)]
    frame = spark.createDataFrame(rows[::-1], "run_id string, epoch int, val_loss double")
    out = plateau_lr(frame, 1.0, 0.5, 2, 0.1).collect()
    found = {(r.run_id, r.epoch): r.lr for r in out}
    assert [found["flat", i] for i in range(8)] == [1, 1, 1, 0.5, 0.5, 0.5, 0.25, 0.25]
    assert all(found["down", i] == 1 for i in range(8))


def test_history_round_trip(spark, tmp_path):
    row = dict(run_id="r", epoch=1, lr=0.1, train_loss=0.5, train_acc=0.6, val_loss=0.4, val_acc=0.7,
               is_best=True)
    frame = history_frame(spark, [row])
    later = history_frame(spark, [{**row, "epoch": 2, "val_loss": 0.3}, row])
    lists = reports.history_lists(later).first()
    assert lists.model_type == "r" and lists.val_losses == [0.4, 0.3]
    reports.sink_history(frame, str(tmp_path / "h"))
    assert reports.read_history(spark, str(tmp_path / "h")).collect() == frame.collect()


def test_classes_may_be_called_like_summaries(spark, tmp_path):
    pairs = spark.createDataFrame([(0, 0)] * 7 + [(0, 1), (1, 1), (2, 2)], "label int, prediction int")
    names = spark.createDataFrame(
        [(0, "accuracy"), (1, "macro avg"), (2, "class accuracy")], "index long, value string"
    )
    report = metrics.classification_report(metrics.pair_counts(pairs), names)
    reports.sink_report_json(report, str(tmp_path / "r"))
    again = reports.read_report_json(spark, str(tmp_path / "r"))
    columns = ["class", "metric", "value", "kind"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, report.select(columns).collect()))
    found = {(r["class"], r.metric, r.kind): r.value for r in again.collect()}
    assert found["accuracy", "accuracy", "summary"] == pytest.approx(0.9)
    assert found["accuracy", "support", "class"] == 8


# Validation losses and accuracies of the 100 epochs of a published run.
GOLDEN_LOSSES = (
    0.316287, 0.226264, 0.204827, 0.218647, 0.186364, 0.187451, 0.180111, 0.175517, 0.201679,
    0.168511, 0.18235, 0.173978, 0.162737, 0.172996, 0.161809, 0.171219, 0.165021, 0.184739,
    0.179209, 0.163112, 0.168044, 0.165479, 0.163371, 0.163534, 0.162018, 0.160446, 0.160871,
    0.15955, 0.158824, 0.161244, 0.157224, 0.156782, 0.15713, 0.156981, 0.157065, 0.157984,
    0.157561, 0.156437, 0.157565, 0.155584, 0.156809, 0.156429, 0.155588, 0.156094, 0.15396,
    0.157093, 0.155021, 0.155673, 0.154457, 0.154673, 0.153555, 0.153258, 0.153788, 0.153227,
    0.154795, 0.152805, 0.15263, 0.15384, 0.153827, 0.154205, 0.152568, 0.153063, 0.153791,
    0.154085, 0.152754, 0.152473, 0.154707, 0.152943, 0.153056, 0.154701, 0.153972, 0.151435,
    0.152442, 0.154105, 0.152743, 0.153525, 0.157004, 0.152791, 0.153124, 0.152858, 0.15269,
    0.152514, 0.152588, 0.152562, 0.152292, 0.152189, 0.152388, 0.152441, 0.152522, 0.152096,
    0.152408, 0.152273, 0.151833, 0.152244, 0.152592, 0.152497, 0.152519, 0.152071, 0.152312,
    0.152656,
)
GOLDEN_ACCURACIES = (
    0.878954, 0.920171, 0.922753, 0.918663, 0.929733, 0.927413, 0.932204, 0.92166, 0.9142,
    0.925236, 0.931529, 0.923716, 0.935182, 0.925442, 0.933579, 0.92678, 0.93455, 0.924715,
    0.925391, 0.932511, 0.935115, 0.935083, 0.935634, 0.935908, 0.936644, 0.937343, 0.937134,
    0.937414, 0.937365, 0.936232, 0.937771, 0.937492, 0.937834, 0.937713, 0.937864, 0.936803,
    0.937303, 0.937804, 0.936974, 0.938501, 0.937529, 0.937099, 0.938132, 0.937642, 0.93882,
    0.936809, 0.937963, 0.936803, 0.937833, 0.937504, 0.938089, 0.938054, 0.938255, 0.938199,
    0.937772, 0.938482, 0.938385, 0.938138, 0.937816, 0.937527, 0.939227, 0.938289, 0.937493,
    0.937851, 0.938873, 0.938363, 0.937828, 0.938147, 0.938261, 0.937002, 0.937142, 0.938333,
    0.938031, 0.937365, 0.938308, 0.937702, 0.937063, 0.937726, 0.937573, 0.937757, 0.937815,
    0.93795, 0.93792, 0.937994, 0.938126, 0.93809, 0.938047, 0.937974, 0.937999, 0.93819,
    0.937984, 0.938042, 0.938332, 0.93813, 0.937948, 0.937941, 0.937969, 0.938169, 0.938007,
    0.937785,
)
# Class, precision, recall, f1-score and support of its published test report.
GOLDEN_REPORT = (
    ("Benign", 0.9992506264725864, 0.8844866344266054, 0.9383727146062041, 3681548),
    ("DDoS", 0.9947370828402029, 0.9869754668434912, 0.9908410751896851, 3173012),
    ("DoS", 0.9906443253834712, 0.9419421819745789, 0.9656795945326972, 2606419),
    ("scanning", 0.9455902073376199, 0.9962866489633411, 0.970276663944071, 552062),
    ("Reconnaissance", 0.8895834169679481, 0.973589538159357, 0.9296926575674451, 386930),
    ("xss", 0.9429739902190631, 0.9491886302611171, 0.9460711045235111, 359762),
    ("password", 0.9194546347381496, 0.9404649348807526, 0.9298411149703643, 169228),
    ("injection", 0.7291318057599327, 0.8594536732347461, 0.7889471696911522, 100892),
    ("Bot", 0.9997130285058351, 1.0, 0.9998564936618034, 20902),
    ("Brute Force", 0.992796113251801, 0.9772964652850311, 0.9849853177461355, 18191),
    ("Infilteration", 0.0414417018180731, 0.9747421472105017, 0.07950327778348705, 17064),
    ("Exploits", 0.6993687084115339, 0.8924450250381014, 0.7841974363879854, 4593),
    ("Fuzzers", 0.6423695221316891, 0.8964351567301783, 0.7484284797947403, 3254),
    ("Backdoor", 0.9198078344419808, 0.8975838442120447, 0.9085599561963862, 2773),
    ("Generic", 0.5646094503375121, 0.9733998337489609, 0.7146780592004882, 2406),
    ("mitm", 0.011090742438130156, 0.9688612099644128, 0.021930442837867773, 1124),
)
GOLDEN_ACCURACY = 0.9392098852629152


def test_golden_history(spark):
    rows = [
        ("run", e, a, b) for e, (a, b) in enumerate(zip(GOLDEN_LOSSES, GOLDEN_ACCURACIES), 1)
    ]
    history = spark.createDataFrame(rows, "run_id string, epoch int, val_loss double, val_acc double")
    best = [r.epoch for r in best_epochs(history).orderBy("epoch").collect() if r.is_best]
    assert len(best) == 17 and best[-1] == 61
    rates = [r.lr for r in plateau_lr(history, 0.001, 0.1, 5, 1e-5).orderBy("epoch").collect()]
    drops = [e for e, (a, b) in enumerate(zip([0.001, *rates], rates), 1) if b < a]
    assert drops == [21, 78] and rates[-1] == pytest.approx(1e-5)


def golden_counts():
    """A table of pairs that has the published hits, supports and numbers of predictions."""
    hits = [round(r * n) for _, _, r, _, n in GOLDEN_REPORT]
    missed = [n - h for h, (*_, n) in zip(hits, GOLDEN_REPORT)]
    wrong = [round(h / p) - h for h, (_, p, *_) in zip(hits, GOLDEN_REPORT)]
    assert sum(missed) == sum(wrong)
    cells = {(i, i): h for i, h in enumerate(hits)}
    while sum(missed):
        # Serving whoever has most left keeps the last ones from meeting on the diagonal.
        i = max(range(16), key=lambda k: missed[k] + wrong[k])
        j = max((k for k in range(16) if k != i), key=lambda k: (wrong if missed[i] else missed)[k])
        a, b = (i, j) if missed[i] else (j, i)
        n = max(1, min(missed[a], wrong[b]) // 2)
        cells[a, b] = cells.get((a, b), 0) + n
        missed[a] -= n
        wrong[b] -= n
    return cells


def test_golden_report(spark):
    rows = [(a, b, n) for (a, b), n in golden_counts().items()]
    counts = spark.createDataFrame(rows, "label long, prediction long, n long")
    names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(GOLDEN_REPORT)], "index long, value string")
    report = metrics.classification_report(counts, names)
    found = {(r["class"], r.metric): r.value for r in report.collect()}
    for name, *values, support in GOLDEN_REPORT:
        assert [found[name, m] for m in ("precision", "recall", "f1-score")] == pytest.approx(values, abs=1e-12)
        assert found[name, "support"] == support
    assert found["accuracy", "accuracy"] == pytest.approx(GOLDEN_ACCURACY, abs=1e-12)
    assert found["weighted avg", "recall"] == pytest.approx(GOLDEN_ACCURACY, abs=1e-12)
    for at, metric in enumerate(("precision", "recall", "f1-score"), 1):
        mean = sum(r[at] for r in GOLDEN_REPORT) / 16
        assert found["macro avg", metric] == pytest.approx(mean, abs=1e-12)
