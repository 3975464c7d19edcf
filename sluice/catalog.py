"""One query per operator, each over whole tables of the folder it is given."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array as ml_vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .functions import columns as cols, hashing, losses
from .operators import classes, features, metrics, progress
from .operators.lookup import join_side
from .plans.lbfgs import train_lbfgs as run_lbfgs
from .plans.evaluate import evaluate_test_set as run_evaluation
from .plans.mergeable import FitPart
from .plans.networks import AdamW, Network, create_network, unpack
from .plans.preprocess import FlowPreprocessor
from .plans.scoring import score
from .plans.stages import fit_stages, load_stages, save_stages
from .plans.training import gradient_round, train
from .sources import reports, shards, tables
from .sources.staging import new_path, write_out
from .streaming.cycling import steps_of_pass, take_batches
from .streaming.evaluation import stream_evaluate as run_stream_evaluation
from .streaming.scoring import stream_score as run_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values shared with the SQL side.
EVENT_SHARD_ROWS, EVENT_BATCH = 1000, 256
STREAM_ROWS = 100_000
PLAN_FILES, PLAN_WORKERS, PLAN_BATCH = 5, 3, 64
LINE_FEATURES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RATE = 0.01
BAD_TEXT = [("l_tax", 3, "Infinity"), ("l_tax", 4, "x"), ("l_discount", 5, "-Infinity")]
SCORE_LAYER = np.sin(0.37 * np.arange(10 * 64) + 0.2).reshape(10, 64)
TRAIN_EPOCHS, TRAIN_RATE = 3, 0.05
LBFGS_ITERATIONS, LBFGS_MEMORY = 3, 2
TRAIN_RULE = {"factor": 0.1, "patience": 0, "min_lr": 1e-5}
REPORT_CLASSES = [(0, "A"), (1, "N"), (2, "R"), (3, "X"), (4, "Y")]
PLATEAU = {"start": 0.001, "factor": 0.1, "patience": 5, "min_lr": 1e-5}
NETWORKS = {
    "rnn": create_network("rnn", 4, 3, hidden_size=3, num_layers=2),
    "lstm": create_network("lstm", 4, 3, hidden_size=3, num_layers=2),
    "gru": create_network("gru", 4, 3, hidden_size=4, num_layers=2),
    "transformer": create_network(
        "transformer", 4, 3, hidden_size=4, num_layers=2, num_heads=2, dim_feedforward=5
    ),
    "linear": create_network("linear", 4, 3),
}


def fixed_weights(net: Network) -> np.ndarray:
    """Small made-up parameters by a formula, so that the SQL side can print the same ones."""
    return 0.8 * np.sin(0.9 * np.arange(net.size) + 0.3)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(column: Column, digits: int = 6) -> Column:
    """Rounded, with nothing left of a sign on values that round to zero."""
    return F.when(F.abs(column) < 0.5 * 10.0**-digits, F.lit(0.0)).otherwise(F.round(column, digits))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.scan_parquet(spark, f"{folder}/{name}.parquet")


def spread(array: str, count: int, prefix: str) -> list[Column]:
    return [rounded(F.get(array, F.lit(i))).alias(f"{prefix}{i}") for i in range(count)]


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a prepared table: key, features, label by frequency, balanced weight."""
    events = table(spark, folder, "events")
    labels = classes.label_index(events, "event_type")
    picked = events.select(
        "event_id",
        F.array(
            F.col("value") / 100.0, F.col("user_id") / 100.0, F.length("props") / 10.0
        ).alias("scaled_features"),
        "event_type",
    )
    joined = join_side(picked, "event_type", labels, {"label": "index", "weight": "weight"})
    return joined.withColumn("label", F.col("label").cast("double")).drop("event_type")


def line_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a prepared table of four features."""
    lines = table(spark, folder, "lineitem")
    labels = classes.label_index(lines, "l_returnflag")
    picked = lines.select("l_orderkey", "l_linenumber", "l_returnflag", line_vector())
    return join_side(picked, "l_returnflag", labels, {"label": "index", "weight": "weight"})


def line_vector() -> Column:
    return F.array(
        F.col("l_quantity") / 50.0,
        F.col("l_extendedprice") / 100000.0,
        F.col("l_discount") * 10.0,
        F.col("l_tax") * 10.0,
    ).alias("scaled_features")


def line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a true class of three and a made-up predicted class of four."""
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("label"),
        F.pmod(F.col("l_linenumber") + F.col("l_quantity").cast("int"), F.lit(4)).alias("prediction"),
    )


def report_classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REPORT_CLASSES, "index long, value string")


def class_scores(embedding: Column) -> Column:
    """Scores of ten classes by a fixed linear layer over the whole embedding."""
    weights = [F.array(*[F.lit(float(w)) for w in row]) for row in SCORE_LAYER]
    products = [F.zip_with(embedding, w, lambda x, y: x * y) for w in weights]
    total = lambda cells: F.aggregate(cells, F.lit(0.0), lambda a, x: a + x)
    return F.array(*[total(cells) for cells in products])


def embedding_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = class_scores(F.col("embedding").cast("array<double>"))
    return table(spark, folder, "embeddings").select("vec_id", "label", scores.alias("scores"))


def event_history(spark: SparkSession, folder: str) -> DataFrame:
    """A history per event type: one epoch per hour, so its length follows time, not rows."""
    hour = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) * 24 + F.hour("ts")
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("run_id"), hour.cast("long").alias("epoch"))
        .agg(
            F.round(F.avg("value"), 9).alias("val_loss"),
            F.round(F.avg((F.col("value") < 20.0).cast("double")), 9).alias("val_acc"),
        )
    )


# --- sources and sinks ---


@query
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    names = ["event_id", "user_id", "event_type", "value", "props"]
    path = new_path(spark, "csv")
    text = table(spark, folder, "events").select(*[F.col(c).cast("string").alias(c) for c in names])
    text.write.option("header", "true").csv(path)
    return tables.scan_csv(spark, path, names)


@query
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_orderkey", "l_extendedprice", "l_returnflag"]
    return tables.scan_parquet(spark, f"{folder}/lineitem.parquet", names)


@query
def sink_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "sink")
    orders = table(spark, folder, "orders")
    picked = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    tables.sink_parquet(picked, path, ["o_orderstatus"])
    return tables.scan_parquet(spark, path, picked.columns)


@query
def mini_sample(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    path = new_path(spark, "mini")
    tables.sink_parquet(tables.mini_sample(events, ["event_id"], 1000), path)
    return tables.scan_parquet(spark, path)


@query
def stage_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and positions of each shard, beside the sums over all of them."""
    rows = event_rows(spark, folder)
    vectors = rows.withColumn("scaled_features", array_to_vector("scaled_features"))
    staged = shards.stage_shards(vectors, 4, new_path(spark, "shards"))
    per_shard = staged.frame.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("pos").alias("positions"),
        F.max("pos").alias("last"),
        F.sum("label").alias("label_part"),
        F.sum("weight").alias("weight_part"),
        *[F.sum(F.get("scaled_features", F.lit(i))).alias(f"part{i}") for i in range(3)],
    )
    whole = Window.partitionBy()
    return per_shard.select(
        "shard", "n", "positions", "last",
        F.sum("label_part").over(whole).alias("label_sum"),
        F.round(F.sum("weight_part").over(whole), 3).alias("weight_sum"),
        *[F.round(F.sum(f"part{i}").over(whole), 3).alias(f"x{i}") for i in range(3)],
    )


@query
def shard_plan(spark: SparkSession, folder: str) -> DataFrame:
    staged = shards.stage_shards(event_rows(spark, folder), PLAN_FILES, new_path(spark, "plan"))
    plan = shards.shard_plan(spark, staged.count, staged.rows, PLAN_WORKERS, PLAN_BATCH)
    return plan.select(
        "worker", F.size("shards").cast("long").alias("n_files"), "samples", "steps_per_epoch"
    )


@query
def batch_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of about 1000 rows each, so their number and not their size grows with the table."""
    events = event_rows(spark, folder)
    count = -(-table(spark, folder, "events").count() // EVENT_SHARD_ROWS)
    rows = shards.keyed_shards(events, "event_id", count)
    together = rows.repartition("shard").sortWithinPartitions("shard")
    batches = shards.batch_scan(together, EVENT_BATCH, 3)
    return batches.groupBy("shard").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("n"),
        F.sum("label_sum").alias("label_sum"),
        F.round(F.sum("weight_sum"), 3).alias("weight_sum"),
        F.round(F.sum("feature_sum"), 3).alias("feature_sum"),
    )


@query
def endless_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two passes of batches over staged shards, stopped within the first and gone on with."""
    staged = shards.stage_shards(event_rows(spark, folder), PLAN_FILES, new_path(spark, "cycled"))
    steps = steps_of_pass(staged, EVENT_BATCH)
    output, state = new_path(spark, "cycled-out"), new_path(spark, "cycled-state")

    def add(rows: DataFrame, number: int) -> None:
        sums = rows.groupBy("pass", "step", "shard").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("label").cast("long")).alias("label_sum"),
            F.sum(F.aggregate("scaled_features", F.lit(0.0), lambda a, x: a + x)).alias("feature_sum"),
        )
        sums.write.mode("overwrite").parquet(f"{output}/trigger={number}")

    for until in (steps // 2, 2 * steps):
        take_batches(staged, EVENT_BATCH, -(-steps // 2), add, state, until)
    return (
        tables.scan_parquet(spark, output)
        .groupBy("pass")
        .agg(
            F.count_distinct("step").alias("steps"),
            F.count(F.lit(1)).alias("batches"),
            F.max("n").alias("largest"),
            F.sum("n").alias("n"),
            F.sum("label_sum").alias("label_sum"),
            F.round(F.sum("feature_sum"), 3).alias("feature_sum"),
        )
    )


@query
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", line_vector())
    source = new_path(spark, "stream-in")
    rows.write.option("maxRecordsPerFile", STREAM_ROWS).parquet(source)
    net = NETWORKS["rnn"]
    scored = run_stream(
        spark, source, rows.schema, net, fixed_weights(net), new_path(spark, "stream-out"),
        new_path(spark, "stream-state"), keep=["l_orderkey", "l_linenumber"],
        files_per_trigger=4,
    )
    return scored.select("l_orderkey", "l_linenumber", *spread("scores", 3, "z"), "prediction")


@query
def sink_report_json(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.classification_report(
        metrics.pair_counts(line_pairs(spark, folder)), report_classes(spark)
    )
    path = new_path(spark, "report")
    reports.sink_report_json(report, path, {"model": "fixed"})
    found = reports.read_report_json(spark, path)
    return found.select("class", "metric", rounded(F.col("value")).alias("value"))


@query
def transform_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    model = fit_stages(
        lines, ["l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount"], "l_returnflag"
    )
    path = new_path(spark, "stages")
    save_stages(model, path)
    out = load_stages(path).transform(lines)
    out = out.select("l_orderkey", ml_vector_to_array("scaled_features").alias("v"), "label")
    return out.select("l_orderkey", *spread("v", 4, "f"), "label")


# --- projections and filters ---


@query
def drop_if_present(spark: SparkSession, folder: str) -> DataFrame:
    return cols.drop_if_present(table(spark, folder, "events"), ["ts", "props", "absent"])


@query
def cast_numeric(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "events").select(
        "event_id", F.col("value").cast("string").alias("value"), "event_type", "props"
    )
    return cols.cast_numeric(text, ["value", "props", "absent"])


@query
def select_strings(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(*cols.string_columns(part, exclude=["p_brand"]))


@query
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select(*cols.feature_columns(lines, exclude=["l_tax"]))


@query
def vector_to_array(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        F.when(F.col("label") != 3, array_to_vector(F.col("embedding"))).alias("v"),
    )
    out = cols.vector_to_array(rows, "v")
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "vec_id",
        F.size("v").alias("width"),
        rounded(F.get("v", F.lit(0))).alias("first"),
        rounded(total).alias("total"),
    )


@query
def filter_isin(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return classes.filter_isin(events, "event_type", ["click", "error"])


@query
def sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "value")
    return hashing.sample_fraction(events, "event_id", 0.25)


# --- classes ---


def fifth(df: DataFrame) -> int:
    """Row threshold of one part in five: keeps the commoner ones of five classes."""
    return -(-df.count() // 5)


@query
def filter_rare_classes(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    return classes.filter_rare_classes(events, "event_type", fifth(events))


@query
def attach_class_weight(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    kept = classes.filter_rare_classes(events, "event_type", fifth(events))
    weights = classes.label_index(kept, "event_type")
    out = classes.attach_class_weight(events, "event_type", weights)
    return out.withColumn("weight", rounded(F.col("weight")))


@query
def decode_labels(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    labels = classes.label_index(orders, "o_orderpriority")
    indexed = join_side(orders, "o_orderpriority", labels, {"label": "index"})
    moved = indexed.select("o_orderkey", (F.col("label") + 1).cast("double").alias("label"))
    return classes.decode_labels(moved, "label", labels, "name")


@query
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id")
    return classes.split_counts(hashing.with_split(events, "event_id"))


@query
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return classes.class_counts(table(spark, folder, "documents"), "lang")


@query
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = classes.class_weights(table(spark, folder, "orders"), "o_orderpriority")
    return weights.withColumn("weight", rounded(F.col("weight")))


@query
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    labels = classes.label_index(table(spark, folder, "orders"), "o_orderpriority")
    return labels.frame.select("o_orderpriority", "n", "index")


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return hashing.with_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


# --- features ---


@query
def scaler_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = features.scaler_stats(table(spark, folder, "lineitem"), LINE_FEATURES)
    return stats.select(
        "position", "feature", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std")
    )


@query
def index_categories(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey", F.nullif("p_name", F.lit("red widget")).alias("p_name"), "p_brand", "p_type"
    )
    names = cols.string_columns(part)
    return features.index_categories(part, features.category_tables(part, names))


@query
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    out = features.assemble_features(lines, LINE_FEATURES, "v", invalid="skip")
    return out.select("l_orderkey", *spread("v", 5, "f"))


@query
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    out = features.standard_scale(table(spark, folder, "lineitem"), LINE_FEATURES, "v")
    return out.select("l_orderkey", *spread("v", 5, "f"))


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a raw table: every column text, as a CSV scan gives them, some of it no number."""
    lines = table(spark, folder, "lineitem")
    names = ["l_suppkey", *LINE_FEATURES, "l_linestatus", "l_returnflag", "l_shipdate"]
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in names])
    for column, quantity, bad in BAD_TEXT:
        here = (F.col("l_linenumber").cast("int") == 7) & (F.col("l_quantity").cast("double") == quantity)
        text = text.withColumn(column, F.when(here, bad).otherwise(F.col(column)))
    return text


def line_preprocessor(lines: DataFrame) -> FlowPreprocessor:
    return FlowPreprocessor(
        label="l_returnflag",
        drop=["l_shipdate", "absent"],
        numeric=LINE_FEATURES,
        min_class_rows=-(-lines.count() // 3),
        invalid="skip",
    )


@query
def preprocess(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_lines(spark, folder)
    settings = line_preprocessor(table(spark, folder, "lineitem"))
    typed = write_out(settings.typed(raw), "typed")
    out = settings.fit(typed).transform(typed)
    return out.select(
        *spread("scaled_features", 7, "f"), "label", rounded(F.col("weight")).alias("weight")
    )


@query
def preprocess_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The preparation fitted from three parts, two of them merged and saved before the third comes."""
    raw = raw_lines(spark, folder)
    settings = line_preprocessor(table(spark, folder, "lineitem"))
    typed = write_out(settings.typed(raw), "typed")
    place = F.pmod(F.xxhash64("l_suppkey", "l_quantity"), F.lit(3))
    parts = [FitPart.measure(settings, typed.filter(place == i)) for i in range(3)]
    path = new_path(spark, "part")
    parts[0].merge(parts[1]).save(path)
    out = FitPart.load(spark, path).merge(parts[2]).fit().transform(typed)
    return out.select(
        *spread("scaled_features", 7, "f"), "label", rounded(F.col("weight")).alias("weight")
    )


@query
def preprocess_fit_on_train(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics from the training rows alone, then every row transformed and split."""
    raw = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderstatus",
    )
    settings = FlowPreprocessor(
        label="o_orderstatus", drop=(), numeric=["o_totalprice"], min_class_rows=1,
        key="o_orderkey", fit_on="train",
    )
    typed = write_out(settings.typed(raw), "typed")
    fitted = settings.fit(typed)
    path = new_path(spark, "fitted")
    fitted.save(spark, path)
    out = hashing.with_split(type(fitted).load(spark, path).transform(typed), "o_orderkey")
    return out.select(
        "o_orderkey", *spread("scaled_features", 2, "f"), "label",
        rounded(F.col("weight")).alias("weight"), "split",
    )


# --- evaluation ---


@query
def dataset_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.dataset_metadata(table(spark, folder, "embeddings"), "embedding", "label")


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    grid = spark.range(4).select(F.col("id").alias("index"))
    return metrics.confusion_matrix(metrics.pair_counts(line_pairs(spark, folder)), grid)


@query
def confusion_pct(spark: SparkSession, folder: str) -> DataFrame:
    grid = spark.range(4).select(F.col("id").alias("index"))
    dense = metrics.confusion_matrix(metrics.pair_counts(line_pairs(spark, folder)), grid)
    return metrics.confusion_pct(dense).withColumn("pct", rounded(F.col("pct")))


@query
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    counts = metrics.pair_counts(line_pairs(spark, folder))
    report = metrics.classification_report(counts, report_classes(spark))
    return report.select("class", "metric", rounded(F.col("value")).alias("value"))


@query
def cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    loss = losses.cross_entropy(F.col("scores"), F.col("label"))
    return embedding_scores(spark, folder).select("vec_id", rounded(loss).alias("loss"))


@query
def argmax_predict(spark: SparkSession, folder: str) -> DataFrame:
    rows = embedding_scores(spark, folder)
    return rows.select("vec_id", losses.argmax(F.col("scores")).alias("prediction"))


@query
def accuracy_loss(spark: SparkSession, folder: str) -> DataFrame:
    out = metrics.accuracy_loss(embedding_scores(spark, folder))
    return out.select("rows", *[rounded(F.col(c)).alias(c) for c in ("loss", "accuracy")])


@query
def weighted_loss(spark: SparkSession, folder: str) -> DataFrame:
    rows = embedding_scores(spark, folder)
    weighted = classes.attach_class_weight(rows, "label", classes.label_index(rows, "label"))
    out = metrics.weighted_loss(weighted)
    return out.select(
        "rows", F.round("loss_sum", 4).alias("loss_sum"), rounded(F.col("loss")).alias("loss")
    )


# --- histories ---


@query
def best_epochs(spark: SparkSession, folder: str) -> DataFrame:
    return progress.best_epochs(event_history(spark, folder))


@query
def plateau_lr(spark: SparkSession, folder: str) -> DataFrame:
    out = progress.plateau_lr(event_history(spark, folder), **PLATEAU)
    return out.withColumn("lr", F.round("lr", 9))


# --- scoring and training ---


def score_lines(kind: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        net, keep = NETWORKS[kind], ["l_orderkey", "l_linenumber"]
        rows = table(spark, folder, "lineitem").select(*keep, line_vector())
        scored = score(rows, net, fixed_weights(net), keep=keep)
        prediction = losses.argmax(F.col("scores")).alias("prediction")
        return scored.select(*keep, *spread("scores", 3, "z"), prediction)

    run.__name__ = f"score_{kind}"
    return run


for _kind in ("rnn", "lstm", "gru", "transformer"):
    query(score_lines(_kind))


@query
def train_gradient_step(spark: SparkSession, folder: str) -> DataFrame:
    """Two synchronous AdamW steps of a linear network, each on the gradient of all rows."""
    rows = write_out(line_rows(spark, folder), "gradient")
    net = NETWORKS["linear"]
    flat = fixed_weights(net)
    optimizer = AdamW(np.zeros(net.size), np.zeros(net.size))
    for _ in range(2):
        done = gradient_round(rows, net, flat)
        mean = done.vector / done.rows
        flat = optimizer.update(flat, mean, RATE)
    out = [
        (name, i, float(g), float(v))
        for (name, values), slopes in zip(unpack(net, flat).items(), unpack(net, mean).values())
        for i, (v, g) in enumerate(zip(values.ravel(), slopes.ravel()))
    ]
    frame = spark.createDataFrame(out, "parameter string, position int, gradient double, value double")
    return frame.select(
        "parameter", "position", *[rounded(F.col(c)).alias(c) for c in ("gradient", "value")]
    )


def train_lines(spark: SparkSession, folder: str, epochs: int = TRAIN_EPOCHS, **options) -> DataFrame:
    """A linear network from fixed weights; every step takes all training rows at once.

    So a result does not depend on the order of rows, and SQL can repeat the steps. Rows are
    split by their order key, and validated on rows that training has not seen.
    """
    rows = hashing.with_split(line_rows(spark, folder), "l_orderkey")
    rows = rows.select("scaled_features", "label", "weight", "split")
    train_rows, val_rows = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
    staged = shards.stage_shards(train_rows, 4, new_path(spark, "train"))
    net = NETWORKS["linear"]
    result = train(
        net, staged, val_rows, epochs, staged.longest, 1, TRAIN_RATE, dtype="float64",
        start=fixed_weights(net), run_id="linear", **options,
    )
    return result.history


def rounded_history(history: DataFrame) -> DataFrame:
    numbers = ("train_loss", "train_acc", "val_loss", "val_acc")
    return history.select(
        "run_id", "epoch", F.round("lr", 9).alias("lr"),
        *[rounded(F.col(c)).alias(c) for c in numbers], "is_best",
    )


@query
def train_network(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_history(train_lines(spark, folder))


@query
def training_history(spark: SparkSession, folder: str) -> DataFrame:
    history = train_lines(spark, folder, scheduler=TRAIN_RULE)
    path = new_path(spark, "history")
    reports.sink_history(history, path)
    return rounded_history(reports.read_history(spark, path))


@query
def train_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Training that ends after each epoch and is called again, from staged rows to history."""
    state = new_path(spark, "state")
    for epochs in range(1, TRAIN_EPOCHS):
        train_lines(spark, folder, epochs, scheduler=TRAIN_RULE, state=state)
    return rounded_history(train_lines(spark, folder, scheduler=TRAIN_RULE, state=state))


@query
def train_lbfgs(spark: SparkSession, folder: str) -> DataFrame:
    """Weights and loss of a linear network after each iteration on all rows."""
    rows = write_out(line_rows(spark, folder), "lbfgs")
    net = NETWORKS["linear"]
    done = run_lbfgs(rows, net, fixed_weights(net), LBFGS_ITERATIONS, LBFGS_MEMORY)
    out = [
        (i + 1, float(p.step), p.loss, at, float(v))
        for i, p in enumerate(done) for at, v in enumerate(p.weights)
    ]
    frame = spark.createDataFrame(out, "iteration int, step double, loss double, position int, value double")
    return frame.withColumns({c: rounded(F.col(c)) for c in ("loss", "value")})


@query
def stream_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    """A stream over labelled files, stopped, and called again when more files have come."""
    rows = line_rows(spark, folder).select("l_linenumber", "scaled_features", "label")
    source, output, state = (new_path(spark, f"evaluated-{x}") for x in ("in", "out", "state"))
    net = NETWORKS["rnn"]
    for part in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
        rows.filter(part).write.mode("append").option("maxRecordsPerFile", STREAM_ROWS).parquet(source)
        counts = run_stream_evaluation(
            spark, source, rows.schema, net, fixed_weights(net), output, state, files_per_trigger=4
        )
    return counts.select("label", "prediction", "n", rounded(F.col("loss") / F.col("n")).alias("mean_loss"))


@query
def evaluate_test_set(spark: SparkSession, folder: str) -> DataFrame:
    net = NETWORKS["gru"]
    lines = table(spark, folder, "lineitem")
    names = metrics.label_names(classes.label_index(lines, "l_returnflag"))
    result = run_evaluation(
        line_rows(spark, folder), net, fixed_weights(net), names, new_path(spark, "evaluation")
    )
    return result.report.select("class", "metric", rounded(F.col("value")).alias("value"))
