"""Timings of the headline queries: one JSON line.

Folder from BENCH_SF_DIR, threads from BENCH_CPUS. Every query runs over its whole
table, after a warm-up on the smallest folder. The networks have the sizes of the published runs, 43 features and 16 classes; their
rows are made by Spark from the line items.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice import catalog  # noqa: E402
from sluice.functions.hashing import with_split  # noqa: E402
from sluice.plans.networks import Network, create_network, initial  # noqa: E402
from sluice.plans.scoring import score_counts  # noqa: E402
from sluice.plans.training import train  # noqa: E402
from sluice.sources.shards import stage_shards  # noqa: E402
from sluice.sources.staging import new_path, write_out  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FEATURES, CLASSES, BATCH = 43, 16, 1024

# Hidden sizes and layers of the published runs.
SIZES = {"rnn": (64, 2), "gru": (128, 3), "lstm": (256, 3)}

PLAIN = [
    "preprocess", "preprocess_fit_on_train", "transform_roundtrip", "index_categories",
    "standard_scale", "scaler_stats", "filter_rare_classes", "attach_class_weight",
    "class_weights", "label_index", "hash_split", "sample_fraction", "confusion_matrix",
    "classification_report", "weighted_loss", "batch_scan", "stage_shards", "stream_score",
    "plateau_lr", "best_epochs", "train_gradient_step", "evaluate_test_set", "train_network",
    "train_resumed", "train_lbfgs", "preprocess_merged", "stream_evaluate",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sluice-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "2m")  # small files still use all cores
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sluice-bench-"))
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def wide_rows(spark: SparkSession) -> DataFrame:
    """All line items with 43 features, a label of 16 classes and a weight."""
    base = [F.col("l_quantity") / 50, F.col("l_extendedprice") / 1e5, F.col("l_discount") * 10,
            F.col("l_tax") * 10]
    cells = [F.sin(base[i % 4] * (i + 1)) for i in range(FEATURES)]
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").repartition(int(CPUS))
    return lines.select(
        F.array(*cells).alias("scaled_features"),
        F.pmod(F.col("l_suppkey"), F.lit(CLASSES)).cast("double").alias("label"),
        (F.lit(0.5) + F.col("l_discount")).alias("weight"),
    )


def network(kind: str) -> Network:
    hidden, layers = SIZES[kind]
    return create_network(
        kind, FEATURES, CLASSES, hidden_size=hidden, num_layers=layers, dropout=0.15
    )


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    small = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in PLAIN:  # warms up the JVM and the Python workers
            catalog.QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in PLAIN:
        query = catalog.QUERIES[name]
        seconds[name] = timed(
            lambda: query(spark, FOLDER).write.format("noop").mode("overwrite").save()
        )

    rows = write_out(wide_rows(spark), "bench")
    total = rows.count()
    few = write_out(rows.limit(1000), "bench-validation")
    part = stage_shards(rows, int(CPUS), new_path(spark, "bench-shards"))
    steps_each = -(-part.longest // BATCH)
    rates: dict[str, int] = {}
    for kind in SIZES:
        net = network(kind)
        flat = initial(net)
        key = f"score_{kind}_published"
        seconds[key] = timed(lambda: score_counts(rows, net, flat, dtype="float32").collect())
        rates[key] = int(total / seconds[key])
        for steps in (16, 1):
            # Whole training calls over all rows: dealing them out and validation on a few included.
            key = f"train_{kind}_published_local_steps_{steps}"
            seconds[key] = timed(
                lambda: train(
                    net, part, few, 1, BATCH, steps, 0.001, start=flat, dtype="float32"
                )
            )
            rates[key] = int(part.rows / seconds[key])
    split = with_split(spark.read.parquet(f"{FOLDER}/orders.parquet"), "o_orderkey")
    seconds["write_splits"] = timed(
        lambda: split.write.partitionBy("split").parquet(new_path(spark, "bench-splits"))
    )
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": rates,
                "training": f"one epoch over all {total} rows, {steps_each} steps of {BATCH} rows on each of"
                f" {CPUS} shards, dealing out and validation of 1000 rows included",
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
