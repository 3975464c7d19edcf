"""Weighted data-parallel training as rounds of Spark jobs.

The rows of the staged shards pass the shuffle once for a whole training: each shard's rows
of a round become a partition of a persisted table of blocks. A round is then a job on its
own partitions alone: the parameters are broadcast, every task works through its block, and
the driver adds up one vector per partition. A task holds a partition's rows, so a round of
more than ``HELD_BYTES`` a shard is cut into several where its gradients are only added up;
where a shard's steps follow each other, its rows are read in order instead, a batch at a
time. Where that many vectors of the model's size would
be too much for the driver, a round reads and deals out its rows anew and adds the results
up with a shuffle over slices of the parameter vector, so that the driver receives the sum
alone. A task depends only on the broadcast vector and its rows. Dropout is drawn from a
row's number, so neither the way of a round, the packing of files into tasks nor a task that
runs again changes a result.

``local_steps=1`` averages gradients over all workers after every batch, and the driver
takes the AdamW step. ``local_steps=k`` lets each shard take ``k`` AdamW steps of its own and
averages parameters and moments afterwards, which needs a ``k``-th of the jobs.

After each epoch all that the next one depends on can be written aside and published by one
rename; a training that finds such a record goes on from it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.metrics import counts_summary
from ..operators.progress import Plateau, history_frame
from ..sources.reports import save_weights
from ..sources.shards import Shards, blocks, matrix, together
from ..sources.staging import drop_path, names_in, publish
from .networks import AdamW, Network, initial, weighted_gradient
from .scoring import score_counts

SLICE = 32_768
#: Rows whose gradient is taken at once.
BLOCK_ROWS = 1024
#: Bytes that all partitions' results of a round may have together to go to the driver as they are.
EXCHANGE_BYTES = 64 << 20
#: Partitions of one table of blocks.
HELD_PARTS = 4096
#: Bytes of rows in one partition of blocks, which the task that works on it holds.
HELD_BYTES = 16 << 20


@dataclass(frozen=True)
class Round:
    """Sums of one round over all rows: a parameter-sized vector, the loss, and counts."""

    vector: np.ndarray
    loss: float
    right: int
    rows: int


@dataclass(frozen=True)
class Training:
    weights: np.ndarray
    best_weights: np.ndarray
    best_accuracy: float
    history: DataFrame


def _sliced(vector: np.ndarray, totals: list[float]) -> Iterator[pa.RecordBatch]:
    parts = [vector[i : i + SLICE] for i in range(0, len(vector), SLICE)]
    numbers = [-1, *range(len(parts))]
    values = [np.array(totals, float), *parts]
    for number, value in zip(numbers, values):
        cells = pa.ListArray.from_arrays([0, len(value)], pa.array(value, pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), cells], ["slice", "values"])


def _run_round(rows: DataFrame, work, size: int) -> Round:
    """Run ``work`` on every task and add up the vectors slice by slice."""
    parts = rows.mapInArrow(work, "slice int, values array<double>")
    summed = (
        parts.groupBy("slice")
        .agg(Summarizer.sum(array_to_vector("values")).alias("total"))
        .select("slice", vector_to_array("total").alias("total"))
        .toArrow()
    )
    found = {s: v.values.to_numpy() for s, v in zip(summed["slice"].to_pylist(), summed["total"])}
    if -1 not in found:
        return Round(np.zeros(size), 0.0, 0, 0)
    loss, right, count = found.pop(-1)
    vector = np.concatenate([found[i] for i in sorted(found)])
    return Round(vector, float(loss), int(right), int(round(count)))


class RowDraws:
    """Uniform numbers that depend on a seed, a row's number and the call alone."""

    def __init__(self, seed: tuple[int, ...], numbers: np.ndarray):
        self.key = np.random.SeedSequence(seed).generate_state(1, np.uint64)[0]
        self.rows = _mixed(numbers.astype(np.uint64))
        self.calls = 0

    def random(self, shape: tuple[int, int], dtype: str = "float32") -> np.ndarray:
        self.calls += 1
        with np.errstate(over="ignore"):
            key = _mixed(self.key + np.uint64(self.calls) * _STEP)
            places = _mixed(np.arange(shape[1], dtype=np.uint64) ^ key)
            drawn = _mixed(self.rows[:, None] ^ places[None, :])
        return (drawn >> np.uint64(40)).astype(dtype) * np.dtype(dtype).type(2.0**-24)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _STEP
        return x ^ (x >> np.uint64(29))


def _rows(df: DataFrame, features: str, dtype: str, shard: str | None) -> DataFrame:
    kind = "array<float>" if dtype == "float32" else "array<double>"
    number = F.col("number") if "number" in df.columns else F.lit(0)
    return df.select(
        (F.lit(0) if shard is None else F.col(shard)).cast("int").alias("shard"),
        F.col(features).cast(kind).alias("x"),
        F.col("label").cast("long").alias("y"),
        F.col("weight").cast("double").alias("w"),
        number.cast("long").alias("n"),
    )


def _arrays(block: pa.Table, net: Network, dtype: str, seed: tuple[int, ...] | None):
    y = block["y"].to_numpy()
    if len(y) and (y.min() < 0 or y.max() >= net.num_classes):
        raise ValueError(f"labels must lie in 0..{net.num_classes - 1}")
    x = matrix(block["x"].combine_chunks(), net.num_features, dtype)
    draws = None if seed is None else RowDraws(seed, block["n"].to_numpy())
    return x, y, block["w"].to_numpy(), draws


def _numbered(df: DataFrame, seed: tuple[int, ...] | None) -> None:
    if seed is not None and "number" not in df.columns:
        raise ValueError("dropout is drawn by row, so rows need a column number")


def gradient_round(
    df: DataFrame,
    net: Network,
    flat: np.ndarray,
    seed: tuple[int, ...] | None = None,
    block_rows: int = BLOCK_ROWS,
    features: str = "scaled_features",
    dtype: str = "float64",
) -> Round:
    """Gradient of the summed weighted loss over all rows. ``seed`` turns dropout on."""
    _numbered(df, seed)
    shared = df.sparkSession.sparkContext.broadcast(flat)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, seen = np.zeros(len(shared.value)), np.zeros(2), 0
        for _, block in blocks(batches, block_rows):
            arrays = _arrays(block, net, dtype, seed)
            gradient, loss, right = weighted_gradient(net, shared.value, *arrays)
            total += gradient
            sums += loss, right
            seen += block.num_rows
        if seen:
            yield from _sliced(total, [*sums, seen])

    try:
        return _run_round(_rows(df, features, dtype, None), work, len(flat))
    finally:
        shared.destroy()


def local_round(
    df: DataFrame,
    count: int,
    net: Network,
    flat: np.ndarray,
    optimizer: AdamW,
    rate: float,
    batch_size: int,
    seed: tuple[int, ...] | None = None,
    features: str = "scaled_features",
    dtype: str = "float64",
) -> Round:
    """Let each of ``count`` shards take its own steps; sums of rows x (parameters, moments), to be averaged."""
    _numbered(df, seed)
    state = (flat, optimizer.first, optimizer.second, optimizer.steps)
    shared = df.sparkSession.sparkContext.broadcast(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen, sums = None, 0, np.zeros(2)
        place, own = np.empty(0), None

        def result():
            whole = np.concatenate([place, own.first, own.second])
            return _sliced(whole * seen, [*sums, seen])

        for shard, block in blocks(batches, batch_size):
            if shard != current:
                if current is not None:
                    yield from result()
                place, first, second, steps = shared.value
                own, current, seen, sums = AdamW(first, second, steps), shard, 0, np.zeros(2)
            arrays = _arrays(block, net, dtype, seed)
            gradient, loss, right = weighted_gradient(net, place, *arrays)
            place = own.update(place, gradient / block.num_rows, rate)
            sums += loss, right
            seen += block.num_rows
        if current is not None:
            yield from result()

    try:
        return _run_round(_rows(together(df, count), features, dtype, "shard"), work, 3 * len(flat))
    finally:
        shared.destroy()


class HeldBlocks:
    """The rows of all rounds as a persisted table: partitions for each round and shard.

    A partition has the rows of ``cut`` positions, of all of a round by default.
    Scanning tasks pack their rows into pieces of blocks, as arrays, which pass one shuffle;
    what a partition holds is read by the one task of its round. A lost partition is made
    again from the staged files. A table has a bounded number of partitions, so a long
    training has several, each made when its first round comes.
    """

    def __init__(
        self, shards: Shards, net: Network, dtype: str, batch_size: int, windows: list[tuple], cut: int | None = None
    ):
        self.shards, self.net, self.dtype = shards, net, dtype
        self.batch_size, self.windows = batch_size, windows
        self.cut = cut or windows[0][1] - windows[0][0]
        self.places = cuts_of(windows[0], self.cut) * shards.count
        self.rounds = max(1, HELD_PARTS // self.places)
        self.tables: dict[int, tuple[DataFrame, RDD]] = {}

    def close(self) -> None:
        for table, _ in self.tables.values():
            table.unpersist()
        self.tables.clear()

    def _table(self, number: int) -> RDD:
        if number not in self.tables:
            some = self.windows[number * self.rounds : (number + 1) * self.rounds]
            packed = packed_blocks(
                self.shards, self.net, self.dtype, some[0][0], some[-1][1], some[0][1] - some[0][0], len(some),
                self.cut,
            )
            packed.persist(StorageLevel.MEMORY_AND_DISK)
            self.tables[number] = packed, packed.drop("place").rdd
        return self.tables[number][1]

    def run(self, number: int, work) -> Round:
        """Add up what ``work`` makes of each shard's rows (x, y, weight, number) of one round."""
        net, dtype = self.net, self.dtype

        def task(pieces):
            held = sorted(((np.frombuffer(p.n, "int64"), p) for p in pieces), key=lambda p: p[0][0])
            if held:
                x = np.concatenate([np.frombuffer(p.x, dtype).reshape(-1, net.num_features) for _, p in held])
                y, w = (np.concatenate([np.frombuffer(p[c], t) for _, p in held]) for c, t in (("y", "int64"), ("w", "float64")))
                n = np.concatenate([n for n, _ in held])
                order = np.argsort(n)
                vector, loss, right = work(x[order], y[order], w[order], n[order])
                yield vector.tobytes(), vector.dtype.str, loss, right, len(y)

        first = number % self.rounds * self.places
        places = range(first, first + cuts_of(self.windows[number], self.cut) * self.shards.count)
        found = self.shards.spark.sparkContext.runJob(self._table(number // self.rounds), task, list(places))
        vector, totals = 0.0, np.zeros(3)
        for values, kind, *sums in found:
            vector = vector + np.frombuffer(values, kind).astype(float)
            totals += sums
        return Round(np.asarray(vector), float(totals[0]), int(totals[1]), int(totals[2]))

    def gradient(self, number: int, flat: np.ndarray, seed: tuple[int, ...] | None, block_rows: int = BLOCK_ROWS) -> Round:
        """As :func:`gradient_round` over the rows of one round."""
        net = self.net
        shared = self.shards.spark.sparkContext.broadcast(flat.astype(self.dtype))

        def work(x, y, w, n):
            total, loss, right = np.zeros(net.size), 0.0, 0
            for at in range(0, len(y), block_rows):
                cut = slice(at, at + block_rows)
                draws = None if seed is None else RowDraws(seed, n[cut])
                gradient, more, hits = weighted_gradient(net, shared.value, x[cut], y[cut], w[cut], draws)
                total += gradient
                loss, right = loss + more, right + hits
            return total, loss, right

        try:
            return self.run(number, work)
        finally:
            shared.destroy()

    def local(
        self, number: int, flat: np.ndarray, optimizer: AdamW, rate: float, seed: tuple[int, ...] | None
    ) -> Round:
        """As :func:`local_round` over the rows of one round."""
        net, batch_size = self.net, self.batch_size
        shared = self.shards.spark.sparkContext.broadcast((flat, optimizer.first, optimizer.second, optimizer.steps))

        def work(x, y, w, n):
            place, first, second, steps = shared.value
            own, loss, right = AdamW(first, second, steps), 0.0, 0
            for at in range(0, len(y), batch_size):
                cut = slice(at, at + batch_size)
                draws = None if seed is None else RowDraws(seed, n[cut])
                gradient, more, hits = weighted_gradient(net, place, x[cut], y[cut], w[cut], draws)
                place = own.update(place, gradient / len(y[cut]), rate)
                loss, right = loss + more, right + hits
            return np.concatenate([place, own.first, own.second]) * len(y), loss, right

        try:
            return self.run(number, work)
        finally:
            shared.destroy()


def packed_blocks(
    shards: Shards, net: Network, dtype: str, first: int, end: int, width: int, rounds: int, cut: int
) -> DataFrame:
    """(place, x, y, w, n): pieces of blocks as bytes, with a partition for each place.

    A place is ``(round * cuts + part) * count + shard``, where a round of ``width`` positions
    has ``cuts`` parts of ``cut`` positions.
    """
    count, cuts = shards.count, cuts_of((0, width), cut)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, w, _ = _arrays(pa.Table.from_batches([batch]), net, dtype, None)
            n = batch.column(4).to_numpy()
            turn, within = np.divmod(n // count - first, width)
            place = (turn * cuts + within // cut) * count + n % count
            order = np.lexsort((n, place))
            places, starts = np.unique(place[order], return_index=True)
            picks = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
            cells = [[v[pick].tobytes() for pick in picks] for v in (x, y.astype("int64"), w.astype("float64"), n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), *[pa.array(c, pa.binary()) for c in cells]],
                names=["place", "x", "y", "w", "n"],
            )

    rows = _rows(shards.window(first, end), "scaled_features", dtype, "shard")
    pieces = rows.mapInArrow(pack, "place int, x binary, y binary, w binary, n binary")
    return pieces.repartitionById(rounds * cuts * count, F.col("place"))


def cuts_of(window: tuple, cut: int) -> int:
    """Parts of ``cut`` positions that a round has."""
    return -(-(window[1] - window[0]) // cut)


def held_positions(net: Network, dtype: str, held_bytes: int) -> int:
    """Positions of a shard whose rows have at most so many bytes, in whole blocks of a gradient."""
    row = net.num_features * np.dtype(dtype).itemsize + 24
    return max(held_bytes // row // BLOCK_ROWS, 1) * BLOCK_ROWS


@dataclass
class State:
    """All that an epoch depends on, after the one before."""

    epoch: int
    flat: np.ndarray
    optimizer: AdamW
    rate: float
    rule: Plateau | None
    best: float
    best_flat: np.ndarray
    history: list[dict]


VERSION = 1


def save_state(spark: SparkSession, path: str, state: State, settings: dict) -> None:
    """Write a record of the epoch aside, publish it by one rename, then drop the older ones."""
    facts = {
        "version": VERSION, "settings": settings, "epoch": state.epoch, "steps": state.optimizer.steps,
        "rate": state.rate, "rule": state.rule and vars(state.rule), "best": state.best, "history": state.history,
    }
    vectors = {
        "flat": state.flat, "first": state.optimizer.first, "second": state.optimizer.second, "best": state.best_flat
    }
    rows = [("facts", 0, json.dumps(facts), None)]
    for name, vector in vectors.items():
        rows += [(name, i, None, vector[i : i + SLICE].tolist()) for i in range(0, len(vector), SLICE)]
    aside = f"{path}/writing-{uuid.uuid4().hex}"
    frame = spark.createDataFrame(rows, "name string, first int, facts string, values array<double>")
    frame.coalesce(1).write.parquet(aside)
    publish(spark, aside, f"{path}/epoch-{state.epoch:06d}")
    for name in names_in(spark, path):
        if name < f"epoch-{state.epoch:06d}" or name.startswith("writing-"):
            drop_path(spark, f"{path}/{name}")


def load_state(spark: SparkSession, path: str, settings: dict) -> State | None:
    """The last published record, if there is one. A record of other settings stops the run."""
    found = [name for name in names_in(spark, path) if name.startswith("epoch-")]
    if not found:
        return None
    rows = spark.read.parquet(f"{path}/{found[-1]}").orderBy("name", "first").collect()
    facts = json.loads(next(r.facts for r in rows if r.name == "facts"))
    if facts["version"] != VERSION or facts["settings"] != json.loads(json.dumps(settings)):
        raise ValueError(f"{path} holds the state of another training: {facts['settings']}")
    vectors = {
        name: np.concatenate([np.array(r["values"], float) for r in rows if r.name == name])
        for name in ("flat", "first", "second", "best")
    }
    rule = Plateau(**facts["rule"]) if facts["rule"] else None
    return State(
        facts["epoch"], vectors["flat"], AdamW(vectors["first"], vectors["second"], facts["steps"]),
        facts["rate"], rule, facts["best"], vectors["best"], facts["history"],
    )


def _windows(shards: Shards, batch_size: int, local_steps: int, drop_remainder: bool):
    """Positions of each round, ``local_steps`` batches of every shard, and the rows they hold."""
    width, end = batch_size * local_steps, shards.longest
    if not shards.rows:
        raise ValueError("no training rows")
    if drop_remainder:
        end = shards.rows // (batch_size * shards.count) * batch_size
        if not end:
            raise ValueError("fewer training rows than one step takes")
    rounds = []
    for first in range(0, end, width):
        last = min(first + width, end)
        held = min(last * shards.count, shards.rows) - first * shards.count
        rounds.append((first, last, held))
    return rounds


def train(
    net: Network,
    shards: Shards,
    validation: DataFrame,
    epochs: int,
    batch_size: int = 1024,
    local_steps: int = 16,
    learning_rate: float = 0.002,
    scheduler: dict | None = None,
    seed: int = 0,
    drop_remainder: bool = False,
    dtype: str = "float32",
    output: str | None = None,
    run_id: str | None = None,
    start: np.ndarray | None = None,
    state: str | None = None,
    exchange_bytes: int = EXCHANGE_BYTES,
    held_bytes: int = HELD_BYTES,
) -> Training:
    """Train, validate on all executors after every epoch, keep the best weights and the history.

    ``scheduler`` holds ``factor``, ``patience`` and ``min_lr`` of the plateau rule; there is
    one rate for all workers. With ``output`` the best weights are written whenever the
    validation accuracy rises above all earlier ones. With ``state`` a record of each epoch is
    published in that folder, and a call that finds one goes on after its epoch: the result
    is that of a run that never stopped. Results of a round go to the driver by partition while
    they have at most ``exchange_bytes`` together, and are summed by a shuffle beyond. A
    partition has about ``held_bytes`` of rows, or one block.
    """
    spark = shards.frame.sparkSession
    flat = initial(net, seed) if start is None else np.array(start, float)
    rule = Plateau(learning_rate, **scheduler) if scheduler else None
    settings = {
        "net": vars(net), "rows": shards.rows, "shards": shards.count, "batch_size": batch_size,
        "local_steps": local_steps, "learning_rate": learning_rate, "scheduler": scheduler, "seed": seed,
        "drop_remainder": drop_remainder, "dtype": dtype, "start": float(flat.sum()),
    }
    now = load_state(spark, state, settings) if state else None
    now = now or State(0, flat, AdamW(np.zeros(net.size), np.zeros(net.size)), learning_rate, rule, 0.0, flat, [])
    run_id = now.history[0]["run_id"] if now.history else run_id or f"{net.kind}-{uuid.uuid4().hex[:8]}"
    windows = _windows(shards, batch_size, local_steps, drop_remainder)
    dropout_on = net.dropout > 0 and net.kind != "linear"
    cut = held_positions(net, dtype, held_bytes)
    parts = cuts_of(windows[0], cut)
    size = 8 * net.size * (1 if local_steps == 1 else 3) * shards.count * parts
    # Only gradients can be added up over parts; steps of a shard's own follow each other.
    holds = size <= exchange_bytes and (local_steps == 1 or parts == 1)
    held = HeldBlocks(shards, net, dtype, batch_size, windows, cut) if holds else None
    try:
        while now.epoch < epochs:
            done = _epoch(now, shards, held, windows, net, batch_size, local_steps, seed if dropout_on else None, dtype)
            _validated(now, done, validation, net, dtype, run_id, output)
            if state:
                save_state(spark, state, now, settings)
    finally:
        if held:
            held.close()
    return Training(now.flat, now.best_flat, now.best, history_frame(spark, now.history))


def _epoch(
    now: State,
    shards: Shards,
    held: HeldBlocks | None,
    windows: list[tuple],
    net: Network,
    batch_size: int,
    local_steps: int,
    seed: int | None,
    dtype: str,
) -> tuple[float, int, int]:
    """All rounds of the next epoch: moves the weights of ``now`` on, and gives loss, hits and rows."""
    loss, right, rows = 0.0, 0, 0
    for number, (first, end, expected) in enumerate(windows):
        key = None if seed is None else (seed, now.epoch + 1, number)
        if local_steps == 1 and held:
            done = held.gradient(number, now.flat, key)
        elif local_steps == 1:
            dealt = shards.window(first, end).repartitionById(shards.count, F.col("shard"))
            done = gradient_round(dealt, net, now.flat, key, dtype=dtype)
        elif held:
            done = held.local(number, now.flat, now.optimizer, now.rate, key)
        else:
            part = shards.window(first, end)
            done = local_round(
                part, shards.count, net, now.flat, now.optimizer, now.rate, batch_size, key, dtype=dtype
            )
        if done.rows != expected:
            raise RuntimeError(f"a round of {expected} rows worked on {done.rows}")
        if local_steps == 1:
            now.flat = now.optimizer.update(now.flat, done.vector / done.rows, now.rate)
        else:
            now.flat, moment1, moment2 = np.split(done.vector / done.rows, 3)
            # The first shard has a row at every position, so it took all these steps.
            steps = now.optimizer.steps + -(-(end - first) // batch_size)
            now.optimizer = AdamW(moment1, moment2, steps)
        loss, right, rows = loss + done.loss, right + done.right, rows + done.rows
    return loss, right, rows


def _validated(
    now: State,
    done: tuple[float, int, int],
    validation: DataFrame,
    net: Network,
    dtype: str,
    run_id: str,
    output: str | None,
) -> None:
    """End an epoch: validate, keep the best weights, add to the history, set the next rate."""
    spark = validation.sparkSession
    loss, right, rows = done
    shared = spark.sparkContext.broadcast(now.flat.astype(dtype))
    try:
        checked = counts_summary(score_counts(validation, net, shared, dtype=dtype)).first()
    finally:
        shared.destroy()
    now.epoch += 1
    is_best = checked.accuracy > now.best
    if is_best:
        now.best, now.best_flat = checked.accuracy, now.flat
        if output:
            save_weights(spark, net, now.flat, f"{output}/best_weights")
    now.history.append(
        {
            "run_id": run_id, "epoch": now.epoch, "lr": now.rate,
            "train_loss": loss / rows, "train_acc": right / rows,
            "val_loss": checked.loss, "val_acc": checked.accuracy, "is_best": is_best,
        }
    )
    if now.rule:
        now.rate = now.rule.step(checked.loss)
