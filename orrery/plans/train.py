"""Distributed training: local mini-batch Adam per shard, weights averaged per epoch.

One Spark job per epoch, for one network or for a whole grid of them.  The
train split is hash-sharded on the record id into K shards (``repartitionById``:
partition = shard), sorted by id, packed and checkpointed once; a task trains a
team of configurations on one shard, side by side.  Each epoch broadcasts (weights, Adam moments, step) of
every configuration; each task streams its Arrow batches re-cut to mini-batches
of 32 in id order and writes its final state, and a line of history every ten
steps, to Parquet.  The states are combined as the row-weighted mean by levels
of ``FAN_IN``, so that the driver receives one state a configuration for any K.
K = 1 is the reference algorithm exactly; K > 1 is the scale path (local SGD
with model averaging).  A task is a pure function of (broadcast, shard), so
retries and speculative copies are harmless.  K is a parameter, never derived
from data or cluster, so results depend on (K, seed) only.

After each epoch a checkpoint holds weights, Adam moments, step, epoch and the
metrics so far: a run that was cut off goes on from its last whole version and
ends with the weights of a run that was not.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path, ship_package
from ..sources.models import delete_path, last_version, load_state, path_exists, save_model
from .net import NetSpec, forward, init_params, loss_and_grad, train_passes
from .score import arrow_matrix, evaluate, predict, report

#: Shards of the train split.  A parameter of the algorithm, never derived from the data: 1 is plain mini-batch Adam,
#: more are trained side by side and averaged each epoch.  Set it to the cores that training should use.
SHARDS = 8
#: States that one task merges; the driver receives the one that is left.
FAN_IN = 16
#: Steps between two lines of the iteration history.
HISTORY_EVERY = 10
#: Rows of a pack, and bytes of packs that a task is handed at a time (more of them leave the core's cache).
PACK_ROWS, PACK_BYTES = 256, "1m"
#: Iteration history (T1): the loss of batch ``step`` of a shard, and the records since the line before and a second.
HISTORY = "config int, epoch int, shard int, step long, rows long, loss double, records_per_second double"


@dataclass
class FitResult:
    spec: NetSpec
    theta: np.ndarray
    metrics: list[dict] = field(default_factory=list)   # epoch, split, task, auc, n_classes, loss, rows, seconds
    shards: int = 1
    checkpoint_path: str | None = None
    log_path: str | None = None
    config: int = 0
    best_epoch: int | None = None       # with early stopping: the epoch whose weights these are
    stopped_after: int | None = None    # and the last epoch that was judged, if it stopped

    def history(self, spark: SparkSession) -> DataFrame:
        """The lines that the tasks wrote (``HISTORY``)."""
        return read_history(spark, self.log_path).where(F.col("config") == self.config)


def read_history(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(f"{log_path}/epoch-*/kind=history")


def prepare(df: DataFrame, spec: NetSpec, features: str = "features", id_col: str = "record_id",
            split_col: str = "split", path: str | None = None) -> DataFrame:
    """Narrow, typed input in the shared folder, by split: (id, features, labels as double, split).

    A label that is no class of its head fails the job; a null label is left out of its task's loss.
    """
    cols = [F.col(id_col).alias("record_id"), F.col(split_col).alias("split"),
            F.col(features).cast("array<double>").alias("features")]
    for h in spec.heads:
        y = F.col(h.label).cast("double")
        top = 1 if h.n == 1 else h.n - 1
        right = y.isNull() | ((y >= 0) & (y <= top) & (y == F.floor(y)) & ~F.isnan(y))
        cols.append(F.when(right, y).otherwise(F.raise_error(F.concat(
            F.lit(f"label {h.label} is not a class of 0..{top}: "), y.cast("string")))).alias(h.label))
    path = path or scratch_path(df.sparkSession, "prepared")
    df.select(*cols).write.mode("overwrite").partitionBy("split").parquet(path)  # reading one split opens its files only
    return open_prepared(df.sparkSession, path, spec, dict(df.dtypes)[id_col])


def open_prepared(spark: SparkSession, path: str, spec: NetSpec, id_type: str = "bigint") -> DataFrame | None:
    """What ``prepare`` wrote under ``path``; None if it is not there as a whole."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    schema = f"record_id {id_type}, features array<double>" + "".join(f", `{h.label}` double" for h in spec.heads)
    return spark.read.schema(schema + ", split string").parquet(path)


def fit_standardizer(packs: DataFrame, width: int) -> tuple[list[float], list[float]]:
    """Per-position mean and population std over the packed train split (two passes, ``width`` rows out of each)."""
    n, total = _position_sums(packs, np.zeros(width), 1)
    if n == 0:
        return [0.0] * width, [1.0] * width
    mean = total / n
    sd = np.sqrt(_position_sums(packs, mean, 2)[1] / n)
    return mean.tolist(), np.where(sd > 1e-12, sd, 1.0).tolist()


def _position_sums(packs: DataFrame, off: np.ndarray, power: int) -> tuple[int, np.ndarray]:
    """Rows, and per position the sum of (x - off)^power: tasks add up their rows, Spark the tasks in their order."""
    ship_package(packs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        n, total = 0, np.zeros(len(off))
        for b in batches:
            if b.num_rows:
                X = _unpacked(b.column("features"), len(off))
                n += len(X)
                total += ((X - off) ** power).sum(axis=0)
        if n:
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(off), dtype=np.int32)),
                                              pa.array([at] * len(off), pa.int32()), pa.array([n] * len(off)),
                                              pa.array(total)], ["pos", "task", "n", "s"])

    tasks = F.sort_array(F.collect_list(F.struct("task", "s")))
    with _arrow_bytes(packs.sparkSession, PACK_BYTES):
        sums = (packs.mapInArrow(run, "pos int, task int, n long, s double").groupBy("pos")
                .agg(F.sum("n").alias("n"), F.aggregate(tasks, F.lit(0.0), lambda a, x: a + x["s"]).alias("s")).collect())
    out = np.zeros(len(off))
    for r in sums:
        out[r["pos"]] = r["s"]
    return (sums[0]["n"] if sums else 0), out


def shard(train: DataFrame, k: int, spec: NetSpec) -> DataFrame:
    """Partition i holds shard i, rows in id order, packed; checkpointed for all epochs."""
    rows = (train.withColumn("__shard", F.pmod(F.xxhash64("record_id"), F.lit(k)).cast("int"))
            .repartitionById(k, "__shard")
            .sortWithinPartitions("record_id")
            .drop("__shard"))
    return _packed(rows, spec).checkpoint(eager=True)


def _packed(rows: DataFrame, spec: NetSpec) -> DataFrame:
    """Up to ``PACK_ROWS`` rows of a split in their order: the bytes of a matrix of features and of one of labels.

    Every epoch reads them; one by one, array by array, that takes Spark three times as long.
    """
    ship_package(rows.sparkSession)
    width, labels = spec.n_in, [h.label for h in spec.heads]

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            X = arrow_matrix(b.column("features"), width)
            Y = np.stack([b.column(x).to_numpy(zero_copy_only=False).astype(np.float64) for x in labels], axis=1)
            splits, packs = b.column("split"), []
            for s in splits.unique().to_pylist():
                at = np.flatnonzero(pc.equal(splits, s).to_numpy(zero_copy_only=False))
                packs += [(s, at[i:i + PACK_ROWS]) for i in range(0, len(at), PACK_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in packs], pa.string()), pa.array([len(at) for _, at in packs], pa.int32()),
                 *(pa.array([M[at].tobytes() for _, at in packs], pa.binary()) for M in (X, Y))],
                ["split", "rows", "features", "labels"])

    cols = [F.col("features").cast("array<double>").alias("features"),
            *[F.col(x).cast("double").alias(x) for x in dict.fromkeys(labels)]]
    return rows.select("split", *cols).mapInArrow(run, "split string, rows int, features binary, labels binary")


def _unpacked(col: pa.Array, width: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer()) for x in col]).reshape(-1, width)


_STATE = "config int, epoch int, shard int, rows long, step long, loss double, theta binary, m binary, v binary, " \
         "hist binary, losses binary"
_EPOCH_SCHEMA = f"kind string, {_STATE}, records_per_second double"

EVAL_SPLITS = ("train", "valid")


def _slots(spec: NetSpec) -> list[tuple[int, str, int]]:
    """(head index, task, class) of every one-vs-rest ROC histogram."""
    return [(i, h.task, c) for i, h in enumerate(spec.heads) for c in range(h.n)]


def _hist_shapes(spec: NetSpec, steps: int):
    return (len(EVAL_SPLITS), len(_slots(spec)), steps + 1, 2), (len(EVAL_SPLITS), len(spec.heads), 2)


def _accumulate(sp: NetSpec, probs, Y, split_idx: int, H, L, steps: int) -> None:
    """Add one chunk's ROC histograms (positives, negatives per bin) and loss sums."""
    from .net import CLIP
    slot = 0
    for hi, h in enumerate(sp.heads):
        y, p = Y[h.task], probs[h.task]
        ok = ~np.isnan(y)
        if not ok.all():
            y, p = y[ok], p[ok]
        if h.n == 1:
            cols = [(p, y == 1)]
            loss = -(y * np.log(np.clip(p, CLIP, 1 - CLIP)) + (1 - y) * np.log(np.clip(1 - p, CLIP, 1 - CLIP)))
        else:
            yi = y.astype(np.int64)
            cols = [(p[:, c], yi == c) for c in range(h.n)]
            loss = -np.log(np.clip(p[np.arange(len(yi)), yi], CLIP, 1 - CLIP))
        L[split_idx, hi, 0] += float(loss.sum())
        L[split_idx, hi, 1] += len(y)
        for q, pos in cols:
            bins = np.clip(np.floor(np.round(q * steps, 9)), 0, steps).astype(np.int64)
            H[split_idx, slot] += np.bincount(2 * bins + ~pos, minlength=2 * (steps + 1)).reshape(-1, 2)
            slot += 1


def _metrics_from(spec: NetSpec, H, L, splits: Sequence[str]) -> list[dict]:
    """Binned AUC per (split, task) -- macro over classes -- and mean loss, from merged histograms."""
    from .score import trapezoid_auc
    out = []
    slots = _slots(spec)
    for si, s in enumerate(EVAL_SPLITS):
        if s not in splits:
            continue
        for hi, h in enumerate(spec.heads):
            n = int(L[si, hi, 1])
            if n == 0:
                continue
            aucs = [trapezoid_auc([(b, int(H[si, k, b, 0]), int(H[si, k, b, 1])) for b in range(H.shape[2])
                                   if H[si, k, b, 0] or H[si, k, b, 1]])
                    for k, (hj, _t, _c) in enumerate(slots) if hj == hi]
            defined = [a for a in aucs if a is not None]
            out.append({"split": s, "task": h.task, "auc": float(np.mean(defined)) if defined else None,
                        "n_classes": len(defined), "loss": float(L[si, hi, 0] / n), "rows": n})
    return out


@dataclass
class _State:
    """Weights, Adam moments and steps of one configuration."""

    theta: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int = 0


@dataclass
class _Sums:
    """What the tasks of one configuration add up to; states are weighted by their rows."""

    rows: int
    theta: np.ndarray | None
    m: np.ndarray | None
    v: np.ndarray | None
    steps: int
    hist: np.ndarray
    losses: np.ndarray

    def add(self, other: _Sums) -> _Sums:
        if other.rows and self.rows:
            theta, m, v = self.theta + other.theta, self.m + other.m, self.v + other.v
        else:
            theta, m, v = (self.theta, self.m, self.v) if self.rows else (other.theta, other.m, other.v)
        return _Sums(self.rows + other.rows, theta, m, v, max(self.steps, other.steps), self.hist + other.hist,
                     self.losses + other.losses)


def _epoch_job(data: DataFrame, specs: dict[int, NetSpec], states: dict[int, _State], log: str, epoch: int,
               train: bool = True, evaluate: Sequence[str] = EVAL_SPLITS, steps: int = 100,
               teams: Sequence[Sequence[int]] | None = None) -> dict[int, _Sums]:
    """One pass over the packed ``data``: (team, shard) partitions, optionally followed by evaluation-only ones.

    ``config`` names the first configuration of a team (without ``teams`` each
    is one of its own), all of which see the partition's rows.  Every chunk of
    the splits in ``evaluate`` is first scored with the incoming weights (ROC
    histograms and loss sums of the previous epoch's models), then, for rows of
    the train split, used for mini-batch Adam.  Tasks write their states and
    their history under ``log`` (exactly once, by Spark's commit); a second job
    merges the states.  Returns the sums of each configuration.
    """
    spark = data.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(({c: s.to_json() for c, s in specs.items()},
                                       {c: (s.theta, s.m, s.v, s.t) for c, s in states.items()}))
    shapes = {c: _hist_shapes(s, steps) for c, s in specs.items()}
    members = {t[0]: list(t) for t in (teams if teams is not None else [[c] for c in specs])}

    def run(batches):
        from pyspark import TaskContext
        team, sps, sums = [], [], []
        lines: list[tuple] = []
        t0 = time.time()

        def chunks():
            nonlocal team, sps, sums
            for b in batches:
                if b.num_rows == 0:
                    continue
                if not team:
                    team = members[b.column("config")[0].as_py()]
                    sps = [NetSpec.from_json(bc.value[0][c]) for c in team]
                    sums = [(np.zeros(shapes[c][0], dtype=np.int64), np.zeros(shapes[c][1])) for c in team]
                X, Y = _unpacked(b.column("features"), sps[0].n_in), _unpacked(b.column("labels"), len(sps[0].heads))
                splits = np.repeat(b.column("split").to_numpy(zero_copy_only=False), b.column("rows").to_numpy())
                for s in set(splits):
                    at = splits == s
                    x, y = (X, Y) if at.all() else (X[at], Y[at])
                    if s in evaluate:
                        for c, sp, (H, L) in zip(team, sps, sums):
                            _accumulate(sp, forward(sp, bc.value[1][c][0], x),
                                        {h.task: y[:, i] for i, h in enumerate(sp.heads)}, EVAL_SPLITS.index(s), H, L, steps)
                    if train and s == "train":
                        yield x, {h.task: y[:, i] for i, h in enumerate(sps[0].heads)}

        def on_step(step: int, rows: int, losses: list[float], last: bool) -> None:
            nonlocal since, t0
            if rows > since:
                now = time.time()
                lines.append((step, rows - since, losses, (rows - since) / max(now - t0, 1e-9)))
                since, t0 = rows, now

        since = 0
        stream = chunks()
        first = next(stream, None)  # names the team
        trained, rows, n_steps, loss_sums = [None] * len(team), 0, 0, [0.0] * len(team)
        if first is not None:
            old = [bc.value[1][c] for c in team]
            trained, _, rows, n_steps, loss_sums = train_passes(sps, [x[:3] for x in old], old[0][3], _again(first, stream),
                                                                on_step=on_step, every=HISTORY_EVERY)
        if not team:
            return
        shard_id = TaskContext.get().partitionId()
        out = []
        for i, (c, (H, L)) in enumerate(zip(team, sums)):
            each = {"config": c, "epoch": epoch, "shard": shard_id}
            state = {"kind": "state", "rows": rows, "step": n_steps, "loss": loss_sums[i], "hist": H.tobytes(),
                     "losses": L.tobytes()}
            if rows:
                state |= dict(zip(("theta", "m", "v"), (x.tobytes() for x in trained[i])))
            out += [each | state, *(each | {"kind": "history", "step": step, "rows": n, "loss": losses[i],
                                            "records_per_second": rate} for step, n, losses, rate in lines)]
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    out = f"{log}/epoch-{epoch:04d}"
    with _arrow_bytes(spark, PACK_BYTES):
        data.mapInArrow(run, _EPOCH_SCHEMA).write.mode("overwrite").partitionBy("kind").parquet(out)
    states_path = f"{out}/kind=state"

    def to_sums(r):
        n, f = r["rows"], float(r["rows"])
        parts = [np.frombuffer(r[k]) * f if n else None for k in ("theta", "m", "v")]
        hshape, lshape = shapes[r["config"]]
        return r["shard"], (r["config"], _Sums(n, *parts, r["step"], np.frombuffer(r["hist"], dtype=np.int64).reshape(hshape),
                                               np.frombuffer(r["losses"]).reshape(lshape)))

    written = spark.read.schema(_STATE).parquet(states_path)
    merged, parts = written.rdd.map(to_sums), len(written.inputFiles())  # one file a task
    while True:  # a constant fan-in: no task and not the driver sees more than FAN_IN states of a configuration
        parts = -(-parts // FAN_IN)
        merged = merged.partitionBy(max(parts, 1), lambda k: k).mapPartitionsWithIndex(_merged)
        if parts <= 1:
            break
    sums = dict(merged.values().collect())  # one row a configuration
    bc.unpersist()
    delete_path(spark, states_path)
    return sums


_ARROW = pa.schema([("kind", pa.string()), ("config", pa.int32()), ("epoch", pa.int32()), ("shard", pa.int32()),
                    ("rows", pa.int64()), ("step", pa.int64()), ("loss", pa.float64()), ("theta", pa.binary()),
                    ("m", pa.binary()), ("v", pa.binary()), ("hist", pa.binary()), ("losses", pa.binary()),
                    ("records_per_second", pa.float64())])


@contextmanager
def _arrow_bytes(spark: SparkSession, most: str):
    """Arrow batches of up to so many bytes for the jobs inside; then as it was."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def _again(first, rest: Iterator) -> Iterator:
    yield first
    yield from rest


def _merged(at: int, sums: Iterator[tuple[int, tuple[int, _Sums]]]) -> list[tuple[int, tuple[int, _Sums]]]:
    """Added up in the order of their shards, whichever arrives first: sums are the same in every run."""
    total: dict[int, _Sums] = {}
    for _, (config, x) in sorted(sums, key=lambda s: s[0]):
        total[config] = total[config].add(x) if config in total else x
    return [(at, x) for x in total.items()]


def summed_gradient(df: DataFrame, spec: NetSpec, theta: np.ndarray, features: str = "features") -> DataFrame:
    """(param, i, gradient): gradient of the loss summed over all rows, by the arithmetic of the training tasks.

    Each task adds up its batches and returns one row for each parameter;
    labels must be there in every row.
    """
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast((spec.to_json(), theta))
    width = spec.n_in

    def run(batches):
        sp, th = NetSpec.from_json(bc.value[0]), bc.value[1]
        total = np.zeros_like(th)
        for b in batches:
            if b.num_rows:
                X = arrow_matrix(b.column("__x"), width)
                Y = {h.task: b.column(h.label).to_numpy(zero_copy_only=False).astype(np.float64) for h in sp.heads}
                total += loss_and_grad(sp, th, X, Y)[1] * len(X)  # the loss is a mean over the batch
        names = [(n, i) for n, shape in sp.shapes() for i in range(int(np.prod(shape)))]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in names]), pa.array([i for _, i in names], pa.int32()),
                                          pa.array(total)], ["param", "i", "gradient"])

    narrow = df.select(F.col(features).cast("array<double>").alias("__x"),
                       *[F.col(h.label).cast("double").alias(h.label) for h in spec.heads])
    parts = narrow.mapInArrow(run, "param string, i int, gradient double")
    return parts.groupBy("param", "i").agg(F.sum("gradient").alias("gradient"))


def epoch_metrics(data: DataFrame, spec: NetSpec, theta: np.ndarray, splits: Sequence[str] = EVAL_SPLITS) -> list[dict]:
    """V3: metrics of fixed weights, by the evaluation-only job that follows the last epoch."""
    zero = np.zeros_like(theta)
    rows = _packed(data.where(F.col("split").isin(list(splits))), spec).withColumn("config", F.lit(0))
    log = scratch_path(data.sparkSession, "metrics-of")
    sums = _epoch_job(rows, {0: spec}, {0: _State(theta, zero, zero)}, log, 0, train=False, evaluate=splits)
    return _metrics_from(spec, sums[0].hist, sums[0].losses, splits) if sums else []


def fit(df: DataFrame | None, spec: NetSpec, **options) -> FitResult:
    """M3/M4/M5: train ``spec`` on rows with split = 'train'; evaluate train+valid every epoch (V3).

    Takes the options of ``fit_grid``, which trains it as a grid of one.
    """
    return fit_grid(df, [spec], **options)[0]


@dataclass
class _Run:
    """One configuration while it trains."""

    spec: NetSpec
    state: _State
    res: FitResult
    epoch: int = 0                          # the next one
    base: int = 0                           # number of the checkpoint's versions that were there before
    best: dict | None = None                # epoch, auc, version
    best_theta: np.ndarray | None = None
    active: bool = True


def fit_grid(df: DataFrame | None, specs: Sequence[NetSpec], features: str = "features", id_col: str = "record_id",
             split_col: str = "split", shards: int = SHARDS,
             standardize: bool = True, eval_splits: Sequence[str] = EVAL_SPLITS,
             on_epoch_end: Callable[[int, FitResult, list[dict]], None] | None = None,
             eval_method: str = "binned", prepared: DataFrame | None = None,
             checkpoint_path: str | None = None, resume: bool = False,
             patience: int | None = None) -> list[FitResult]:
    """M7: train every configuration of ``specs`` (one input width, any sizes and rates) on one sharded table.

    An epoch is one job for all configurations together, whose tasks are the
    (team, shard) pairs: configurations that take the same batches train in
    teams, as few as keep the cores busy, so that the rows are read and made
    ready once a team.  Results are those of training each alone.

    ``checkpoint_path``: model, Adam moments, step, epoch and metrics are saved
    there (S7; below ``config=<i>`` if there are several) after every epoch.
    With ``resume`` a run goes on from its last whole version, if there is one;
    ``epochs`` may have grown, all else must be as it was.

    ``patience`` (V3): a configuration stops once its mean validation AUC has
    not risen for so many epochs, and ends with the weights of its best epoch.
    The test split is never read for it.

    With the binned (reference) evaluation, epoch e's metrics are computed in
    epoch e+1's job -- training tasks score their rows with the incoming
    weights, which are exactly epoch e's model, and extra tasks score the
    validation rows -- and one evaluation-only job follows the last epoch.
    So each epoch is one pass and the train split is read once per epoch.
    The test split never reaches training or per-epoch evaluation.
    """
    unknown = set(eval_splits) - set(EVAL_SPLITS)
    if unknown:
        raise ValueError(f"per-epoch evaluation covers {EVAL_SPLITS} only, not {sorted(unknown)}")
    fused = eval_method == "binned"
    if patience is not None and not (fused and "valid" in eval_splits):
        raise ValueError("early stopping needs the binned evaluation of the validation split")
    if len({s.n_in for s in specs}) != 1 or len({tuple(h.label for h in s.heads) for s in specs}) != 1:
        raise ValueError("the configurations of a grid share input width and labels")
    data = prepared if prepared is not None else prepare(df, specs[0], features, id_col, split_col)
    spark = data.sparkSession
    train = data.where(F.col("split") == "train")
    log = f"{checkpoint_path}/log" if checkpoint_path else scratch_path(spark, "log")
    runs = [_begin(spark, i, spec, len(specs), shards, checkpoint_path, resume, log) for i, spec in enumerate(specs)]
    more = any(r.epoch < r.spec.epochs for r in runs)
    # a finished run is only evaluated again
    sharded = shard(train, shards, specs[0]) if more else _packed(train, specs[0])
    if standardize and any(r.spec.mean is None for r in runs):
        mean, scale = fit_standardizer(sharded, specs[0].n_in)
        for r in runs:
            if r.spec.mean is None:
                r.spec.mean, r.spec.scale = mean, scale
    valid = _packed(data.where(F.col("split") == "valid"), specs[0]) if fused and "valid" in eval_splits else None
    if valid is not None and more:
        valid = valid.checkpoint(eager=True)
    evald = data.where(F.col("split").isin(list(eval_splits)))

    def job(active: list[int], epoch: int, train: bool, evaluate: Sequence[str]) -> dict[int, _Sums]:
        teams = _teams([(i, runs[i]) for i in active], spark.sparkContext.defaultParallelism // shards)
        reads = [sharded if train or "train" in evaluate else None, valid if "valid" in evaluate else None]
        parts = [t.withColumn("config", F.lit(team[0])) for t in reads if t is not None for team in teams]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return _epoch_job(rows, {i: runs[i].spec for i in active}, {i: runs[i].state for i in active}, log, epoch,
                          train, evaluate, teams=teams)

    def record(r: _Run, epoch: int, rows_ev: list[dict], secs: float) -> None:
        for row in rows_ev:
            r.res.metrics.append(row | {"epoch": epoch, "seconds": secs})
        told = r.res.metrics[len(r.res.metrics) - len(rows_ev):]
        if on_epoch_end is not None:
            on_epoch_end(epoch, r.res, told)
        if patience is not None:
            _judge(r, epoch, told, patience)

    since = {i: time.time() for i in range(len(runs))}
    while True:
        epoch = min((r.epoch for r in runs if r.active and r.epoch < r.spec.epochs), default=None)
        if epoch is None:
            break
        now = [i for i, r in enumerate(runs) if r.active and r.epoch == epoch < r.spec.epochs]
        told = fused and epoch > 0 and bool(eval_splits)
        t0 = time.time()
        sums = job(now, epoch, True, eval_splits if told else ())
        for i in now:
            r, s = runs[i], sums.get(i)
            if told and s is not None:
                record(r, epoch - 1, _metrics_from(r.spec, s.hist, s.losses, eval_splits), t0 - since[i])
                since[i] = t0
                if not r.active:
                    continue
            if s is not None and s.rows:
                r.state = _State(s.theta / s.rows, s.m / s.rows, s.v / s.rows, r.state.t + s.steps)
            r.res.theta, r.epoch = r.state.theta, epoch + 1
            if not fused and eval_splits:
                pred = predict(evald, r.spec, r.state.theta, keep=["split", *[h.label for h in r.spec.heads]])
                record(r, epoch, [x.asDict() for x in evaluate(pred, r.spec, ["split"], method=eval_method).collect()],
                       time.time() - t0)
            _save(spark, r)
    left = [i for i, r in enumerate(runs) if r.active and r.spec.epochs > 0]
    if fused and eval_splits and left:
        sums = job(left, max(runs[i].spec.epochs for i in left), False, eval_splits)
        for i in left:
            r = runs[i]
            if (i in sums or r.state.t) and not any(m["epoch"] == r.epoch - 1 for m in r.res.metrics):
                found = _metrics_from(r.spec, sums[i].hist, sums[i].losses, eval_splits) if i in sums else []
                record(r, r.epoch - 1, found, time.time() - since[i])
    for r in runs:
        if r.best is not None:
            r.res.best_epoch, r.res.theta = r.best["epoch"], r.best_theta
    return [r.res for r in runs]


def _teams(runs: Sequence[tuple[int, _Run]], most: int) -> list[list[int]]:
    """Configurations that take the same batches by the same steps, in up to ``most`` teams of about the same work.

    The team with most work comes first, so that its tasks start first.
    """
    alike: dict[tuple, list[tuple[int, int]]] = {}
    for i, r in runs:
        key = (r.spec.batch, r.state.t, repr((r.spec.heads, r.spec.mean, r.spec.scale)))
        alike.setdefault(key, []).append((r.spec.n_params(), i))
    teams: list[list] = []
    for some in alike.values():
        own: list[list] = [[0, []] for _ in range(min(max(most, 1), len(some)))]
        for size, i in sorted(some, key=lambda x: (-x[0], x[1])):
            least = min(own, key=lambda t: t[0])
            least[0] += size
            least[1].append(i)
        teams += own
    return [sorted(team) for _, team in sorted(teams, key=lambda t: -t[0])]


def _begin(spark: SparkSession, i: int, spec: NetSpec, n: int, shards: int, checkpoint_path: str | None, resume: bool,
           log: str) -> _Run:
    """A configuration at its start, or as its last whole version left it."""
    path = checkpoint_path if checkpoint_path is None or n == 1 else f"{checkpoint_path}/config={i}"
    theta = init_params(spec)
    res = FitResult(spec=spec, theta=theta, shards=shards, checkpoint_path=path, log_path=log, config=i)
    r = _Run(spec, _State(theta, np.zeros_like(theta), np.zeros_like(theta)), res)
    saved = load_state(spark, path) if resume and path else None
    if saved is None:
        r.base = last_version(spark, path) if path else 0
        return r
    own = [asdict(s) | {"epochs": 0, "mean": None, "scale": None} for s in (spec, saved.spec)]
    if own[0] != own[1] or saved.progress["shards"] != shards:
        raise ValueError(f"the run under {path} was another one: it cannot be resumed with these parameters")
    spec.mean, spec.scale = saved.spec.mean, saved.spec.scale
    r.state = _State(saved.theta, saved.m, saved.v, saved.progress["step"])
    r.epoch, r.base, r.best = saved.progress["epoch"] + 1, saved.progress["base"], saved.progress["best"]
    res.theta, res.metrics = saved.theta, list(saved.progress["metrics"])
    if r.best is not None:
        r.best_theta = load_state(spark, path, r.best["version"]).theta
    return r


def _save(spark: SparkSession, r: _Run) -> None:
    if r.res.checkpoint_path:
        progress = {"epoch": r.epoch - 1, "step": r.state.t, "shards": r.res.shards, "metrics": r.res.metrics,
                    "best": r.best, "base": r.base}
        keep = [r.best["version"]] if r.best else []
        save_model(spark, r.spec, r.state.theta, r.res.checkpoint_path, r.state.m, r.state.v, progress, keep,
                   version=r.base + r.epoch)


def _judge(r: _Run, epoch: int, rows: list[dict], patience: int) -> None:
    """Early stopping by the mean validation AUC over tasks; ``r.state`` still holds the weights of ``epoch``."""
    aucs = [x["auc"] for x in rows if x["split"] == "valid" and x["auc"] is not None]
    auc = float(np.mean(aucs)) if aucs else None
    if auc is not None and (r.best is None or auc > r.best["auc"]):
        r.best, r.best_theta = {"epoch": epoch, "auc": auc, "version": r.base + epoch + 1}, r.state.theta
    elif epoch - (r.best["epoch"] if r.best else -1) >= patience:
        r.active, r.res.stopped_after = False, epoch


def final_report(data: DataFrame, res: FitResult, splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """V4: train and test AUC (exact and binned), loss and rows of a trained model."""
    spec = res.spec
    d = data.where(F.col("split").isin(list(splits)))
    pred = predict(d, spec, res.theta, keep=["split", *[h.label for h in spec.heads]])
    return report(pred, spec, ["split"])


#: Rows from which ``fit_builtin`` deals its rows anew for the perceptron, and bytes of features that one task then holds.
EVEN_ROWS, EVEN_BYTES = 100_000, 64 << 20


def _even(rows: DataFrame, width: int) -> DataFrame:
    """The rows in equal partitions, as many as a multiple of the cores, checkpointed; small inputs stay as they are.

    The partitions of a scan follow files: every pass over them waits for its
    largest task and its last wave.  An optimizer pays that in each pass.
    """
    n = rows.count()
    if n < EVEN_ROWS:
        return rows
    spark = rows.sparkSession
    checkpoint_root(spark)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores * math.ceil(n * width * 8 / EVEN_BYTES / cores)).checkpoint(eager=True)


def fit_builtin(data: DataFrame, label: str, n_classes: int, features: str = "features",
                hidden: int | None = None, max_iter: int = 20, seed: int = 1234,
                model_path: str | None = None):
    """M6: MLlib baseline -- LogisticRegression, or MultilayerPerceptronClassifier when ``hidden`` is set.

    A ``Pipeline`` of StandardScaler and the estimator, fitted on the train
    split.  The perceptron, whose passes take most of the time, is fitted and
    scored on equal partitions.  With ``model_path`` the fitted pipeline is saved
    (MLWriter, overwrite) and reloaded (MLReader) before scoring.  Returns the scored
    DataFrame (record_id, split, y, p) for the AUC operators: ``p`` is the
    positive-class probability for binary labels, the probability array otherwise.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    d = data.where(F.col(label).isNotNull()).select(
        "record_id", "split", array_to_vector(F.col(features)).alias("raw"),
        F.col(label).cast("double").alias("label"))
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    if hidden is None:
        est = LogisticRegression(maxIter=max_iter, family="binomial" if n_classes == 1 else "multinomial")
    else:
        width = len(data.select(features).first()[0])
        est = MultilayerPerceptronClassifier(layers=[width, hidden, max(2, n_classes)], maxIter=max_iter,
                                             seed=seed, blockSize=128)
        d = _even(d, width)
    model = Pipeline(stages=[scaler, est]).fit(d.where(F.col("split") == "train"))
    if model_path:
        model.write().overwrite().save(model_path)
        model = PipelineModel.load(model_path)
    out = model.transform(d).select(
        "record_id", "split", F.col("label").cast("int").alias("y"),
        vector_to_array("probability").alias("prob"))
    if n_classes == 1:
        return out.select("record_id", "split", "y", F.col("prob")[1].alias("p"))
    return out.select("record_id", "split", "y", F.col("prob").alias("p"))
