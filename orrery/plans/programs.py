"""The reference's end-to-end program, re-expressed as one Spark plan per stage.

Numbered-file folders (``features/`` plus one folder per label set) ->
alignment by record id -> fixed id-range splits -> distributed multi-task
training with per-epoch train/valid evaluation, metrics appended to Parquet
and the model checkpointed every epoch -> reload -> train and test report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.split import NB_TRAIN, NB_VALID, assign_split
from ..sources.models import load_model
from ..sources.numbered import read_dataset
from ..sources.store import write_metrics
from .net import EPOCHS, Head, NetSpec
from .train import SHARDS, FitResult, final_report, fit, prepare

# Fixed values of the reference programs: task folders and their class counts.
TASKS = {"mortality": 1, "los_bucket": 8, "survival_bucket": 5}
NB_INPUTS = 36 * 9 + 4 + 2 + 3


@dataclass
class ProgramResult:
    fit: FitResult
    report: DataFrame          # split, task, auc_exact, auc_binned, n_classes, loss, rows
    data: DataFrame


def load_tasks(spark: SparkSession, base_dir: str, tasks: Sequence[str], width: int = NB_INPUTS) -> DataFrame:
    """Features and every label folder in one scan, aligned by record id (labels squeezed to scalars)."""
    data = read_dataset(spark, f"{base_dir}/features", width, [f"{base_dir}/{t}" for t in tasks],
                        target_names=[f"y_{t}" for t in tasks])
    return data.select("record_id", "features", *[F.col(f"y_{t}").cast("int").alias(f"y_{t}") for t in tasks])


def run_program(spark: SparkSession, base_dir: str, out_dir: str, tasks: Sequence[str] = tuple(TASKS),
                hidden: int = 750, epochs: int = EPOCHS, width: int = NB_INPUTS,
                n_train: int | float = NB_TRAIN, n_valid: int | float = NB_VALID,
                shards: int = SHARDS, run_id: str = "run", resume: bool = False,
                patience: int | None = None) -> ProgramResult:
    """Train one shared-trunk network on ``tasks`` (1, 2 or all three) and report train and test AUC.

    With ``resume`` a program that was cut off goes on after its last whole epoch; the metrics of an epoch that is
    evaluated again replace those that are there.  ``patience`` stops by validation AUC.
    """
    data = assign_split(load_tasks(spark, base_dir, tasks, width), "record_id", n_train, n_valid)
    spec = NetSpec(n_in=width, hidden=hidden, epochs=epochs,
                   heads=[Head(t, TASKS[t], f"y_{t}") for t in tasks])
    prepared = prepare(data, spec)

    def log_epoch(epoch: int, res: FitResult, rows: list[dict]) -> None:
        if rows:
            df = spark.createDataFrame([(run_id, r["epoch"], r["split"], r["task"], r["auc"], r["loss"], r["rows"],
                                         r["seconds"]) for r in rows],
                                       "run_id string, epoch int, split string, task string, auc double, "
                                       "loss double, rows long, seconds double")
            write_metrics(df, f"{out_dir}/metrics")

    res = fit(None, spec, prepared=prepared, shards=shards, on_epoch_end=log_epoch,
              checkpoint_path=f"{out_dir}/model", resume=resume, patience=patience)
    spec2, theta = load_model(spark, f"{out_dir}/model")
    if res.best_epoch is not None:
        theta = res.theta  # the newest version is that of the last epoch, not of the best
    report = final_report(prepared, FitResult(spec=spec2, theta=theta))
    return ProgramResult(fit=res, report=report, data=prepared)
