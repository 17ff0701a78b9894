"""orrery: supervised multi-task prediction on record-level data, on Spark.

Common entry points are re-exported here; see the subpackages for the rest.
"""

from .functions.nn import bce, cce, dense_forward, relu, sigmoid, softmax
from .operators.align import align, align_landed, align_many, alignment_audit, attach_predictions
from .operators.auc import (auc, auc_binned, auc_exact, auc_macro, auc_per_class, auc_task_mean,
                            expand_classes, merge_histograms, negatives_below, roc_curve, roc_histogram)
from .operators.encode import los_bucket, one_hot, one_hot_nullable, survival_bucket
from .operators.features import (assemble_features, events_wide, exact_median, grouped_stats, select_group, squeeze_label,
                                 stats_array, stats_wide, variable_stats)
from .operators.scan import prefix_sums, row_number_within
from .operators.split import assign_split, batch_number, slice_records
from .operators.summary import best_epoch, dataset_summary, first_records, stack_rows
from .plans.net import Head, NetSpec
from .plans.programs import run_program
from .plans.score import evaluate, predict, report
from .plans.train import final_report, fit, fit_builtin, fit_grid, prepare, read_history
from .session import checkpoint_root, get_spark
from .sources.models import load_model, save_model
from .sources.numbered import (read_csv_dir, read_dataset, read_numbered_csv, read_sequences, validate_numeric,
                               write_numbered_csv)
from .sources.store import compact, land, open_landed, read_metrics, write_metrics

__all__ = [n for n in dir() if not n.startswith("_")]
