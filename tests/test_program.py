"""The reference-shaped program end to end on numbered files exported from the derived cohort."""

import os

from pyspark.sql import functions as F

from orrery.plans.cohort import WIDTH
from orrery.plans.programs import run_program
from orrery.sources.numbered import write_numbered_csv


def test_program_on_numbered_files(spark, tmp_dir):
    from orrery.plans.catalog import cohort_dataset
    sf = "/root/testdata/sf0.001"
    d = cohort_dataset(spark, sf).where(F.col("record_id") < 400)      # small fixture: 400 records
    base = os.path.join(tmp_dir, "data")
    write_numbered_csv(d, f"{base}/features", "record_id", "features")
    for t, col in [("mortality", "y_mortality"), ("los_bucket", "y_los"), ("survival_bucket", "y_survival")]:
        write_numbered_csv(d.select("record_id", F.array(F.col(col).cast("double")).alias("y")),
                           f"{base}/{t}", "record_id", "y")
    out = run_program(spark, base, os.path.join(tmp_dir, "out"), hidden=16, epochs=2, width=WIDTH,
                      n_train=0.8, n_valid=0.1)
    rep = {(r["split"], r["task"]): r for r in out.report.collect()}
    assert {s for s, _ in rep} == {"train", "test"}
    assert {t for _, t in rep} == {"mortality", "los_bucket", "survival_bucket"}
    m = spark.read.parquet(os.path.join(tmp_dir, "out", "metrics"))
    assert m.count() == 2 * 2 * 3                                      # epochs x (train, valid) x tasks
    assert m.where("split = 'test'").count() == 0
