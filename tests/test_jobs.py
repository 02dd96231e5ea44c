"""The three jobs one after the other, from raw lines to scored customers."""

import os
import subprocess
import sys

import pytest

from basketry import jobs
from basketry.sources.retail import retail_lines

FOLDER = "/root/testdata/sf0.001"
GRIDS = {
    "gbt": [{"learning_rate": 0.1, "n_estimators": 2, "max_depth": 2}],
    "lr": [{"C": 1.0, "penalty": "l2"}],
    "svm": [{"C": 1.0, "penalty": "l1"}],
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_segment_train_score(spark, tmp_path):
    retail_lines(spark, FOLDER).write.parquet(f"{tmp_path}/raw")
    call = lambda *a: jobs.run(spark, jobs.arguments(list(a)), GRIDS)
    call("segment", "--lines", f"{tmp_path}/raw", "--out", f"{tmp_path}/out", "--home", "NATION_7", "--k", "3", "--restarts", "2")
    shared = ["--lines", f"{tmp_path}/out/lines", "--customers", f"{tmp_path}/out/customers",
              "--ref", "2001-08-01", "--models", f"{tmp_path}/models"]
    call("profile", *shared[2:4], "--out", f"{tmp_path}/profile")
    sizes = {r["Label"]: r["customers"] for r in spark.read.parquet(f"{tmp_path}/profile/population").collect()}
    means, sums = [{r["Label"]: r["Amount"] for r in spark.read.parquet(f"{tmp_path}/profile/{n}").collect()} for n in ("means", "sums")]
    assert sizes.keys() == means.keys() and all(sums[k] == pytest.approx(means[k] * n) for k, n in sizes.items())
    call("prepare", *shared[:4], "--out", f"{tmp_path}/prepared")
    prepared = spark.read.parquet(f"{tmp_path}/prepared")
    assert prepared.where("Occurence >= 1 AND Label IS NOT NULL").count() == prepared.count() > 0
    call("train", *shared)
    call("score", *shared, "--out", f"{tmp_path}/scored", "--classes", "3", "--sample", "50")
    predictions = spark.read.parquet(f"{tmp_path}/scored/predictions")
    assert predictions.count() == 50
    assert spark.read.parquet(f"{tmp_path}/scored/confusion").count() == 9


def test_jobs_start_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-m", "basketry.jobs", "--help"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True
    )
    assert done.returncode == 0 and "horizons" in done.stdout
