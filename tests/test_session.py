"""Scratch locations come from the session's shared checkpoint folder."""

import subprocess
import sys

from stratum.session import checkpoint_root, clear_scratch, scratch_dir
from stratum.sources.tables import Layout, path_exists


def test_scratch_under_session_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root.rstrip("/") + "/stratum/x-") and a != b


def test_layout_paths():
    lay = Layout("s3://lake/base/")
    assert lay.silver("mfg_order") == "s3://lake/base/silver/mfg_order"
    assert lay.gold("gold_capa") == "s3://lake/base/gold/gold_capa"
    assert lay.checkpoint("bronze_x") == "s3://lake/base/_checkpoints/bronze_x"


def test_jobs_cli_help():
    out = subprocess.run([sys.executable, "-m", "stratum.plans.jobs", "--help"], capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0 and "--stage" in out.stdout


def test_scratch_can_be_cleared(spark):
    path = scratch_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    other = scratch_dir(spark, "x").rsplit("/stratum/", 1)[0] + "/kept"
    spark.range(2).write.mode("overwrite").parquet(other)
    clear_scratch(spark)
    assert not path_exists(spark, path) and spark.read.parquet(other).count() == 2
