"""Local sessions without ``spark.checkpoint.dir`` still checkpoint."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from hangar.session import ensure_checkpoint_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
first, second = ensure_checkpoint_dir(spark), ensure_checkpoint_dir(spark)
assert first == second
print("rows", spark.range(3).checkpoint(eager=True).count())
spark.stop()
""" % ROOT


def test_checkpoint_folder_is_made_when_unset():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="hangar-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows 3" in out.stdout
