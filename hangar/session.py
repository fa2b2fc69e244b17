"""Session construction and shared-folder resolution.

Library code never creates a session: every function takes the caller's
``SparkSession`` (or DataFrames).  ``local_session`` is for tests, the bench
and the command line only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "hangar",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session tuned for small-scale runs (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce small shuffles to the advisory size, not to the core count;
        # a small advisory size keeps CPU-heavy sorts/windows spread over the
        # cores at test scale (clusters use 128-256 MB, see README)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a folder every executor can reach;
    we only read it, and a missing setting is an error (a machine-local
    folder would not survive the loss of an executor).  In local mode
    (tests) a fresh folder is made under the system temp dir and registered
    as the context's checkpoint folder (``spark.checkpoint.dir`` itself
    cannot be changed at run time).
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        path = _LOCAL_DIRS.get(sc.applicationId)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        path = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="hangar-ckpt-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():  # type: ignore[union-attr]
        sc.setCheckpointDir(path)
    return path


def staging_path(spark: SparkSession, name: str, run_id: str | None = None) -> str:
    """A per-run folder under the shared checkpoint dir for staged tables."""
    root = ensure_checkpoint_dir(spark)
    run = run_id or uuid.uuid4().hex[:12]
    return os.path.join(root.rstrip("/"), "hangar-staging", run, name)
