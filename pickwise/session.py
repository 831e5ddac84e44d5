"""Session helpers: sensible defaults and a cluster-safe checkpoint directory."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pickwise", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. Library code never sets a master itself;
    only tests and the bench pass one."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there (an error otherwise); only a
    local master with the setting unset (tests) falls back to a fresh
    scratch directory."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(checkpoints and stream state must survive an executor loss)")
        root = tempfile.mkdtemp(prefix="pickwise-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


ensure_checkpoint_dir = checkpoint_root


def stream_checkpoint_path(spark: SparkSession, name: str) -> str:
    """The same path at every start: ``name`` under the folder that ``spark.checkpoint.dir``
    names (``checkpoint_root`` has a new sub-folder in each application, in which a
    restarted stream would not find its state)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir, or pass the stream's checkpoint folder: its state must be found again")
    return f"{root.rstrip('/')}/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediates."""
    import uuid
    return f"{checkpoint_root(spark).rstrip('/')}/pickwise-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a reused, costly intermediate: write it to the shared
    checkpoint folder (``Dataset.checkpoint``), so a lost executor costs a
    re-read, not a recomputation of the whole plan."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
