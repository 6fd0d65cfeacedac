"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # feed pages are small files; a task takes as many as their bytes allow
    "spark.sql.files.openCostInBytes": "262144",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "feedlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Feed timestamps are absolute instants; all wall-clock rendering is UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _local_folder(master: str) -> str:
    """A fresh folder for local runs; executors on other machines could not see it."""
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("spark.checkpoint.dir is unset; on a cluster it must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="feedlens-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests) a fresh folder is created."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Connect session: the server owns the checkpoint folder
        sc = None
    if sc is None:
        if not conf_dir:
            conf_dir = _local_folder(spark.conf.get("spark.master", ""))
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = _local_folder(sc.master)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
