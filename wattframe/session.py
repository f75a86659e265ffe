"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "wattframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings this library relies on.

    The master is only set when no session is active and one is given
    explicitly, so a cluster submit keeps its own master.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in RUNTIME_CONF.items():
            active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as configured by the cluster. Only when it
    is unset and the master is local (tests) a fresh local folder is created
    and registered; on a cluster an unset setting is an error, since a
    machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not configured:
            if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
            spark.conf.set("spark.checkpoint.dir", configured)
        sc.setCheckpointDir(configured)
    return (configured or sc.getCheckpointDir()).rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/wattframe-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def changed_settings(spark: SparkSession, settings: dict[str, str]):
    """Other settings for a while; those that were unset are unset again."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Shuffle files go when their query has ended, not when the driver collects its garbage.
RELEASE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shuffles_released(spark: SparkSession):
    """What is run meanwhile, and streams started meanwhile, leave no shuffle files behind."""
    return changed_settings(spark, RELEASE_SHUFFLES)
