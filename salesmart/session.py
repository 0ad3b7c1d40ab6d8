"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Conservative defaults; on a cluster the submitter's settings win because
# ``getOrCreate`` returns the existing session untouched.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "salesmart",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SALESMART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset (local tests) a scratch folder is created here.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="salesmart-ckpt-")     # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: application id plus the session object."""
    return (spark.sparkContext.applicationId, id(spark))


_SCOPED: dict = {}
_SCOPED_LOCK = threading.Lock()


@contextmanager
def scoped_conf(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold inside the block; blocks may nest and overlap in threads, the last to end restores."""
    keys = [(*session_key(spark), k) for k in conf]
    with _SCOPED_LOCK:
        for key, (k, v) in zip(keys, conf.items()):
            depth, before = _SCOPED.get(key, (0, None))
            if not depth:
                before = spark.conf.get(k, None)
                spark.conf.set(k, v)
            _SCOPED[key] = (depth + 1, before)
    try:
        yield
    finally:
        with _SCOPED_LOCK:
            for key, k in zip(keys, conf):
                depth, before = _SCOPED.pop(key)
                if depth > 1:
                    _SCOPED[key] = (depth - 1, before)
                else:
                    spark.conf.unset(k) if before is None else spark.conf.set(k, before)


def transient_shuffles(spark: SparkSession):
    """Shuffle files of the jobs begun inside go as each job ends.

    Otherwise they stay until the driver happens to collect its garbage, and a
    build or stream of many jobs holds the files of all of them at once.  For
    frames that are run once (written, counted): a frame run again inside
    would make its shuffle files anew."""
    return scoped_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def work_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
