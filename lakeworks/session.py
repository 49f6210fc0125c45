"""Spark session and lineage helpers.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``; we
read it from the session and only fall back to a scratch folder when running
in local mode (tests, bench) where nothing set it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "lakeworks", extra: dict | None = None) -> SparkSession:
    """A session with this library's defaults. Master, memory and shuffle
    partitions stay as submitted unless they are given (tests and bench do)."""
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, configuring the SparkContext to use it.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage. Only a
    local-mode session with nothing configured gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lakeworks-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes made meanwhile delete their shuffle files as they end. Spark keeps them until
    the driver's garbage collector finds the frame gone, for whole reports as a rule; what was
    written is read from its files, so nothing goes back to them (if it did, they'd be made again)."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


@contextmanager
def passing_cuts(spark: SparkSession):
    """Files of the cuts made meanwhile are deleted at the end: for work whose frames nobody
    keeps, as what it leads to has been written."""
    made: list[str] = []
    before = _PASSING.set(made)
    try:
        yield
    finally:
        _PASSING.reset(before)
        jvm = spark.sparkContext._jvm
        for path in made:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder (never local) and go on from
    the files. They are columns, compressed: a fraction of a checkpoint's bytes, and
    each reader opens only the columns that it uses."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])      # names that any file takes
    with shuffles_freed(spark):
        plain.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)
