"""Session construction and shared-storage settings."""
from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every strata job relies on. None of them change query results;
# they keep plans adaptive and partition values as written.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # RAW partition values such as month=01 stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with strata's base settings.

    ``shuffle_partitions`` should follow the data: about one partition per
    128-256 MB of shuffled data on a cluster (AQE coalesces the rest), the
    number of cores for local tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    On a cluster it must be set: a folder of one machine is not seen by the
    others. Only a local session, whose tasks all run in this process, gets a
    private folder when it is unset; the context keeps it.
    """
    d, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        kept = context._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            return kept.get()
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        return context._jsc.sc().getCheckpointDir().get()
    context.setCheckpointDir(d)
    return d


@contextlib.contextmanager
def shared_copy(df: DataFrame, name: str, **options):
    """``df`` evaluated once and read back from shared storage; the copy is
    removed at the end of the ``with`` block. ``options`` are the writer's."""
    from .sinks import paths
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/strata-{name}-{uuid.uuid4().hex}"
    try:
        df.write.options(**options).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        paths.delete(spark, path)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session that holds within the ``with`` block only."""
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)
