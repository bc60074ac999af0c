"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "seedmill", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM
        conf["spark.driver.memory"] = os.environ.get("SEEDMILL_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where the cluster named none.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only a local session without that setting (tests, local bench) gets a fresh
    folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="seedmill-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or os.path.abspath(path)


def written(df, tag: str):
    """Write df as Parquet under the shared checkpoint folder and read it back: lineage is cut, later reads prune columns."""
    import uuid
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/seedmill-{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
