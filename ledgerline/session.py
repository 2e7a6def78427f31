"""SparkSession helpers.

Library code never creates a session; these helpers are for tests, the bench and
command-line use. Only ``local_session`` picks a checkpoint folder, and only when the
session names none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "ledgerline") -> SparkSession:
    """A local-mode session with the settings the tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "12g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerline-ckpt-"))  # one machine only
    checkpoint_dir(spark)
    return spark


class NoCheckpointDir(RuntimeError):
    pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; the library never picks one itself.

    A folder set with ``SparkContext.setCheckpointDir`` wins and is left alone; else
    ``spark.checkpoint.dir`` is used. Raises ``NoCheckpointDir`` if neither is set.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        raise NoCheckpointDir("no checkpoint folder: set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir
