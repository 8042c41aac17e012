"""Session settings the library relies on."""

import tempfile

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, turns a shuffle join into a broadcast join once the real size
# of a side is known, and splits the partition of a hot join key over many tasks.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(app="forecourt", master="local[*]", shuffle_partitions=8, **conf):
    """A session for tests and benchmarks; on a cluster the submitted settings are used instead."""
    builder = SparkSession.builder.appName(app).master(master)
    settings = {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark):
    """The shared folder named by ``spark.checkpoint.dir``; a private folder where none is set and the master is local.

    On a cluster a folder of the driver's own disk would be seen by no executor, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="forecourt-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
