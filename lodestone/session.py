"""SparkSession factory used by tests, bench and scripts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "lodestone", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Return a session with UTC time, AQE on and Arrow transfer enabled."""
    os.environ.setdefault("TZ", "UTC")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODESTONE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a local session gets a folder of its own; on a cluster executors
    would each write to their own disk, so that is an error.
    """
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lodestone-checkpoints-")
    spark.sparkContext.setCheckpointDir(path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, with no lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
