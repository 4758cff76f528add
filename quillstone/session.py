"""Session settings and the lineage-cutting helpers that every iterative operator shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quillstone", cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster the deployment gives its own session."""
    cores = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUILLSTONE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names in spark.checkpoint.dir.

    Only where neither the setting nor the context has a folder is a temporary one made, and only on a local master: a
    cluster's executors do not share a machine's folder, so there it is an error.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quillstone-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Writes df to the shared checkpoint folder and continues from there (survives the loss of executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
