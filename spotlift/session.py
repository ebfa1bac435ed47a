"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on. Sizes that depend on the cluster stay with the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "spotlift", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; where none is set, one beside the warehouse, which is shared as well."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_spotlift_checkpoints")


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    Unlike a cache the result outlives the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
