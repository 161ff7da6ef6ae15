"""Spark session defaults for the library.

The settings below are the ones the operators rely on:

* AQE on, with partition coalescing and skew-join splitting, so shuffle sizes adapt at run time
  and a hot join key is split over several tasks.
* ``autoBroadcastJoinThreshold`` is the size check behind every dimension join that is not of a
  fixed, tiny size: Catalyst broadcasts a side only when its estimated size is under the threshold
  (and AQE again with the measured size), and falls back to a sort-merge join otherwise.
* UTC session time zone: dates and week boundaries do not move with the machine's zone.
* The Spark UI stays off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next operator (the daily group-by on user keys) relies on
    # the join's partitioning: the extra exchange it costs runs after partial aggregation, whereas
    # an unsplit hot user would put its whole share of the sessions into one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of a DataFrame are deleted once it is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "workpulse",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when None. ``shuffle_partitions`` should be sized so one
    shuffle partition is ~128-256 MB at the target scale; on a local machine use the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, from ``spark.checkpoint.dir``.

    It has to be configured: a folder of the local machine would not be seen by other executors.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """A folder for written tables that all executors share: that of the checkpoints, else the warehouse."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint in ``spark.checkpoint.dir``).

    For callers that feed one intermediate result to several branches of a plan. The files live on the
    shared checkpoint storage, so losing executors later does not recompute it. No registered query
    needs it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
