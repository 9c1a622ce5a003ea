"""Session helpers: a tuned local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cleanlane") -> SparkSession:
    """Local session with AQE on and UTC time, for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folder for intermediate tables of local sessions (driver and executors are one process) that set none.
LOCAL_FOLDER = "/tmp/checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; the setting is only read.

    A local session (master ``local`` or ``local[n]``) without the setting uses
    ``LOCAL_FOLDER``; any other one must have it.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = LOCAL_FOLDER
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one).

    Used before operators that run several jobs over the same input, so a lost
    executor recomputes from the checkpoint, not from the raw scan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
