"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter at scale: AQE re-plans joins (size-checked broadcast, skew split,
# partition coalescing) from runtime statistics; the UI stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "sparkplate",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local session (tests, a first try) keeps it in
    its warehouse; a cluster session must name a folder that all its machines share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, *by: str) -> DataFrame:
    """Write a frame to the shared folder, in folders by the columns ``by``, and read it back.

    Like a reliable checkpoint (a lost executor re-reads the files), but computed once and
    stored as compressed columns, so later steps read only what they need.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_tasks(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Actions inside deal their joins and groups to ``tasks`` tasks, if the session's are fewer.

    AQE may still split a hot key, which it leaves alone after a ``repartition`` by a number; it
    does not merge tasks here, as it would by compressed bytes, of which rows may have few.
    """
    number, merge = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (number, merge)}
    if tasks >= max(int(before[number]), spark.sparkContext.defaultParallelism):
        spark.conf.set(number, str(tasks))
        spark.conf.set(merge, "false")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
