"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, tempfile.TemporaryDirectory] = {}


def get_session(master: str = "local[*]", shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter's own settings apply."""
    builder = (
        SparkSession.builder.master(master)
        .appName("pricecast")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Keep generated methods below the size the JVM still compiles.

    A stage fused into one larger method runs interpreted, several times slower than unfused operators; wide
    text parsing behind a filter gets there.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is unset, a local session gets a folder of its own that goes when Python ends; on a cluster
    that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.TemporaryDirectory(prefix="pricecast-", ignore_cleanup_errors=True)
        spark.sparkContext.setCheckpointDir(_own[app].name)
    return _own[app].name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where an iterative learner or several passes read the same frame: a lost executor then costs a
    re-read of files, not a replay of the windows that built them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pricecast/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
