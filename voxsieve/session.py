"""Session helpers: a local test session and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "voxsieve") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The URI of the folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master, and where the setting is absent (tests, a laptop), a temporary folder is made and set as the checkpoint folder; a cluster's
    executors would each write to their own disks there, so without the setting an error is raised.
    """
    known = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='voxsieve-')}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; :func:`discard_scratch` removes what was written there."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


_scratch: list[str] = []


def discard_scratch(spark: SparkSession) -> int:
    """Delete all intermediate tables of this process; results that were not written yet can't be read any more. Returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    n = len(_scratch)
    _scratch.clear()
    return n


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: its lineage is cut, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
