"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabwright")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # one partition per core already; coalescing would leave stored tables with one file
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh path under the folder the cluster shares for checkpoints.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a session on
    one machine gets a temporary folder; on a cluster that is an error, as executors would
    not see each other's files. The path is removed when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tabwright-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there,
    and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*stored: DataFrame) -> None:
    """Remove tables made by :func:`settle` that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def laid_out(df: DataFrame, *key: str, rows_per_part: int = 500_000, least: int = 8) -> DataFrame:
    """Rows dealt by a hash of the key into sorted partitions, whose number follows from the number
    of rows alone. Fits that draw samples per partition then do not depend on the files or the
    cores. The rows are counted first, so give a stored table. The result is a checkpoint: later passes read it, in the
    same partitions, and neither shuffle nor sort again."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    parts = max(least, -(-df.count() // rows_per_part))
    return df.repartition(parts, *key).sortWithinPartitions(*key).checkpoint()
