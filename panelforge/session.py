"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
is for tests and the bench only.  ``shared_dir`` resolves the cluster's shared
folder from ``spark.checkpoint.dir`` (read from the session; a private default
is set only when the session has none, as in tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  Unset, a private one is made
    where driver and executors are one process; a cluster has to name its own."""
    sc = spark.sparkContext
    cp = sc.getCheckpointDir()
    if not cp:
        cp = spark.conf.get("spark.checkpoint.dir", None)
        if not cp:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            cp = tempfile.mkdtemp(prefix="run-")
        sc.setCheckpointDir(cp)
        cp = sc.getCheckpointDir() or cp
    return cp


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/panelforge/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def reliable_checkpoint(df):
    """Cut the lineage at a stage boundary: write ``df`` as a parquet table in
    a fresh folder under the session's shared checkpoint folder and read it
    back.  The plan runs once under adaptive execution, the table survives
    executor loss, and the read-back partitions follow the file sizes
    whatever the session's shuffle-partition setting."""
    spark = df.sparkSession
    path = shared_dir(spark, "stage") + "/data"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
