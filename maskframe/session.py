"""Session construction and lineage cuts.

``get_session`` is for tests, benchmarks and local runs; on a cluster the caller passes its own session and
nothing here overrides cluster settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "maskframe") -> SparkSession:
    master = master or os.environ.get("MASKFRAME_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MASKFRAME_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A local folder is created only when the session runs in local mode and nothing is configured (tests); on a
    cluster an unset value is an error, because a machine-local folder does not survive executor loss.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="maskframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint); ``eager=False`` leaves it to the first job
    that reads the rows, so that building a query runs none."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table under the shared checkpoint folder: computed once, read with pruned columns by
    every branch that follows, whatever executors are lost. The folder belongs to the application and may go with it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/maskframe-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``maskframe`` importable in Python workers (``mapInPandas`` / ``applyInPandas`` bodies refer to its
    functions): zip the package once per SparkContext and distribute it with ``addPyFile`` (the ``--py-files``
    mechanism; Spark serves the file to every executor). A no-op when already done for this context."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="maskframe-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "maskframe"), "zip", root_dir=os.path.dirname(pkg), base_dir="maskframe")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
