"""Session helpers: table access and scratch tables in the cluster's shared folder.

Nothing here writes to a machine-local folder while the session names a shared
one in ``spark.checkpoint.dir``; only when that setting is absent (tests, a
laptop) a temporary folder is created and used.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: list[Scratch] = []


def local_session(cpus: str | int = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tested under."""
    base = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("assaymill")
    for key, value in base.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` below ``folder``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); in local sessions a temporary one where it is unset, elsewhere that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="assaymill-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
        spark.sparkContext.setCheckpointDir(_LOCAL[app])
    return f"file://{_LOCAL[app]}"


class Scratch:
    """Written tables that cut lineage and outlive any executor.

    ``put`` writes a DataFrame as Parquet into the shared folder and reads it
    back; ``drop`` removes a table that no later step needs, so that the disk in
    use stays at a few generations of an iterative algorithm.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/assaymill-{name}-{uuid.uuid4().hex[:12]}"
        _WRITTEN.append(self)
        atexit.register(self._remove, self.root)

    def path(self, tag: str) -> str:
        return f"{self.root}/{tag}"

    def put(self, df: DataFrame, tag: str) -> DataFrame:
        path = self.path(tag)
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, tag: str) -> None:
        self._remove(self.path(tag))

    def _remove(self, path: str) -> None:
        try:
            if path.startswith("file:") or path.startswith("/"):
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
                return
            if self.spark.sparkContext._jsc is None:
                return
            jvm = self.spark._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # a folder left behind must never fail a result
            pass


def release_scratch() -> int:
    """Remove the scratch tables of all results so far, which must not be read again; returns how many folders went.

    Results read their last tables when an action runs, so these stay until the session ends or this is called: a session that runs many queries
    calls it between them.
    """
    count = len(_WRITTEN)
    while _WRITTEN:
        scratch = _WRITTEN.pop()
        scratch._remove(scratch.root)
    return count
