"""Session helpers: the engine's Spark configuration and its shared scratch area.

Everything the engine writes (text round trips, streaming output, lineage cuts) goes
under the cluster's checkpoint directory, which must be a shared filesystem on a real
cluster. The directory is read from the session (``spark.checkpoint.dir`` or an
already set SparkContext checkpoint dir). Where neither is set, a local session gets a
temporary folder, which is deleted at exit; on a cluster that is an error, as executors
don't share local folders. Tables that an operator stores on the way stay there until the
``ScratchScope`` that they were written in is released.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Timestamps are turned into calendar years in UTC
# (see functions.time), so the session zone is pinned only for display consistency.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rateflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting it on the context if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="rateflow-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


class ScratchScope:
    """Owns the scratch paths that are handed out while it is entered.

        with ScratchScope(spark) as scope:
            result = query(spark, ...)
            result.write.parquet(out)
        scope.release()

    Leaving the block removes nothing, as a result may still be lazy and read its tables; the
    owner calls ``release`` when everything made from them is stored or no longer needed. Scopes
    nest: a path belongs to the innermost one."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> ScratchScope:
        _SCOPES.append(self)
        return self

    def __exit__(self, *exc) -> None:
        _SCOPES.remove(self)

    def release(self) -> None:
        while self.paths:
            remove_path(self._spark, self.paths.pop())


_SCOPES: list[ScratchScope] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/rateflow-{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back. The result has no layout of
    its own, so a later join shuffles both sides and AQE can split a hot key."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if it doesn't exist."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see whole or not at all: it is written beside and then renamed."""
    fs, p = _file_system(spark, path)
    _, beside = _file_system(spark, f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
