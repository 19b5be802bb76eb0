"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    UTC keeps naive timestamps and session timestamps the same instant, and
    AQE is what splits skewed joins and coalesces small shuffles. Everything
    else (parallelism, memory, checkpoint folder) is left to the cluster.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, named in ``spark.checkpoint.dir``; every executor must see it."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    return folder


def ensure_local_shared_dir(spark: SparkSession) -> None:
    """Where no folder is set and driver and executors are one process, take a temporary one."""
    if spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir():
        return
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owner of the tables that ``cut_lineage`` writes inside: they are removed at the end.

    What the block returns must not depend on them; a result that does is
    written by ``cut_lineage(..., outlive=True)``, which hands it to the scope
    around this one. Without a scope a table stays until the folder is cleaned.
    """
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, outlive: bool = False) -> DataFrame:
    """The rows as a table in the shared folder.

    Later stages reread it after an executor loss, and unlike a checkpoint of
    rows it is columnar: a stage that needs two columns reads two.
    """
    path = scratch_path(df.sparkSession, "table")
    owners = _scopes[:-1] if outlive else _scopes
    if owners:
        owners[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
