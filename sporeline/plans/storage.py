"""Cutting lineage through shared storage.

Iterative operators write each round as a table into the folder named by
``spark.checkpoint.dir`` so that a lost executor costs a re-read, never a rerun
of all earlier rounds. Only when the setting is absent (local tests) a temporary
folder of this machine is used.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="sporeline-")
        atexit.register(_remove_local, _OWN[app])
    return _OWN[app]


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def materialize(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` to shared storage and read it back: ``(table, path)``."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`materialize`."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
