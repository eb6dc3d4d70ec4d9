"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths that enclosing `scratch` blocks remove, innermost last.
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A local one is made only where the session names none and all runs in one process."""
    held = spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        held = at.get() if at.isDefined() else None
    if not held:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        held = tempfile.mkdtemp(prefix="paceline-")
        spark.sparkContext.setCheckpointDir(held)
    return held


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table in the shared folder, so that a lost executor only costs a read.

    The table stays until the `scratch` block that it was written in ends; without one, whoever runs the session
    clears the folder.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what `written` left inside, so results have to be taken before the block ends."""
    _open.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _open.pop():
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
