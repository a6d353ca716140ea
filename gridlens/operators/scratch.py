"""Tables in the shared checkpoint folder, to cut the lineage of loops."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where it is unset: a folder in the warehouse, which all
    machines see; a temporary one only if this process is the only machine."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if told:
        return told.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_gridlens"
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="gridlens-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def settled(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """``df`` written and read again; its path is added to ``paths``."""
    path = f"{folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes settled tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
