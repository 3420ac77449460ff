"""Tables written between two passes over the same rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_own_folder: dict[str, str] = {}
_tables: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a
    cluster, a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="rollcall-")
    return _own_folder[app]


def remember(spark: SparkSession, path: str) -> None:
    """Let ``release`` delete ``path`` too."""
    _tables.setdefault(spark.sparkContext.applicationId, []).append(path)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a parquet table in the scratch folder.

    Later passes see the very same rows, also after the loss of an executor,
    and the plan behind them is not run again.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/rollcall/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    remember(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Delete one table that ``written`` has returned; nothing may read it any more."""
    spark, path = table.sparkSession, table._scratch_path
    _tables[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Delete the tables this session has written; results read from them end with them."""
    paths = _tables.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        _delete(spark, name)
    return len(paths)
