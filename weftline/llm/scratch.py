"""Tables written to the folder that the driver and all executors share.

A written table cuts lineage and survives lost executors. The folder is
``spark.checkpoint.dir``; only a session without one, on a single machine,
gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="weftline-")
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet into the shared folder and read them back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove one table."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def purge(spark: SparkSession) -> None:
    """Remove all tables written so far by this application; results read from them are gone."""
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


#: Ids up to which a filter by ids is broadcast: 16 bytes each in memory.
BROADCAST_IDS = 2_000_000


def fresh(name: str, *taken: str) -> str:
    """``name``, or the first of name_1, name_2, ... that is no column of the tables."""
    used = {t.lower() for t in taken}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(used) + 2))) if n.lower() not in used)


def by_ids(rows: DataFrame, ids: DataFrame, column: str, how: str) -> DataFrame:
    """Semi or anti join of rows on a table of distinct ids in one column.

    Counted first: few ids are broadcast, so that wide rows needn't be shuffled.
    """
    key = fresh("__id", *rows.columns)
    wanted = ids.toDF(key)
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, F.col(column) == F.col(key), how)
