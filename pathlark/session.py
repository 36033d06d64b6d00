"""Session settings and the shared folder jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "pathlark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings the operators assume.

    Skewed join partitions are split even where that costs one more exchange; a shuffle
    partition aims at 128 MB and AQE merges what is smaller, so a generous partition count
    is safe on small data too.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        b = b.config(key, value)
    return b.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Settings a running session needs: all stamps are UTC, skewed joins are always split."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder is made up only where nothing is named and the master is local.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pathlark/{name}-{uuid.uuid4().hex}"


_WRITTEN: list[str] = []


def stored(rows: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Write to the shared folder and read back, in ``session`` if one is given.

    For a result that several later steps read: it is computed once, its lineage ends here, and a
    lost executor costs a re-read instead of a recomputation. ``clear_stored`` removes such tables.
    """
    path = fresh_path(rows.sparkSession, name)
    _WRITTEN.append(path)
    rows.write.parquet(path)
    return (session or rows.sparkSession).read.schema(rows.schema).parquet(path)


def stored_tables() -> int:
    """How many tables ``stored`` has written in this process and ``clear_stored`` has not removed."""
    return len(_WRITTEN)


def clear_stored(spark: SparkSession, first: int = 0, keep: int = 0) -> int:
    """Remove tables ``stored`` has written in this process, from number ``first`` on but for the last ``keep``;
    call it when their readers are done.

    Plans are lazy, so only the job knows when that is. Returns how many were removed.
    """
    n, end = 0, len(_WRITTEN) - keep
    old = _WRITTEN[first:end]
    del _WRITTEN[first:end]
    for path in old:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
    return n
