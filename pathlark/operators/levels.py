"""A change log that stays cheap to read: levels of merged snapshots, in folders by bucket of the key.

Each batch writes its changes. Every ``every`` batches the last ones are merged into a run, and every
``every`` runs all that is there into a snapshot. A read takes the newest snapshot, the runs since, and the
changes since the last run: fewer than ``2 * every + 1`` folders, however many batches there were, and with a
bucket only that bucket's files of them. What is merged when follows from the batch number alone, so a batch
that runs again does the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHANGES, RUN, SNAPSHOT = range(3)


@dataclass(frozen=True)
class Levels:
    """``merge`` folds rows with ``batch_id`` to one row for each key, in any grouping with the same result; it
    keeps the columns, ``batch_id`` among them. ``bucket`` is a function of the key, from 0 to any number."""

    path: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]
    bucket: Column
    every: int = 20

    def _folder(self, level: int, last: int) -> str:
        return f"{self.path.rstrip('/')}/level={level}/last={last:012d}"

    def _finished(self, spark: SparkSession, level: int) -> list[int]:
        """Numbers of the last batches of a level's finished folders, in order."""
        found = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/level={level}/last=*/_SUCCESS")
        matches = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
        return sorted(int(m.getPath().getParent().getName().removeprefix("last=")) for m in matches or [])

    def folders(self, spark: SparkSession, upto: int | None = None, but: int | None = None) -> list[str]:
        """What a read of the state after batch ``upto`` takes (none: after the newest one), without snapshot ``but``."""
        def ends(level: int, after: int) -> list[int]:
            return [n for n in self._finished(spark, level) if n > after and (upto is None or n <= upto)]

        snapshots = [n for n in ends(SNAPSHOT, -1) if n != but]
        full = snapshots[-1] if snapshots else -1
        runs = ends(RUN, full)
        rest = ends(CHANGES, runs[-1] if runs else full)
        return ([self._folder(SNAPSHOT, full)] if snapshots else []) + [self._folder(RUN, n) for n in runs] + [self._folder(CHANGES, n) for n in rest]

    def _rows(self, spark: SparkSession, folders: list[str], bucket: int | None = None) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        kind = StructType([*self.schema.fields]).add("bucket", "integer")
        rows = spark.read.schema(kind).option("basePath", f"{self.path.rstrip('/')}").parquet(*folders)
        return (rows if bucket is None else rows.filter(F.col("bucket") == bucket)).select(*self.schema.fieldNames())

    def read(self, spark: SparkSession, bucket: int | None = None) -> DataFrame:
        """Current rows, of one bucket if it is named."""
        return self.merge(self._rows(spark, self.folders(spark), bucket))

    def _put(self, rows: DataFrame, level: int, last: int) -> None:
        rows.withColumn("bucket", self.bucket.cast("int")).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(level, last))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch of changes, and merge if it is its turn. Runs again, it replaces what it wrote."""
        spark = rows.sparkSession
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*self.schema.fieldNames())
        self._put(rows, CHANGES, batch_id)
        count = batch_id + 1
        if count % self.every:
            return
        if count % (self.every * self.every):
            tail = [n for n in self._finished(spark, CHANGES) if batch_id - self.every < n <= batch_id]
            self._put(self.merge(self._rows(spark, [self._folder(CHANGES, n) for n in tail])), RUN, batch_id)
            self._remove(spark, CHANGES, batch_id - self.every)
        else:
            self._put(self.merge(self._rows(spark, self.folders(spark, batch_id, but=batch_id))), SNAPSHOT, batch_id)
            self._remove(spark, CHANGES, batch_id - self.every)
            self._remove(spark, RUN, batch_id - self.every * self.every)
            self._remove(spark, SNAPSHOT, batch_id - self.every * self.every - 1)

    def _remove(self, spark: SparkSession, level: int, upto: int) -> None:
        """Folders that newer ones have taken the place of for a whole turn: no reader is at them any more."""
        for n in self._finished(spark, level):
            if n <= upto:
                where = spark._jvm.org.apache.hadoop.fs.Path(self._folder(level, n))
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
