"""What streams drop for lateness, and the state they hold, as a table by batch and operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

REPORT = "run string, batch_id bigint, place int, operator string, late_rows bigint, state_rows bigint, watermark timestamp"


class OperatorReport(StreamingQueryListener):
    """Collects what each stateful operator of each micro-batch reports in progress events.

    An operator counts the rows that reach it behind the watermark; an aggregate gets rows that were combined
    before. To count rows as they came, put ``dedupe_stream`` in front: it drops late ones first. Attached as a
    listener it sees all running queries; ``take`` adds what a query still remembers, and a batch that is
    reported twice counts once. ``flush`` moves the collected rows to a table.
    """

    def __init__(self) -> None:
        self.held: dict[tuple[str, int, int], tuple] = {}

    def add(self, progress) -> None:
        stamp = progress.eventTime.get("watermark") if progress.eventTime else None
        for place, op in enumerate(progress.stateOperators):
            self.held[str(progress.id), progress.batchId, place] = (op.operatorName, op.numRowsDroppedByWatermark, op.numRowsTotal, stamp)

    def take(self, query: StreamingQuery) -> OperatorReport:
        for progress in query.recentProgress:
            self.add(progress)
        return self

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append what has been collected, and forget it. A few rows for each batch of a query."""
        rows = [(*key, *values[:3], values[3]) for key, values in sorted(self.held.items())]
        if rows:
            frame = spark.createDataFrame(rows, REPORT.replace("watermark timestamp", "watermark string"))
            frame.withColumn("watermark", F.to_timestamp("watermark")).coalesce(1).write.mode("append").parquet(path)
        self.held.clear()
        return len(rows)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch and operator, also where a batch was flushed twice."""
    rows = spark.read.schema(REPORT).parquet(path)
    return rows.groupBy("run", "batch_id", "place").agg(
        F.max("operator").alias("operator"), F.max("late_rows").alias("late_rows"), F.max("state_rows").alias("state_rows"),
        F.max("watermark").alias("watermark"))


def late_rows(report: DataFrame) -> DataFrame:
    """Rows dropped by each operator over all batches."""
    return report.groupBy("run", "place", "operator").agg(F.sum("late_rows").alias("late_rows"))
