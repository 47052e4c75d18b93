"""What the cycles of streams did, stored as they end."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

CYCLES = "query string, name string, cycle long, started string, rows long, counts map<string,long>, late long"


class CycleLog(StreamingQueryListener):
    """A file per cycle in a folder, named by query and cycle: a cycle that is reported again replaces itself.

    ``rows`` is what arrived, ``counts`` what the flow observed (``ingest``: sent, failed_pages, unmatched_pages), and
    ``late`` how many rows came behind the watermark, by Spark's count of them. Cycles without rows are not stored.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __enter__(self) -> CycleLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Reports come by a queue: those of cycles that have ended are waited for.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        counts = {key: value for row in progress.observedMetrics.values() for key, value in row.asDict().items()}
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        record = {
            "query": str(progress.id),
            "name": progress.name,
            "cycle": progress.batchId,
            "started": progress.timestamp,
            "rows": progress.numInputRows,
            "counts": counts,
            "late": late,
        }
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{progress.id}-{progress.batchId:010d}.json")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            jvm.org.apache.commons.io.IOUtils.write(json.dumps(record) + "\n", stream, "UTF-8")
        finally:
            stream.close()


def read_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """The stored cycles, one row each."""
    return spark.read.schema(CYCLES).json(folder)
