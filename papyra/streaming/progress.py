"""Progress of streams for the dashboard: one row per batch, from the engine's own listener."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps the last ``most`` batches of the session's streams, for ``frame``.

        log = ProgressLog(); spark.streams.addListener(log)
    """

    SCHEMA = "query string, batch long, input_rows long, seconds double, state_rows long, late_rows long, failed string"

    def __init__(self, most: int = 10_000):
        self.rows: deque = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((
            str(p.id), p.batchId, p.numInputRows, p.batchDuration / 1000,
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.rows.append((str(event.id), None, None, None, None, None, event.exception[:1000]))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.SCHEMA)
