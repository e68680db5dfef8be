"""Records a stream's progress: what its observed counts and the engine's own times say of each micro-batch."""

from __future__ import annotations

import threading
from collections import Counter
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sinks import metrics

#: Name of the counts observed before the dedup.
OBSERVED = "ingest"


class IngestRecorder(StreamingQueryListener):
    """Listens to one ingest query. ``flushed`` is told by the job what a batch kept; progress says what came in.

    Events are delivered some time after a batch. ``settle`` takes those of a stopped query at once from the query itself; a
    batch told twice is recorded in the same place.
    """

    def __init__(self, spark: SparkSession, root: str, instance: str):
        self.spark, self.root, self.instance = spark, root, instance
        self.query_id: str | None = None
        self._kept: dict[int, int] = {}
        self._lock = threading.Lock()

    def flushed(self, batch_id: int, counts: Counter[str]) -> None:
        with self._lock:
            self._kept[batch_id] = counts["flushed"]

    def settle(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            self._take(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query_id is None or str(event.progress.id) == self.query_id:
            self._take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _take(self, progress) -> None:
        with self._lock:
            kept = self._kept.pop(progress.batchId, None)
        seen = progress.observedMetrics.get(OBSERVED)
        if kept is None or seen is None:
            return  # told already, or a batch that flushed nothing
        spent = progress.durationMs
        seconds = {
            "fetch": (spent.get("latestOffset", 0) + spent.get("getBatch", 0)) / 1000,
            "staging": (spent.get("walCommit", 0) + spent.get("commitOffsets", 0)) / 1000,
        }
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp()
        metrics.record(
            self.spark, self.root, self.instance, progress.batchId, "progress", {metrics.DUPLICATES: seen["valid"] - kept}, seconds, at)
