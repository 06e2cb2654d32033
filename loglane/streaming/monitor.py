"""Stream health as data: a listener that records micro-batch progress."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = ("query_id string, name string, batch_id bigint, num_input_rows bigint, "
                   "input_rows_per_second double, processed_rows_per_second double, "
                   "trigger_ms bigint, offsets_behind_latest double")


class ProgressRecorder(StreamingQueryListener):
    """Keeps one row per micro-batch of every query in the session (lines
    read, lines/second in and processed, trigger duration and, for sources
    that report it, the average offsets behind latest). Register with
    ``spark.streams.addListener``. A long-lived session calls ``flush`` now and
    then: it appends the rows to a table and drops them here."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802 (listener API)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        behind = None
        for src in p.get("sources", []) or []:
            m = src.get("metrics") or {}
            if "avgOffsetsBehindLatest" in m:
                behind = float(m["avgOffsetsBehindLatest"])
        row = (p.get("id"), p.get("name"), int(p.get("batchId", -1)), int(p.get("numInputRows", 0)),
               float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
               int((p.get("durationMs") or {}).get("triggerExecution", 0)), behind)
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the rows so far to a Parquet table and forget them."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return len(rows)

    def to_df(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self._rows)
        return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def record_progress(spark: SparkSession) -> ProgressRecorder:
    """Attach a recorder to the session and return it."""
    rec = ProgressRecorder()
    spark.streams.addListener(rec)
    return rec
