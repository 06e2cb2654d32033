"""Keep a streaming query running: wait for its source, restart it, end it in order.

A query that fails is started again from its checkpoint after a pause that
doubles (a source that is not there yet fails the start, so it is waited for in the
same way). A batch that was stored counts as progress and resets the pause. The
sinks are safe to replay, so a failure between store and checkpoint loses and
doubles nothing. A stop marker, a file that anyone may create, ends the query
between two batches."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import fs

log = logging.getLogger(__name__)
#: Errors of the caller, which no repetition mends.
FATAL = (ValueError, TypeError)


@dataclass
class Outcome:
    """How a supervised query ended: starts made, failures met, and whether a stop
    marker ended it."""

    starts: int = 0
    failures: list[str] = field(default_factory=list)
    stopped: bool = False


def _batches_done(query: StreamingQuery | None) -> int:
    last = query.lastProgress if query is not None else None
    return int(last["batchId"]) if last else -1


def stop_in_order(query: StreamingQuery, poll: float) -> None:
    """Stop between batches; a batch that a trigger has just begun is waited for."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll)
    query.stop()


def supervise(spark: SparkSession, start: Callable[[], StreamingQuery], retries: int = 5, first_pause: float = 1.0,
              longest_pause: float = 60.0, stop_marker: str | None = None, poll: float = 0.2) -> Outcome:
    """Run ``start()`` until its query ends by itself or ``stop_marker`` appears.

    After more than ``retries`` failures in a row without a batch stored between
    them the last one is raised. ``ValueError`` and ``TypeError`` of ``start`` (wrong
    paths or options) are raised at once."""
    out, row, pause = Outcome(), 0, first_pause
    while True:
        if stop_marker and fs.exists(spark, stop_marker):
            out.stopped = True
            return out
        query = None
        try:
            out.starts += 1
            query = start()
            while not query.awaitTermination(poll):
                if stop_marker and fs.exists(spark, stop_marker):
                    stop_in_order(query, poll)
                    out.stopped = True
                    return out
            return out
        except FATAL as e:
            if not isinstance(e, PySparkException):
                raise
            error: Exception = e
        except Exception as e:  # whatever the source, the sink or a task raised
            error = e
        out.failures.append(str(error).splitlines()[0] if str(error) else type(error).__name__)
        progressed = _batches_done(query) >= 0
        row, pause = (1, first_pause) if progressed else (row + 1, pause)
        if row > retries:
            raise error
        log.warning("start %d failed (%s); again in %.1f s", out.starts, out.failures[-1], pause)
        time.sleep(pause)
        pause = min(longest_pause, 2 * pause)
