"""Periodic refresh: the roots are seeded again when a stream has nothing left to do.

A listener hears when the stream is idle. A refresh waits for the delay and for an idle
stream, and the next one also until the stream has taken up what the last one seeded, so
at most one refresh is pending, however long the work takes.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class IdleListener(StreamingQueryListener):
    """Rows that one query has taken, and whether it was idle since."""

    def __init__(self) -> None:
        self.run_id: str | None = None
        self.rows, self.idle, self.ended = 0, False, False
        self.changed = threading.Condition()

    def _note(self, run_id: object, rows: int) -> None:
        with self.changed:
            if str(run_id) == self.run_id:
                self.rows += rows
                self.idle = rows == 0
                self.changed.notify_all()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._note(event.progress.runId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        self._note(event.runId, 0)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            if str(event.runId) == self.run_id:
                self.ended = True
                self.changed.notify_all()

    def wait_idle(self, rows: int, timeout: float) -> bool:
        """Wait for an idle query that has taken more than ``rows`` rows; False if it ended or the time is over."""
        with self.changed:
            done = self.changed.wait_for(lambda: self.ended or (self.idle and self.rows > rows), timeout)
            return bool(done) and not self.ended


def refresh_when_idle(
    spark: SparkSession, query: StreamingQuery, seed: Callable[[int], int], refreshes: int, delay: float = 600.0, timeout: float = 3600.0,
) -> int:
    """Seed the roots of a running query ``refreshes`` times, each time when it is idle; the refreshes made.

    ``query`` runs on an interval. ``seed`` puts the roots in the query's source and
    returns their number; none ends the refreshes. Returns once the last one is
    worked off; it does not stop the query. ``timeout`` bounds one wait.
    """
    listener = IdleListener()
    listener.run_id = str(query.runId)
    spark.streams.addListener(listener)
    try:
        before, made = -1, 0
        while made < refreshes:
            if not listener.wait_idle(before, timeout):
                break
            time.sleep(delay)
            before = listener.rows
            if not seed(made):
                break
            made += 1
        if made:
            listener.wait_idle(before, timeout)
        return made
    finally:
        spark.streams.removeListener(listener)
