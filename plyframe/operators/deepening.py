"""Requests that deepen until they are told to stop: each depth is a run of the stored tree under the request's job tag.

A request runs in a thread of its own. Stopping cancels the jobs that carry its tag and no others; the values of the last whole depth
stay. A stopped or finished request can be resumed: it goes on with the next depth.
"""

from __future__ import annotations

import threading
import uuid

from pyspark import InheritableThread
from pyspark.sql import DataFrame

from . import backup


class Deepening:
    """Values of positions at growing depths. roots: the state and chess960. tree: grows the tree of a depth, for tests."""

    def __init__(self, roots: DataFrame, most: int, tree=backup.grown):
        self.roots, self.most, self.tree = roots, most, tree
        self.context = roots.sparkSession.sparkContext
        self.tag = f"request-{uuid.uuid4().hex}"
        self.depth, self.values = 0, None  # of the last whole depth
        self.error: Exception | None = None
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None

    def start(self) -> Deepening:
        """Go on from the last whole depth."""
        if self._thread is not None and self._thread.is_alive():
            return self
        self._stop.clear()
        self._thread = InheritableThread(target=self._run)
        self._thread.start()
        return self

    def _run(self) -> None:
        self.context.addJobTag(self.tag)
        try:
            while self.depth < self.most and not self._stop.is_set():
                levels, edges = self.tree(self.roots, self.depth + 1)
                found = backup.stored(backup.backed_up(levels, edges), "tree-values")
                self.values, self.depth = found, self.depth + 1
        except Exception as error:  # a cancelled job fails; anything else is the request's own failure
            if not self._stop.is_set():
                self.error = error
        finally:
            self.context.removeJobTag(self.tag)

    def stop(self) -> Deepening:
        """Cancel what runs for this request and wait for its thread."""
        self._stop.set()
        while self._thread is not None and self._thread.is_alive():
            self.context.cancelJobsWithTag(self.tag)  # again: a job may begin just after
            self._thread.join(0.2)
        return self

    def wait(self) -> Deepening:
        if self._thread is not None:
            self._thread.join()
        return self
