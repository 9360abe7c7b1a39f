"""Enrichment of a stream of document lines with a limit of consecutive errors, as keyed state.

For each document the state is the number of errors in a row, where it was given up, and the lines that wait. A line whose call
fails is asked again after ``backoff`` milliseconds, up to ``retries`` times, by a processing-time timer; the document's later
lines wait behind it, so that calls stay in order. When ``most_errors`` lines in a row have failed for good the document is given
up: its further lines are unprocessed. State and timers are in the checkpoint, so a query that stops and starts again gives the
rows of one that ran through; only calls of the batch that was cut off are made twice.

Lines of one document come in order of ``pos`` from batch to batch; within a batch they are sorted. Defined results: a document's
first error counts as one; a line without a prompt is asked with the empty text; lines with a null document share one state. The
session must use a state store that takes this operator, as RocksDB's does (``PROVIDER``).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COLUMNS = ["doc_id", "pos", "status", "reply"]


class ConsecutiveErrors(StatefulProcessor):
    """See the module."""

    def __init__(self, call: Callable[[str], str], most_errors: int, retries: int, backoff: int):
        self.call, self.most_errors, self.retries, self.backoff = call, most_errors, retries, backoff

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "errors int, given_up boolean")
        self.waiting = handle.getListState("waiting", "pos long, prompt string, tries int")

    def _work(self, key: tuple, lines: list[tuple[int, str, int]], now: int) -> Iterator[pd.DataFrame]:
        """Works off lines (pos, prompt, tries so far) in order; what has to wait is kept."""
        found = self.run.get() if self.run.exists() else (0, False)
        errors, given_up, rows, at = int(found[0]), bool(found[1]), [], 0
        for at, (pos, prompt, tries) in enumerate(lines):
            if given_up:
                rows.append((key[0], pos, "unprocessed", None))
                continue
            try:
                rows.append((key[0], pos, "processed", self.call(prompt)))
                errors = 0
            except Exception as problem:  # a call is somebody else's code
                if tries < self.retries:
                    self.waiting.put([(pos, prompt, tries + 1), *lines[at + 1 :]])
                    self.handle.registerTimer(now + self.backoff)
                    break
                rows.append((key[0], pos, "error", str(problem)))
                errors += 1
                given_up = errors >= self.most_errors
        else:
            self.waiting.clear()
        self.run.update((errors, given_up))
        if rows:
            yield pd.DataFrame(rows, columns=_COLUMNS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = sorted((int(p), t if isinstance(t, str) else "", 0) for pdf in rows for p, t in zip(pdf["pos"], pdf["prompt"], strict=True))
        held = [(int(p), t, int(n)) for p, t, n in self.waiting.get()] if self.waiting.exists() else []
        if held:  # its timer goes on
            self.waiting.put([*held, *new])
            return
        yield from self._work(key, new, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = [(int(p), t, int(n)) for p, t, n in self.waiting.get()] if self.waiting.exists() else []
        yield from self._work(key, held, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def enrich_stream(lines: DataFrame, call: Callable[[str], str], *, most_errors: int = 3, retries: int = 0, backoff: int = 1000) -> DataFrame:
    """(doc_id, pos, status, reply) of a stream of lines (doc_id, pos, prompt): processed, error or unprocessed."""
    key = lines.schema["doc_id"].dataType.simpleString()
    grouped = lines.select("doc_id", "pos", "prompt").groupBy("doc_id")
    schema = f"doc_id {key}, pos long, status string, reply string"
    return grouped.transformWithStateInPandas(ConsecutiveErrors(call, most_errors, retries, backoff), schema, "append", "processingTime")
